"""The schema registry of the source contracts, and the check of files against it.

A column's type follows from its name by rule, so one name means one thing in all tables.  Files are read with the
declared schema; before that their own is compared with it, and every difference is named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

# FIXED VALUES: the columns of each contract that marts, jobs and checks read, in their order
COLUMNS = {
    "entities": "id name completename level entities_id",
    "locations": "id name",
    "groups": "id name code comment is_assign",
    "users": "id name firstname realname entities_id is_active is_deleted",
    "useremails": "users_id email is_default",
    "profiles": "id name",
    "profiles_users": "users_id profiles_id",
    "groups_users": "users_id groups_id",
    "tickets": "id entities_id name date solvedate closedate takeintoaccountdate date_mod status priority type itilcategories_id slas_id_ttr time_to_resolve solve_delay_stat close_delay_stat is_deleted",
    "tickets_users": "tickets_id users_id type",
    "groups_tickets": "tickets_id groups_id type",
    "itilcategories": "id name completename level itilcategories_id",
    "slas": "id name type number_time definition_time",
    "itilfollowups": "itemtype items_id id",
    "tickettasks": "tickets_id id",
    "ticketsatisfactions": "id tickets_id date_answered satisfaction satisfaction_scaled_to_5 comment",
    "computers": "id entities_id name serial users_id_tech locations_id states_id manufacturers_id models_id types_id is_deleted date_creation date_mod users_id",
    "networkequipments": "id entities_id name serial users_id_tech locations_id states_id manufacturers_id models_id types_id is_deleted date_creation date_mod",
    "monitors": "id entities_id name serial users_id_tech locations_id states_id manufacturers_id models_id types_id is_deleted date_creation date_mod users_id",
    "printers": "id entities_id name serial users_id_tech locations_id states_id manufacturers_id models_id types_id is_deleted date_creation date_mod",
    "phones": "id entities_id users_id is_deleted",
    "peripherals": "id entities_id users_id is_deleted",
    "computertypes": "id name",
    "networkequipmenttypes": "id name",
    "monitortypes": "id name",
    "printertypes": "id name",
    "computermodels": "id name",
    "networkequipmentmodels": "id name",
    "monitormodels": "id name",
    "printermodels": "id name",
    "manufacturers": "id name",
    "states": "id name",
    "items_tickets": "id itemtype items_id tickets_id",
    "infocoms": "id itemtype items_id suppliers_id buy_date use_date value warranty_duration warranty_info",
    "items_racks": "racks_id itemtype items_id position bgcolor",
    "racks": "id name entities_id locations_id number_units max_power",
    "operatingsystems": "id name",
    "operatingsystemversions": "id name",
    "items_operatingsystems": "items_id itemtype operatingsystems_id operatingsystemversions_id is_dynamic date_creation",
    "softwares": "id name manufacturers_id is_helpdesk_visible is_deleted entities_id",
    "softwareversions": "id softwares_id name",
    "softwarelicenses": "id softwares_id number allow_overquota expire serial softwarelicensetypes_id",
    "softwarelicensetypes": "id name",
    "items_softwareversions": "id softwareversions_id itemtype items_id is_deleted",
    "suppliers": "id name suppliertypes_id email phonenumber town state website is_active is_deleted entities_id",
    "suppliertypes": "id name",
    "contracts": "id name num contracttypes_id begin_date duration comment is_deleted entities_id",
    "contracttypes": "id name",
    "contracts_suppliers": "contracts_id suppliers_id",
    "contracts_items": "id contracts_id itemtype items_id",
    "knowbaseitems": "id name is_faq view users_id forms_categories_id date_creation date_mod",
    "knowbaseitemcategories": "id name",
    "knowbaseitems_items": "id knowbaseitems_id itemtype items_id",
    "problems": "id entities_id name date solvedate closedate status priority urgency impact itilcategories_id is_deleted",
    "changes": "id entities_id name date solvedate closedate status priority urgency impact itilcategories_id is_deleted",
    "problems_tickets": "problems_id tickets_id",
    "problems_users": "problems_id users_id type",
    "groups_problems": "problems_id groups_id type",
    "items_problems": "id problems_id itemtype items_id",
    "changes_tickets": "changes_id tickets_id",
    "changes_users": "changes_id users_id type",
    "changes_items": "id changes_id itemtype items_id",
    "changetasks": "id changes_id state",
    "projects": "id entities_id name code priority projectstates_id users_id groups_id plan_start_date plan_end_date real_start_date real_end_date percent_done is_deleted",
    "projectstates": "id name is_finished",
    "projecttasks": "id projects_id name is_milestone plan_start_date plan_end_date real_start_date real_end_date percent_done projectstates_id users_id is_deleted",
    "projecttasks_tickets": "projecttasks_id tickets_id",
    "projectteams": "projects_id items_id itemtype",
    "itils_projects": "projects_id itemtype items_id",
}
# FIXED VALUES: column names by type; keys (id, *_id) are bigint, all others string
KEYS_TOO = {"users_id_tech", "slas_id_ttr", "view"}
WHOLE = set(("level is_assign is_active is_deleted is_default status priority type solve_delay_stat close_delay_stat number_time satisfaction "
             "warranty_duration position number_units max_power is_dynamic is_helpdesk_visible number allow_overquota duration is_faq urgency impact "
             "percent_done is_finished is_milestone").split())
MOMENTS = set("date solvedate closedate takeintoaccountdate date_mod time_to_resolve date_answered date_creation plan_start_date plan_end_date "
              "real_start_date real_end_date".split())
DAYS = set("buy_date use_date expire begin_date".split())
DOUBLES = {"satisfaction_scaled_to_5", "value"}
# FIXED VALUES: a name that means something else in one table
EXCEPTIONS = {("changetasks", "state"): "int"}
# FIXED VALUES: columns that are there in some installations only, and their types
OPTIONAL = {("tickets", "reopen_count"): "int", ("contracts", "cost"): "double"}


class ContractError(ValueError):
    """Files that do not hold what the contract says; the message names every difference."""


def type_name(table: str, column: str) -> str:
    if (table, column) in EXCEPTIONS or (table, column) in OPTIONAL:
        return EXCEPTIONS.get((table, column)) or OPTIONAL[table, column]
    if column == "id" or column.endswith("_id") or column in KEYS_TOO:
        return "bigint"
    return next((t for t, names in (("int", WHOLE), ("timestamp_ntz", MOMENTS), ("date", DAYS), ("double", DOUBLES)) if column in names), "string")


def required(table: str) -> list[str]:
    """Columns that are never NULL: the key, or in a table of links all that it links."""
    columns = COLUMNS[table].split()
    return ["id"] if "id" in columns else [c for c in columns if c == "itemtype" or (c.endswith("_id") and c not in ("entities_id", "operatingsystems_id", "operatingsystemversions_id"))]


def schema(table: str) -> StructType:
    must = set(required(table))
    return StructType([StructField(c, DataType.fromDDL(type_name(table, c)), c not in must) for c in COLUMNS[table].split()])


def differences(table: str, found: StructType) -> list[str]:
    """What in ``found`` is not as declared; other columns may be there as well."""
    there = {f.name: f.dataType.simpleString() for f in found.fields}
    out = []
    for f in schema(table).fields:
        want = f.dataType.simpleString()
        if f.name not in there:
            out.append(f"{table}.{f.name} is missing ({want})")
        elif there[f.name] != want:
            out.append(f"{table}.{f.name} is {there[f.name]}, declared {want}")
    for (t, c), want in OPTIONAL.items():
        if t == table and c in there and there[c] != want:
            out.append(f"{table}.{c} is {there[c]}, declared {want}")
    return out


def readable(table: str, found: StructType) -> StructType:
    """The schema to read files of ``found`` with: as declared, with the optional columns that they hold."""
    problems = differences(table, found)
    if problems:
        raise ContractError("; ".join(problems))
    extra = [StructField(c, DataType.fromDDL(t), True) for (name, c), t in OPTIONAL.items() if name == table and c in found.names]
    return StructType([*schema(table).fields, *extra])


def null_keys(src, as_of=None) -> DataFrame:
    """Rows and NULLs of every required column of every contract: one stacked aggregate over all tables."""
    stacked = None
    for table in COLUMNS:
        flags = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNull().cast("int").alias("gone")) for c in required(table)])
        one = src[table].select(F.lit(table).alias("table"), F.explode(flags).alias("f")).select("table", "f.*")
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked.groupBy("table", "column").agg(F.count(F.lit(1)).alias("rows"), F.sum("gone").cast("bigint").alias("nulls"))


QUERIES = {"contract_null_keys": null_keys}
