"""CMDB and ITIL marts V11-V18 (assets, asset tickets, problems, changes,
projects, project tasks, CMDB summary).

Fan-out rules of the published views are reproduced *arithmetically*:
the views join several one-to-many link tables before grouping, so sums
count every combination.  Here each link table is pre-aggregated per key
and the fan-out factor is a product of counts, which gives the same numbers
without materialising the cross product (the cross product is quadratic in
the links of a hot key and would not survive a skewed key at scale).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import domains as D
from tessera.functions.labels import code_label
from tessera.functions.time import diff_units, ntz
from tessera.operators.links import full_name

T = F.col

# (item type, contract table, type table, model table, type fk, model fk, has user)
ASSET_KINDS = (
    ("Computer", "computers", "computertypes", "computermodels", "computertypes_id", "computermodels_id", True),
    ("NetworkEquipment", "networkequipments", "networkequipmenttypes", "networkequipmentmodels",
     "networkequipmenttypes_id", "networkequipmentmodels_id", False),
    ("Monitor", "monitors", "monitortypes", "monitormodels", "monitortypes_id", "monitormodels_id", True),
    ("Printer", "printers", "printertypes", "printermodels", "printertypes_id", "printermodels_id", False),
)


def _lookup(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.select(T("id").alias(key), T("name").alias(out))


#: columns of V11 that a look-up provides; a reader that names none of them joins nothing
ASSET_LOOKUPS = ("asset_type", "asset_model", "manufacturer", "asset_state", "location", "assigned_tech", "assigned_user")


def _asset_rows(src, itemtype, table, types, models, with_user, keys: DataFrame | None = None, needs=None) -> DataFrame:
    a = src[table].where(T("is_deleted") == 0)
    if keys is not None:
        # restrict BEFORE the lookups; ``keys`` is a bounded set (a top-k)
        k = keys.where(T("asset_itemtype") == itemtype).select(T("asset_id").alias("_kid"))
        a = a.join(F.broadcast(k), T("id") == T("_kid"), "left_semi")
    # contract tables carry generic fk names types_id / models_id
    ways = {"asset_type": (types, "types_id"), "asset_model": (models, "models_id"), "manufacturer": ("manufacturers", "manufacturers_id"),
            "asset_state": ("states", "states_id"), "location": ("locations", "locations_id"), "assigned_tech": ("users", "users_id_tech"),
            "assigned_user": ("users", "users_id")}
    want = [c for c in ASSET_LOOKUPS if needs is None or c in needs]
    for c in want:
        other, fk = ways[c]
        if c == "assigned_user" and not with_user:
            a = a.withColumn(c, F.lit(None).cast("string"))
        else:
            a = a.join(_lookup(src[other], f"_{c}_id", c), T(fk) == T(f"_{c}_id"), "left")
    columns = [
        F.concat(F.lit(itemtype + "-"), T("id")).alias("asset_key"), F.lit(itemtype).alias("asset_itemtype"),
        T("id").alias("asset_id"), T("name").alias("asset_name"), "asset_type", "asset_model", "manufacturer",
        "asset_state", "location", T("entities_id").alias("entity_id"), "assigned_user",
        "assigned_tech", T("serial").alias("serial_number"), T("date_creation").alias("purchase_date"),
        T("date_mod").alias("last_updated")]
    return a.select(*[c for c in columns if not isinstance(c, str) or c in want])


# -------------------------------------------------------------------- V11
def build_vw_dim_asset(src, as_of: datetime | None = None, keys: DataFrame | None = None, needs=None) -> DataFrame:
    """V11.  ``keys`` (asset_itemtype, asset_id) of BOUNDED size - e.g. a
    top-k - restricts every branch before its seven lookups, so a page that
    names ten assets does not build the whole asset dimension.  ``needs`` names
    the looked-up columns a reader uses (None: all); others are left out."""
    out = None
    for itemtype, table, types, models, _tfk, _mfk, with_user in ASSET_KINDS:
        part = _asset_rows(src, itemtype, table, types, models, with_user, keys, needs)
        out = part if out is None else out.unionByName(part)
    return out


# -------------------------------------------------------------------- V12
def build_vw_fact_asset_tickets(src, as_of: datetime | None = None) -> DataFrame:
    it = src["items_tickets"]
    t = src["tickets"].where(T("is_deleted") == 0).select(
        T("id").alias("t_id"), T("name").alias("t_name"), T("date").alias("t_date"), "status", "priority",
        "itilcategories_id")
    cat = _lookup(src["itilcategories"], "_cid", "category")
    j = it.join(t, T("tickets_id") == T("t_id")).join(cat, T("itilcategories_id") == T("_cid"), "left")
    return j.select(
        T("id").alias("link_id"), F.concat(T("itemtype"), F.lit("-"), T("items_id")).alias("asset_key"),
        T("itemtype").alias("asset_itemtype"), T("items_id").alias("asset_id"), "tickets_id",
        T("t_name").alias("ticket_name"), T("t_date").alias("ticket_date"), F.year("t_date").alias("ticket_year"),
        F.month("t_date").alias("ticket_month"), T("status").alias("ticket_status"),
        T("priority").alias("ticket_priority"), "category",
        code_label(T("status"), D.STATUS_LABELS_ANDAMENTO, D.STATUS_UNKNOWN).alias("ticket_status_label"),
        code_label(T("priority"), D.PRIORITY_LABELS_PLAIN, D.PRIORITY_PLAIN_UNKNOWN).alias("priority_label"),
    ).withColumnRenamed("tickets_id", "ticket_id")


# -------------------------------------------------------------------- V13
def build_vw_fact_asset_incidents(src, as_of: datetime | None = None) -> DataFrame:
    it = src["items_tickets"].select("itemtype", "items_id", "tickets_id")
    t = src["tickets"].where(T("is_deleted") == 0).select(
        T("id").alias("t_id"), "date", "solvedate", "status", "priority")
    j = it.join(t, T("tickets_id") == T("t_id"))
    agg = j.groupBy("itemtype", "items_id").agg(
        F.count("t_id").alias("total_tickets"),
        F.sum(F.when(T("status").isin(*D.RESOLVED_CODES), 1).otherwise(0)).cast("bigint").alias("tickets_closed"),
        F.sum(F.when(~T("status").isin(*D.RESOLVED_CODES), 1).otherwise(0)).cast("bigint").alias("tickets_open"),
        F.sum(F.when(T("priority") >= 4, 1).otherwise(0)).cast("bigint").alias("tickets_high_priority"),
        F.round(F.avg(F.when(T("solvedate").isNotNull(), diff_units("MINUTE", T("date"), T("solvedate")))), 1)
         .alias("avg_resolution_min"),
        F.min("date").alias("first_ticket_date"), F.max("date").alias("last_ticket_date"))
    return agg.select(
        F.concat(T("itemtype"), F.lit("-"), T("items_id")).alias("asset_key"), T("itemtype").alias("asset_itemtype"),
        T("items_id").alias("asset_id"), "total_tickets", "tickets_closed", "tickets_open", "tickets_high_priority",
        "avg_resolution_min", "first_ticket_date", "last_ticket_date")


# ---------------------------------------------------------------- V14/V15
def _itil_header(src, table: str, status_labels: dict, status_other: str) -> DataFrame:
    p = src[table].where(T("is_deleted") == 0)
    cat = _lookup(src["itilcategories"], "_cid", "category")
    p = p.join(cat, T("itilcategories_id") == T("_cid"), "left")
    return p.select(
        T("id").alias("_pid"), T("entities_id").alias("entity_id"), T("name").alias("_name"),
        T("date").alias("open_date"), T("solvedate").alias("solve_date"), T("closedate").alias("close_date"),
        F.year("date").alias("open_year"), F.month("date").alias("open_month"), T("status").alias("status_code"),
        code_label(T("status"), status_labels, status_other).alias("status_label"),
        T("priority").alias("priority_code"),
        code_label(T("priority"), D.PRIORITY_LABELS_PLAIN, D.PRIORITY_PLAIN_UNKNOWN).alias("priority_label"),
        "urgency", "impact", "category",
        F.when(T("solvedate").isNotNull(), diff_units("MINUTE", T("date"), T("solvedate"))).alias("resolution_minutes"),
        F.when(T("status").isin(*D.RESOLVED_CODES), 1).otherwise(0).alias("is_closed"))


def _assignees(src, link_table: str, key: str) -> DataFrame:
    """Assigned technicians per item, grouped on the view's name keys, with
    the number of link rows merged into each key (fan-out factor)."""
    lk = src[link_table].where(T("type") == 2).select(T(key).alias("_pid"), T("users_id").alias("_uid"))
    u = src["users"].select(T("id").alias("_u"), "name", "firstname", "realname")
    return (lk.join(u, T("_uid") == T("_u"), "left")
              .groupBy("_pid", "name", "firstname", "realname").agg(F.count(F.lit(1)).alias("_ntech")))


def _distinct_count(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    return df.groupBy(T(key).alias("_pid")).agg(F.count_distinct(col).alias(out), F.count(F.lit(1)).alias("_n_" + out))


def build_vw_fact_problems(src, as_of: datetime | None = None) -> DataFrame:
    h = _itil_header(src, "problems", D.STATUS_LABELS_ANDAMENTO, D.STATUS_UNKNOWN)
    tech = _assignees(src, "problems_users", "problems_id")
    grp = (src["groups_problems"].where(T("type") == 2)
           .join(_lookup(src["groups"], "_gid", "assigned_group"), T("groups_id") == T("_gid"), "left")
           .select(T("problems_id").alias("_gp"), "assigned_group").distinct())
    tk = _distinct_count(src["problems_tickets"], "problems_id", "tickets_id", "linked_tickets")
    ia = _distinct_count(src["items_problems"], "problems_id", "id", "linked_assets")
    j = (h.join(tech, "_pid", "left").join(grp, T("_pid") == T("_gp"), "left")
          .join(tk, "_pid", "left").join(ia, "_pid", "left"))
    return j.select(
        T("_pid").alias("problem_id"), "entity_id", T("_name").alias("problem_name"), "open_date", "solve_date",
        "close_date", "open_year", "open_month", "status_code", "status_label", "priority_code", "priority_label",
        "urgency", "impact", "category", T("name").alias("assigned_tech"),
        full_name(T("firstname"), T("realname")).alias("tech_fullname"), "assigned_group",
        F.coalesce("linked_tickets", F.lit(0)).alias("linked_tickets"),
        F.coalesce("linked_assets", F.lit(0)).alias("linked_assets"), "resolution_minutes", "is_closed")


def build_vw_fact_changes(src, as_of: datetime | None = None) -> DataFrame:
    """``tasks_done`` keeps the published fan-out (done tasks x assignee rows
    x ticket links x item links); ``tasks_done_distinct`` is the true count."""
    h = _itil_header(src, "changes", D.CHANGE_STATUS_LABELS, D.CHANGE_STATUS_OTHER)
    tech = _assignees(src, "changes_users", "changes_id")
    tk = _distinct_count(src["changes_tickets"], "changes_id", "tickets_id", "linked_tickets")
    ci = _distinct_count(src["changes_items"], "changes_id", "id", "linked_assets")
    tasks = src["changetasks"].groupBy(T("changes_id").alias("_pid")).agg(
        F.count_distinct("id").alias("total_tasks"),
        F.sum(F.when(T("state") == 2, 1).otherwise(0)).cast("bigint").alias("_done_rows"),
        F.count_distinct(F.when(T("state") == 2, T("id"))).alias("tasks_done_distinct"))
    j = (h.join(tech, "_pid", "left").join(tk, "_pid", "left").join(ci, "_pid", "left")
          .join(tasks, "_pid", "left"))
    fan = (F.coalesce("_ntech", F.lit(1)) * F.coalesce("_n_linked_tickets", F.lit(1))
           * F.coalesce("_n_linked_assets", F.lit(1)))
    return j.select(
        T("_pid").alias("change_id"), "entity_id", T("_name").alias("change_name"), "open_date", "solve_date",
        "close_date", "open_year", "open_month", "status_code", "status_label", "priority_code", "priority_label",
        "urgency", "impact", "category", T("name").alias("assigned_tech"),
        full_name(T("firstname"), T("realname")).alias("tech_fullname"),
        F.coalesce("linked_tickets", F.lit(0)).alias("linked_tickets"),
        F.coalesce("linked_assets", F.lit(0)).alias("linked_assets"),
        F.coalesce("total_tasks", F.lit(0)).alias("total_tasks"),
        (F.coalesce("_done_rows", F.lit(0)) * fan).cast("bigint").alias("tasks_done"),
        F.coalesce("tasks_done_distinct", F.lit(0)).alias("tasks_done_distinct"),
        "resolution_minutes", "is_closed")


# -------------------------------------------------------------------- V16
def build_vw_fact_projects(src, as_of: datetime) -> DataFrame:
    now = ntz(as_of)
    p = src["projects"].where(T("is_deleted") == 0)
    ps = src["projectstates"].select(T("id").alias("_sid"), T("name").alias("project_state"), "is_finished")
    u = src["users"].select(T("id").alias("_uid"), T("name").alias("project_manager"), "firstname", "realname")
    g = _lookup(src["groups"], "_gid", "responsible_group")
    tasks = src["projecttasks"]
    live = tasks.where(T("is_deleted") == 0).groupBy(T("projects_id").alias("_p1")).agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.sum(F.when(T("projectstates_id") == 2, 1).otherwise(0)).cast("bigint").alias("tasks_closed"))
    linked = (src["projecttasks_tickets"]
              .join(tasks.select(T("id").alias("_tid"), T("projects_id").alias("_p2")), T("projecttasks_id") == T("_tid"))
              .groupBy("_p2").agg(F.count_distinct("tickets_id").alias("linked_project_task_tickets")))
    team = src["projectteams"].groupBy(T("projects_id").alias("_p3")).agg(F.count(F.lit(1)).alias("team_members"))
    j = (p.join(ps, T("projectstates_id") == T("_sid"), "left").join(u, T("users_id") == T("_uid"), "left")
          .join(g, T("groups_id") == T("_gid"), "left").join(live, T("id") == T("_p1"), "left")
          .join(linked, T("id") == T("_p2"), "left").join(team, T("id") == T("_p3"), "left"))
    actual = (F.when(T("real_end_date").isNotNull(), diff_units("DAY", T("plan_start_date"), T("real_end_date")))
              .when(T("real_start_date").isNotNull(), diff_units("DAY", T("plan_start_date"), now)))
    return j.select(
        T("id").alias("project_id"), T("entities_id").alias("entity_id"), T("name").alias("project_name"),
        T("code").alias("project_code"), T("priority").alias("priority_code"),
        code_label(T("priority"), D.PRIORITY_LABELS_PLAIN, D.PRIORITY_PLAIN_UNKNOWN).alias("priority_label"),
        "project_state",
        F.when(T("is_finished") == 1, F.lit(D.PROJECT_FINISHED)).otherwise(F.lit(D.PROJECT_RUNNING)).alias("state_category"),
        T("plan_start_date").alias("planned_start"), T("plan_end_date").alias("planned_end"),
        T("real_start_date").alias("real_start"), T("real_end_date").alias("real_end"),
        T("percent_done").alias("pct_done"), F.year("plan_start_date").alias("start_year"),
        F.month("plan_start_date").alias("start_month"),
        diff_units("DAY", T("plan_start_date"), T("plan_end_date")).alias("planned_duration_days"),
        actual.alias("actual_duration_days"), "project_manager",
        full_name(T("firstname"), T("realname")).alias("manager_fullname"), "responsible_group",
        F.coalesce("total_tasks", F.lit(0)).alias("total_tasks"),
        F.coalesce("tasks_closed", F.lit(0)).alias("tasks_closed"),
        F.coalesce("linked_project_task_tickets", F.lit(0)).alias("linked_project_task_tickets"),
        F.coalesce("team_members", F.lit(0)).alias("team_members"))


# -------------------------------------------------------------------- V17
def build_vw_fact_project_tasks(src, as_of: datetime | None = None) -> DataFrame:
    pt = src["projecttasks"].where(T("is_deleted") == 0)
    p = src["projects"].select(T("id").alias("_pid"), T("name").alias("project_name"), T("code").alias("project_code"))
    ps = _lookup(src["projectstates"], "_sid", "task_state")
    u = src["users"].select(T("id").alias("_uid"), T("name").alias("responsible"), "firstname", "realname")
    tk = src["projecttasks_tickets"].groupBy(T("projecttasks_id").alias("_tid")).agg(
        F.count_distinct("tickets_id").alias("linked_tickets"))
    j = (pt.join(p, T("projects_id") == T("_pid")).join(ps, T("projectstates_id") == T("_sid"), "left")
           .join(u, T("users_id") == T("_uid"), "left").join(tk, T("id") == T("_tid"), "left"))
    late = T("real_end_date").isNotNull() & (T("real_end_date") > T("plan_end_date"))
    return j.select(
        T("id").alias("task_id"), T("projects_id").alias("project_id"), "project_name", "project_code",
        T("name").alias("task_name"), "is_milestone", T("plan_start_date").alias("planned_start"),
        T("plan_end_date").alias("planned_end"), T("real_start_date").alias("real_start"),
        T("real_end_date").alias("real_end"), T("percent_done").alias("pct_done"), "task_state", "responsible",
        full_name(T("firstname"), T("realname")).alias("responsible_fullname"),
        diff_units("DAY", T("plan_start_date"), T("plan_end_date")).alias("planned_days"),
        F.when(T("real_end_date").isNotNull(), diff_units("DAY", T("plan_start_date"), T("real_end_date"))).alias("actual_days"),
        F.when(late, diff_units("DAY", T("plan_end_date"), T("real_end_date"))).otherwise(F.lit(0)).cast("bigint").alias("delay_days"),
        F.coalesce("linked_tickets", F.lit(0)).alias("linked_tickets"))


# -------------------------------------------------------------------- V18
def build_vw_cmdb_summary(src, as_of: datetime | None = None) -> DataFrame:
    a = build_vw_dim_asset(src, as_of, needs=("asset_type", "manufacturer", "asset_state", "location"))
    return a.groupBy(T("asset_itemtype").alias("asset_type"), T("asset_type").alias("subtype"), "manufacturer",
                     "asset_state", "location").agg(F.count(F.lit(1)).alias("total_assets"))
