"""Row-level scope pushed into the source contracts.

A reader's scope is a list of entities.  Every contract row belongs to an entity on a stated path: its own column, its
parent row's, or that of the item it is linked to by type and id.  Marts built from ``ScopedSources`` are made of
visible rows only, so aggregates, shares and grand totals hold nothing of other entities.  Lists that all entities share
pass whole; a contract on neither list is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: item types and their tables
ITEM_TABLES = {
    "Computer": "computers", "NetworkEquipment": "networkequipments", "Monitor": "monitors", "Printer": "printers",
    "Phone": "phones", "Peripheral": "peripherals", "Ticket": "tickets", "Problem": "problems", "Change": "changes",
    "Project": "projects", "Software": "softwares", "Rack": "racks", "Contract": "contracts",
}
# FIXED VALUES: contracts with an entity of their own (column)
OWN = {**dict.fromkeys((
    "tickets", "computers", "networkequipments", "monitors", "printers", "phones", "peripherals", "racks", "softwares", "contracts",
    "problems", "changes", "projects"), "entities_id"), "entities": "id"}
# FIXED VALUES: contracts whose rows belong to one parent or several (column, parent); all of them must be visible
PARENTS = {
    "tickets_users": [("tickets_id", "tickets")], "groups_tickets": [("tickets_id", "tickets")], "tickettasks": [("tickets_id", "tickets")],
    "ticketsatisfactions": [("tickets_id", "tickets")], "items_tickets": [("tickets_id", "tickets")], "items_racks": [("racks_id", "racks")],
    "softwareversions": [("softwares_id", "softwares")], "softwarelicenses": [("softwares_id", "softwares")],
    "contracts_suppliers": [("contracts_id", "contracts")], "contracts_items": [("contracts_id", "contracts")],
    "problems_tickets": [("problems_id", "problems"), ("tickets_id", "tickets")], "problems_users": [("problems_id", "problems")],
    "groups_problems": [("problems_id", "problems")], "items_problems": [("problems_id", "problems")],
    "changes_tickets": [("changes_id", "changes"), ("tickets_id", "tickets")], "changes_users": [("changes_id", "changes")],
    "changes_items": [("changes_id", "changes")], "changetasks": [("changes_id", "changes")], "projecttasks": [("projects_id", "projects")],
    "projecttasks_tickets": [("projecttasks_id", "projecttasks"), ("tickets_id", "tickets")], "projectteams": [("projects_id", "projects")],
    "itils_projects": [("projects_id", "projects")],
}
# FIXED VALUES: contracts whose rows belong to the item of (itemtype, items_id), besides their parents
ITEM_LINKS = {
    "itilfollowups", "items_tickets", "infocoms", "items_racks", "items_operatingsystems", "items_softwareversions", "contracts_items",
    "items_problems", "changes_items", "itils_projects",
}
# FIXED VALUES: lists shared by all entities
SHARED = {
    "locations", "groups", "users", "useremails", "profiles", "profiles_users", "groups_users", "itilcategories", "slas", "computertypes",
    "networkequipmenttypes", "monitortypes", "printertypes", "computermodels", "networkequipmentmodels", "monitormodels", "printermodels",
    "manufacturers", "states", "operatingsystems", "operatingsystemversions", "softwarelicensetypes", "suppliers", "suppliertypes",
    "contracttypes", "knowbaseitems", "knowbaseitemcategories", "knowbaseitems_items", "projectstates",
}


class ScopedSources:
    """``src`` with the rows of the entities in ``scope`` (a DataFrame with a column entity_id) only."""

    def __init__(self, src, scope: DataFrame):
        self._src, self._scope = src, scope.select(F.col("entity_id").alias("_scope_entity")).distinct()
        self._seen: dict[str, DataFrame] = {}

    def __contains__(self, name: str) -> bool:
        return name in self._src

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self._visible(name)
        return self._seen[name]

    def _visible(self, name: str) -> DataFrame:
        if name in SHARED:
            return self._src[name]
        if name not in OWN and name not in PARENTS and name not in ITEM_LINKS:
            raise PermissionError(f"{name} has no stated way to an entity")
        df = self._src[name]
        if name in OWN:
            df = df.join(self._scope, df[OWN[name]] == F.col("_scope_entity"), "left_semi")
        for column, parent in PARENTS.get(name, ()):
            df = df.join(self[parent].select(F.col("id").alias("_scope_parent")), F.col(column) == F.col("_scope_parent"), "left_semi")
        if name in ITEM_LINKS:
            items = None
            for kind, table in ITEM_TABLES.items():
                if table != name:
                    one = self[table].select(F.lit(kind).alias("_scope_kind"), F.col("id").alias("_scope_item"))
                    items = one if items is None else items.unionByName(one)
            df = df.join(items, (F.col("itemtype") == F.col("_scope_kind")) & (F.col("items_id") == F.col("_scope_item")), "left_semi")
        return df
