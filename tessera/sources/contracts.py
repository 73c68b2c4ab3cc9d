"""Names of the service-desk source contracts (the ``glpi_*`` tables)."""

# FIXED VALUES: contract table names read by the marts, jobs and checks
CONTRACT_TABLES = (
    "entities", "locations", "groups", "users", "useremails", "profiles", "profiles_users", "groups_users",
    "tickets", "tickets_users", "groups_tickets", "itilcategories", "slas", "itilfollowups", "tickettasks",
    "ticketsatisfactions", "computers", "networkequipments", "monitors", "printers", "phones", "peripherals",
    "computertypes", "networkequipmenttypes", "monitortypes", "printertypes", "computermodels",
    "networkequipmentmodels", "monitormodels", "printermodels", "manufacturers", "states", "items_tickets",
    "infocoms", "items_racks", "racks", "operatingsystems", "operatingsystemversions", "items_operatingsystems",
    "softwares", "softwareversions", "softwarelicenses", "softwarelicensetypes", "items_softwareversions",
    "suppliers", "suppliertypes", "contracts", "contracttypes", "contracts_suppliers", "contracts_items",
    "knowbaseitems", "knowbaseitemcategories", "knowbaseitems_items", "problems", "changes", "problems_tickets",
    "problems_users", "groups_problems", "items_problems", "changes_tickets", "changes_users", "changes_items",
    "changetasks", "projects", "projectstates", "projecttasks", "projecttasks_tickets", "projectteams",
    "itils_projects",
)
