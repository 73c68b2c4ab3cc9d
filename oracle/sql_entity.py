"""Oracle SQL (DuckDB) for the entity marts V28-V33: things are listed by entity first, then counted in one pass.

Where one of several may be picked, the lowest type code (on ties) and the lowest financial record id are.
"""

from __future__ import annotations

from oracle.parts import label, share
from tessera import domains as D

SQL = {}

SQL["vw_dim_entity"] = f"""
SELECT id AS entity_id, name AS entity_name, level AS entity_level, completename AS entity_full_path,
  {label('level', D.ENTITY_TYPE_LABELS, D.ENTITY_TYPE_OTHER)} AS entity_type
FROM glpi_entities"""

SQL["vw_entity_overview"] = """
WITH owned AS (
  SELECT entities_id, 'user' AS what, NULL AS status, NULL AS hours FROM glpi_users
  UNION ALL SELECT entities_id, 'ticket', status, date_sub('hour', date, solvedate) FROM glpi_tickets WHERE is_deleted = 0
  UNION ALL SELECT entities_id, 'computer ' || split_part(name, '-', 1), NULL, NULL FROM glpi_computers WHERE is_deleted = 0
  UNION ALL SELECT entities_id, 'network', NULL, NULL FROM glpi_networkequipments WHERE is_deleted = 0
  UNION ALL SELECT entities_id, 'project', NULL, NULL FROM glpi_projects WHERE is_deleted = 0)
SELECT e.id AS entity_id, e.name AS entity_name, e.level AS entity_level,
  count(*) FILTER (WHERE what = 'user') AS total_users,
  count(*) FILTER (WHERE what = 'ticket') AS total_tickets,
  count(*) FILTER (WHERE what = 'ticket' AND status <= 3) AS open_tickets,
  count(*) FILTER (WHERE what = 'ticket' AND status >= 5) AS closed_tickets,
  round(avg(hours), 1) AS avg_resolution_hours,
  count(*) FILTER (WHERE starts_with(what, 'computer')) AS total_computers,
  count(*) FILTER (WHERE what = 'computer SRV') AS total_servers,
  count(*) FILTER (WHERE what = 'computer WS') AS total_workstations,
  count(*) FILTER (WHERE what = 'network') AS total_network_equipment,
  count(*) FILTER (WHERE what = 'project') AS total_projects
FROM glpi_entities e LEFT JOIN owned ON owned.entities_id = e.id GROUP BY ALL"""

SQL["vw_entity_sla_monthly"] = f"""
WITH by_type AS (
  SELECT entities_id, date_trunc('month', date) AS month_start, type, count(*) AS n, count(time_to_resolve) AS promised,
    count(*) FILTER (WHERE solvedate <= time_to_resolve) AS kept, count(*) FILTER (WHERE solvedate > time_to_resolve) AS broken,
    count(time_to_resolve) FILTER (WHERE solvedate IS NULL AND status < 5) AS pending
  FROM glpi_tickets WHERE is_deleted = 0 GROUP BY ALL),
months AS (
  SELECT entities_id, month_start, sum(n)::BIGINT AS total_tickets, sum(promised)::BIGINT AS tickets_with_sla,
    sum(kept)::BIGINT AS within_sla, sum(broken)::BIGINT AS breached_sla, sum(pending)::BIGINT AS pending_with_sla,
    arg_max(type, (n, -type)) AS predominant_type
  FROM by_type GROUP BY ALL)
SELECT e.id AS entity_id, e.name AS entity_name, strftime(month_start, '%Y-%m') AS year_month, total_tickets, tickets_with_sla,
  within_sla, breached_sla, pending_with_sla, {share('within_sla', 'within_sla + breached_sla', 1)} AS sla_compliance_pct,
  predominant_type
FROM months INNER JOIN glpi_entities e ON e.id = months.entities_id"""

# Stock: what stands in an entity, with its kind; a computer of another name counts in the total only.
_STOCK = "\n  UNION ALL ".join(
    [f"""SELECT entities_id, id, 'Computer' AS itemtype,
    MAP {{'SRV': '{D.ASSET_KIND_SERVER}', 'WS': '{D.ASSET_KIND_WORKSTATION}'}}[split_part(name, '-', 1)] AS kind
  FROM glpi_computers WHERE is_deleted = 0"""]
    + [f"SELECT entities_id, id, {itemtype}, '{kind}' FROM glpi_{table} WHERE is_deleted = 0" for table, itemtype, kind in (
        ("networkequipments", "'NetworkEquipment'", D.ASSET_KIND_NETWORK), ("monitors", "'Monitor'", D.ASSET_KIND_MONITOR),
        ("printers", "'Printer'", D.ASSET_KIND_PRINTER), ("phones", "NULL", D.ASSET_KIND_PHONE),
        ("peripherals", "NULL", D.ASSET_KIND_PERIPHERAL))])

SQL["vw_entity_asset_distribution"] = f"""
WITH stock AS ({_STOCK}),
price AS (SELECT itemtype, items_id, arg_min(value, id) AS value FROM glpi_infocoms GROUP BY ALL),
held AS (
  SELECT entities_id, kind, count(*) AS total_assets, round(CAST(sum(coalesce(value, 0)) AS DOUBLE), 2) AS total_value_brl
  FROM stock LEFT JOIN price ON price.itemtype = stock.itemtype AND price.items_id = stock.id GROUP BY ALL),
everything AS (SELECT count(*) AS n FROM stock)
SELECT e.id AS entity_id, e.name AS entity_name, kind AS asset_type, total_assets, total_value_brl,
  {share('total_assets', 'everything.n', 1)} AS pct_of_total_assets
FROM held INNER JOIN glpi_entities e ON e.id = held.entities_id, everything WHERE kind IS NOT NULL"""

SQL["vw_entity_project_performance"] = """
WITH tasks AS (SELECT projects_id, count(*) AS n, count(*) FILTER (WHERE percent_done = 100) AS whole
               FROM glpi_projecttasks GROUP BY projects_id),
linked AS (SELECT projects_id, count(*) AS n FROM glpi_itils_projects WHERE itemtype = 'Ticket' GROUP BY projects_id)
SELECT home.id AS entity_id, home.name AS entity_name, pr.id AS project_id, pr.name AS project_name, pr.percent_done,
  pr.plan_start_date AS planned_start, pr.plan_end_date AS planned_end, pr.real_start_date AS real_start,
  pr.real_end_date AS real_end, pr.projectstates_id AS project_state_id, pr.code AS project_code,
  ifnull(tasks.n, 0) AS total_tasks, ifnull(tasks.whole, 0) AS completed_tasks, ifnull(linked.n, 0) AS linked_tickets, 0 AS budget_id
FROM glpi_entities home INNER JOIN glpi_projects pr ON pr.entities_id = home.id AND pr.is_deleted = 0
LEFT JOIN tasks ON tasks.projects_id = pr.id LEFT JOIN linked ON linked.projects_id = pr.id"""

SQL["vw_rack_inventory"] = """
WITH gear AS (
  SELECT 'Computer' AS itemtype, id, name, serial FROM glpi_computers
  UNION ALL SELECT 'NetworkEquipment', id, name, serial FROM glpi_networkequipments),
trouble AS (
  SELECT itemtype, items_id, count(*) AS n, max(date) AS latest FROM glpi_items_tickets
  INNER JOIN (SELECT id AS tickets_id, date FROM glpi_tickets WHERE type = 1 AND is_deleted = 0) USING (tickets_id)
  GROUP BY itemtype, items_id),
cabinet AS (
  SELECT r.id AS racks_id, r.name AS rack_name, e.name AS entity_name, place.name AS location_name, r.number_units, r.max_power
  FROM glpi_entities e INNER JOIN glpi_racks r ON r.entities_id = e.id LEFT JOIN glpi_locations place ON place.id = r.locations_id)
SELECT racks_id AS rack_id, rack_name, entity_name, location_name, number_units AS rack_units, max_power AS max_power_w,
  slot.position AS unit_position, slot.itemtype, gear.name AS asset_name, gear.serial AS asset_serial,
  ifnull(trouble.n, 0) AS incident_count, trouble.latest AS last_incident_date, slot.bgcolor AS slot_color
FROM cabinet INNER JOIN glpi_items_racks slot USING (racks_id)
LEFT JOIN gear ON gear.itemtype = slot.itemtype AND gear.id = slot.items_id
LEFT JOIN trouble ON trouble.itemtype = slot.itemtype AND trouble.items_id = slot.items_id"""
