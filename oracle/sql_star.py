"""Oracle SQL of the relationship graph and of scoped marts.

Scoped marts are the marts' own SQL over tables that were filtered first: ``seen_x`` stands for ``glpi_x``.
"""

from __future__ import annotations

import re

from oracle.sql_analytics import marts, r
from oracle.sql_entity import SQL as ENTITY
from oracle.sql_finance import SQL as FINANCE
from oracle.sql_tickets import SQL as TICKETS

SQL = {}

SQL["star_backlog_by_dimension"] = marts(b="vw_backlog_open", f="vw_fact_tickets", c="vw_dim_category", e="vw_dim_entity", d="dim_date") + """
SELECT c.category_parent, e.entity_type, count(*) AS open_tickets, CAST(sum(b.age_days) AS BIGINT) AS age_days, count(b.sla_due_at) AS with_sla
FROM b JOIN f ON b.ticket_id = f.ticket_id JOIN d ON d.date = f.created_date AND d.is_workday = 1
LEFT JOIN c ON c.id = f.category_id LEFT JOIN e ON e.entity_id = f.entity_id GROUP BY 1, 2"""

SQL["star_productivity_by_team"] = marts(p="vw_tech_productivity", t="vw_dim_technician") + """,
team AS (SELECT id, min(group_id) AS group_id FROM t WHERE group_id > 0 GROUP BY id)
SELECT team.group_id, p.yr, CAST(sum(tickets_assigned) AS BIGINT) AS tickets_assigned, CAST(sum(tickets_resolved) AS BIGINT) AS tickets_resolved,
  count(DISTINCT technician_id) AS technicians
FROM p JOIN team ON team.id = p.technician_id GROUP BY 1, 2"""

SQL["star_financials_by_supplier"] = marts(f="vw_fact_asset_financials", s="vw_dim_supplier") + """,
firm AS (SELECT supplier_name, min({'a': supplier_type, 'b': state}) AS x FROM s GROUP BY supplier_name)
SELECT x.a AS supplier_type, x.b AS state, count(*) AS assets, round(sum(purchase_value), 2) AS purchase_value
FROM f JOIN firm ON f.supplier = firm.supplier_name WHERE f.supplier IN (SELECT supplier_name FROM s WHERE is_active = 1) GROUP BY 1, 2"""

SQL["star_tickets_by_date_role"] = marts(t="vw_glpi_tickets", d="dim_date") + """,
days AS (SELECT 'opened' AS date_role, CAST(created_at AS DATE) AS day FROM t UNION ALL SELECT 'resolved', CAST(resolved_at AS DATE) FROM t
         UNION ALL SELECT 'closed', CAST(closed_at AS DATE) FROM t)
SELECT date_role, d.year, d.quarter, count(*) AS total_tickets FROM days JOIN d ON d.date = days.day WHERE d.is_weekend = 0 GROUP BY 1, 2, 3"""

SQL["star_problems_and_changes_by_quarter"] = marts(p="vw_fact_problems", c="vw_fact_changes", e="vw_dim_entity", d="dim_date") + """,
rows AS (SELECT open_date, entity_id, 1 AS problems, linked_assets AS problems_assets, 0 AS changes, 0 AS changes_assets FROM p
         UNION ALL SELECT open_date, entity_id, 0, 0, 1, linked_assets FROM c)
SELECT d.year, d.quarter, e.entity_type, CAST(sum(problems) AS BIGINT) AS problems, CAST(sum(problems_assets) AS BIGINT) AS problems_assets,
  CAST(sum(changes) AS BIGINT) AS changes, CAST(sum(changes_assets) AS BIGINT) AS changes_assets
FROM rows LEFT JOIN d ON d.date = CAST(rows.open_date AS DATE) LEFT JOIN e ON e.entity_id = rows.entity_id GROUP BY 1, 2, 3"""

SQL["ticket_enrichment_match"] = marts(f="vw_fact_tickets", n="vw_fact_ticket_enrichment") + f"""
SELECT CASE WHEN n.ticket_id IS NULL THEN 'left_only' WHEN f.ticket_id IS NULL THEN 'right_only' ELSE 'ok' END AS match, f.priority_code,
  count(*) AS tickets, CAST(sum(n.followup_count) AS BIGINT) AS followups, CAST(sum(n.task_count) AS BIGINT) AS tasks,
  {r('avg(n.satisfaction)')} AS avg_satisfaction, {r('avg(f.resolution_min)')} AS avg_resolution_min
FROM f FULL OUTER JOIN n ON f.ticket_id = n.ticket_id GROUP BY 1, 2"""

_KINDS = {"Computer": "computers", "NetworkEquipment": "networkequipments", "Monitor": "monitors", "Printer": "printers", "Phone": "phones",
          "Peripheral": "peripherals", "Ticket": "tickets", "Problem": "problems", "Change": "changes", "Project": "projects",
          "Software": "softwares", "Rack": "racks", "Contract": "contracts"}
_SEEN = {
    **{t: "entities_id IN (SELECT id FROM sc)" for t in _KINDS.values()},
    "entities": "id IN (SELECT id FROM sc)",
    **{t: "tickets_id IN (SELECT id FROM seen_tickets)" for t in ("tickets_users", "groups_tickets", "ticketsatisfactions")},
    "contracts_suppliers": "contracts_id IN (SELECT id FROM seen_contracts)",
}
_ITEMS = {"infocoms": "true", "items_operatingsystems": "true", "items_racks": "racks_id IN (SELECT id FROM seen_racks)",
          "items_tickets": "tickets_id IN (SELECT id FROM seen_tickets)", "contracts_items": "contracts_id IN (SELECT id FROM seen_contracts)"}


def scoped(body: str, region: str = "AMERICA") -> str:
    """A mart's SQL over the rows of one region, of what is below it and of the head office."""
    parts = [f"home AS (SELECT id, entities_id AS above FROM glpi_entities WHERE name = '{region}')",
             "sc AS (SELECT id FROM home UNION SELECT above FROM home UNION SELECT e.id FROM glpi_entities e JOIN home ON e.entities_id = home.id)"]
    parts += [f"seen_{t} AS (SELECT * FROM glpi_{t} WHERE {rule})" for t, rule in _SEEN.items()]
    parts += ["seen_items AS (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, id FROM seen_{t}" for k, t in _KINDS.items()) + ")"]
    parts += [f"seen_{t} AS (SELECT * FROM glpi_{t} WHERE {rule} AND (itemtype, items_id) IN (SELECT (kind, id) FROM seen_items))" for t, rule in _ITEMS.items()]
    body = re.sub(r"\bglpi_(\w+)", lambda m: f"seen_{m[1]}" if m[1] in _SEEN or m[1] in _ITEMS else m[0], body.strip())
    rest = ",\n" + body[4:] if body[:4].upper() == "WITH" else "\n" + body
    return "WITH " + ",\n".join(parts) + rest


for _mart, _from in (("vw_tech_productivity", TICKETS), ("vw_rack_inventory", ENTITY), ("vw_dim_os_inventory", FINANCE), ("vw_fact_asset_financials", FINANCE),
                     ("vw_fact_supplier_contracts", FINANCE), ("vw_fact_satisfaction_summary", FINANCE), ("vw_entity_asset_distribution", ENTITY)):
    SQL[f"scope_{_mart.removeprefix('vw_')}"] = scoped(_from[_mart])
