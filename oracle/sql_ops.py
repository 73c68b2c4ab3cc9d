"""Oracle SQL (DuckDB) for quality, backfill, catalogue jobs and the
batch twin of the streaming volume query."""

from __future__ import annotations

from oracle.sql_analytics import MART_SQL
from tessera.plans.catalog import MARTS
from tessera.plans.quality import ENTITY_TABLES, EXPECTED_ENTITIES, VOLUME_TABLES
from tessera.sources.contracts import CONTRACT_TABLES

SQL = {}


# A rule is a list of references (table, what, id); a reference to what is not known breaks it.
_ENTITY_REFS = "\n  UNION ALL ".join(
    f"SELECT 'Q1_entity_orphan' AS rule, '{t}' AS tab, 'entity' AS what, entities_id AS ref FROM glpi_{t}"
    + (" WHERE id > 2" if t == "users" else "") for t in ENTITY_TABLES)
_SPINE = [("Q1_entity_orphan", t) for t in ENTITY_TABLES] + [
    ("Q2_ticket_without_requester", "tickets"), ("Q2_ticket_entity_zero_or_unknown", "tickets"),
    ("Q3_rack_slot_unknown_rack", "items_racks"), ("Q3_rack_slot_unknown_computers", "items_racks"),
    ("Q3_rack_slot_unknown_networkequipments", "items_racks"), ("Q4_unknown_computer", "items_softwareversions"),
    ("Q4_unknown_computer", "items_operatingsystems")]

REPORT = f"""
WITH spine AS (SELECT * FROM (VALUES {", ".join(str(r) for r in _SPINE)}) v(rule, tab)),
refs AS (
  {_ENTITY_REFS}
  UNION ALL SELECT 'Q2_ticket_without_requester', 'tickets', 'asked ticket', id FROM glpi_tickets
  UNION ALL SELECT 'Q2_ticket_entity_zero_or_unknown', 'tickets', 'entity but zero', entities_id FROM glpi_tickets
  UNION ALL SELECT 'Q3_rack_slot_unknown_rack', 'items_racks', 'rack', racks_id FROM glpi_items_racks
  UNION ALL SELECT MAP {{'Computer': 'Q3_rack_slot_unknown_computers',
      'NetworkEquipment': 'Q3_rack_slot_unknown_networkequipments'}}[itemtype], 'items_racks', itemtype, items_id FROM glpi_items_racks
  UNION ALL SELECT 'Q4_unknown_computer', 'items_softwareversions', itemtype, items_id FROM glpi_items_softwareversions
    WHERE itemtype = 'Computer'
  UNION ALL SELECT 'Q4_unknown_computer', 'items_operatingsystems', itemtype, items_id FROM glpi_items_operatingsystems
    WHERE itemtype = 'Computer'),
known AS (
  SELECT 'entity' AS what, id FROM glpi_entities UNION SELECT 'entity but zero', id FROM glpi_entities WHERE id <> 0
  UNION SELECT 'asked ticket', tickets_id FROM glpi_tickets_users WHERE type = 1 UNION SELECT 'rack', id FROM glpi_racks
  UNION SELECT 'Computer', id FROM glpi_computers UNION SELECT 'NetworkEquipment', id FROM glpi_networkequipments),
broken AS (SELECT rule, tab, count(*) AS n FROM refs LEFT JOIN known ON known.what = refs.what AND known.id = refs.ref
           WHERE known.id IS NULL GROUP BY rule, tab)
SELECT rule, tab AS "table", 'error' AS severity, ifnull(n, 0) AS violations FROM spine LEFT JOIN broken USING (rule, tab)
UNION ALL SELECT 'Q5_expected_entities', 'entities', CASE WHEN n = {EXPECTED_ENTITIES} THEN 'ok' ELSE 'warning' END,
  CAST(abs(n - {EXPECTED_ENTITIES}) AS BIGINT) FROM (SELECT count(*) AS n FROM glpi_entities)"""

SQL["quality_integrity_report"] = REPORT

SQL["quality_integrity_status"] = f"""
SELECT CAST(sum(CASE WHEN severity = 'error' AND violations > 0 THEN 1 ELSE 0 END) AS BIGINT) AS errors,
  CAST(sum(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS warnings,
  CASE WHEN sum(CASE WHEN severity = 'error' AND violations > 0 THEN 1 ELSE 0 END) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM ({REPORT}) r"""

SQL["quality_volume_matrix"] = "\nUNION ALL ".join(
    f"""SELECT '{label}' AS resource, v.entity_id, e.name AS entity_name, v.records,
      CASE WHEN e.id IS NULL THEN 1 ELSE 0 END AS orphan
    FROM (SELECT entities_id AS entity_id, count(*) AS records FROM glpi_{table}
          {'WHERE id > 2' if table == 'users' else ''} GROUP BY entities_id) v
    LEFT JOIN glpi_entities e ON e.id = v.entity_id""" for label, table in VOLUME_TABLES)

SQL["backfill_ticket_entity"] = """
SELECT t.id AS ticket_id, t.entities_id AS entities_id_before, coalesce(n.new, t.entities_id) AS entities_id,
  CAST(coalesce(n.new, t.entities_id) IS DISTINCT FROM t.entities_id AS INTEGER) AS changed
FROM glpi_tickets t
LEFT JOIN (SELECT tu.tickets_id, arg_min(u.entities_id, u.id) AS new
           FROM glpi_tickets_users tu JOIN glpi_users u ON u.id = tu.users_id
           WHERE tu.type = 1 AND u.entities_id NOT IN (0, 1, 2, 3) GROUP BY tu.tickets_id) n ON n.tickets_id = t.id"""

SQL["backfill_derived_entity"] = """
WITH held AS (
  SELECT 'infocoms' AS source_table, id AS row_id, itemtype, items_id FROM glpi_infocoms
  UNION ALL SELECT 'items_softwareversions', id, itemtype, items_id FROM glpi_items_softwareversions
  UNION ALL SELECT 'items_operatingsystems', items_id, itemtype, items_id FROM glpi_items_operatingsystems)
SELECT source_table, CAST(row_id AS BIGINT) AS row_id, itemtype, items_id, CAST(NULL AS BIGINT) AS entities_id_before,
  (SELECT max(c.entities_id) FROM glpi_computers c WHERE held.itemtype = 'Computer' AND c.id = held.items_id) AS entities_id
FROM held"""

SQL["backfill_phone_peripheral_entity"] = "\nUNION ALL ".join(
    f"""SELECT '{kind}' AS kind, a.id AS asset_id, a.entities_id AS entities_id_before,
      CAST(CASE WHEN u.entities_id IS NOT NULL AND u.entities_id NOT IN (0, 1, 2, 3) THEN u.entities_id
                ELSE a.entities_id END AS BIGINT) AS entities_id
    FROM glpi_{table} a LEFT JOIN glpi_users u ON u.id = a.users_id AND a.users_id > 0"""
    for kind, table in (("Phone", "phones"), ("Peripheral", "peripherals")))

SQL["backfill_contract_entity"] = """
SELECT c.id AS contract_id, c.entities_id AS entities_id_before,
  coalesce(s.entities_id, c.entities_id) AS entities_id
FROM glpi_contracts c
LEFT JOIN (SELECT contracts_id, min(suppliers_id) AS sid FROM glpi_contracts_suppliers GROUP BY contracts_id) f
  ON f.contracts_id = c.id
LEFT JOIN glpi_suppliers s ON s.id = f.sid"""

SQL["deploy_verify"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS mart, (SELECT count(*) FROM ({MART_SQL[name]})) AS rows" for name, _b, _g in MARTS)

SQL["profile_tables"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", (SELECT CAST(len(json_keys(to_json(x))) AS INTEGER) FROM glpi_{t} x LIMIT 1) AS columns, "
    f"(SELECT count(*) FROM glpi_{t}) AS rows" for t in CONTRACT_TABLES)

SQL["stream_event_volume_hourly"] = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
  event_type, count(*) AS events, round(sum(value), 4) AS value_sum
FROM events GROUP BY 1, 2, 3"""

SQL["stream_event_volume_sliding"] = """
SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS events,
  round(sum(value), 4) AS value_sum
FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS ws, event_type, value FROM events
      UNION ALL SELECT time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE, event_type, value FROM events)
GROUP BY 1, 2, 3"""


_OWNED = ("users", "tickets", "computers", "networkequipments", "monitors", "printers", "phones", "peripherals", "racks", "softwares", "suppliers",
          "contracts", "problems", "changes", "projects")
SQL["profile_by_entity"] = "WITH held AS (" + " UNION ALL ".join(f"SELECT '{t}' AS tab, entities_id FROM glpi_{t}" for t in _OWNED) + """)
SELECT tab AS "table", CAST(held.entities_id AS BIGINT) AS entity_id, e.name AS entity_name, count(*) AS rows,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY tab), 4) AS pct_of_table, CAST(e.id IS NULL AS INTEGER) AS orphan
FROM held LEFT JOIN glpi_entities e ON e.id = held.entities_id GROUP BY tab, held.entities_id, e.id, e.name"""


def _null_keys() -> str:
    from tessera.sources.schemas import COLUMNS, required
    return "\nUNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls FROM glpi_{t} HAVING count(*) > 0"
                               for t in COLUMNS for c in required(t))


SQL["contract_null_keys"] = _null_keys()
