"""Oracle SQL of what the refresh and the versioned tables end with: the same marts and rows, made at once."""

from __future__ import annotations

from oracle.parts import ROLES, TICKET
from oracle.sql_tickets import SQL as TICKETS

SQL = {"refresh_sla_monthly": TICKETS["vw_sla_monthly"]}

SQL["refresh_resolution_monthly"] = f"""
WITH {TICKET}, {ROLES},
timed AS (SELECT strftime(opened, '%Y-%m') AS year_month, count(*) AS resolved_tickets,
                 round(quantile_cont(minutes, 0.5), 4) AS median_resolution_min, round(quantile_cont(minutes, 0.9), 4) AS p90_resolution_min
          FROM facts WHERE minutes IS NOT NULL GROUP BY 1),
busy AS (SELECT strftime(opened, '%Y-%m') AS year_month, count(DISTINCT technician) AS active_technicians
         FROM facts JOIN roles ON roles.tickets_id = facts.id GROUP BY 1)
SELECT timed.year_month, resolved_tickets, median_resolution_min, p90_resolution_min, coalesce(active_technicians, 0) AS active_technicians
FROM timed LEFT JOIN busy ON timed.year_month = busy.year_month"""

SQL["snapshot_derived_entity"] = """
WITH held AS (
  SELECT 'infocoms' AS source_table, itemtype, items_id FROM glpi_infocoms
  UNION ALL SELECT 'items_softwareversions', itemtype, items_id FROM glpi_items_softwareversions
  UNION ALL SELECT 'items_operatingsystems', itemtype, items_id FROM glpi_items_operatingsystems),
seen AS (
  SELECT source_table, CAST(NULL AS BIGINT) AS entities_id, 1 AS old, 0 AS new FROM held
  UNION ALL SELECT source_table, c.entities_id, 0, 1 FROM held LEFT JOIN glpi_computers c ON itemtype = 'Computer' AND c.id = items_id)
SELECT source_table, entities_id, CAST(sum(old) AS BIGINT) AS rows_before, CAST(sum(new) AS BIGINT) AS rows_after FROM seen GROUP BY 1, 2"""
