"""Oracle SQL (DuckDB) for the page queries G1-G27."""

from __future__ import annotations

from oracle.adapter_sql import AS_OF_SQL
from oracle.sql_analytics import NOW, TODAY, cnt, div, icon, marts, r
from tessera import domains as D

SQL = {}

MET = f"sla_status = '{D.SLA_MET}'"
BRE = f"sla_status IN ('{D.SLA_BREACHED}', '{D.SLA_BREACHED_OPEN}')"
SLA_PCT = f"round(100.0 * {div(cnt(MET), cnt(MET) + ' + ' + cnt(BRE))}, 2)"


def band(x: str, low: float, high: float) -> str:
    return (f"(CASE WHEN {x} >= {high} THEN 'green' WHEN {x} >= {low} THEN 'yellow' "
            f"WHEN {x} IS NOT NULL THEN 'red' END)")


SQL["page_kpi_strip"] = marts(tk="vw_glpi_tickets", ss="vw_fact_satisfaction_summary") + f""",
a AS (SELECT count(*) AS total_tickets, {cnt('is_open = 1')} AS open_tickets,
        {div(cnt(MET), cnt(MET) + ' + ' + cnt(BRE))} AS rate, avg(resolution_time_min) / 60.0 AS mttr,
        {cnt(f"is_open = 1 AND date_diff('day', CAST(created_at AS DATE), {TODAY}) > 7")} AS aged_tickets_7d FROM tk),
s AS (SELECT avg(avg_satisfaction) AS avg_satisfaction_score FROM ss)
SELECT total_tickets, open_tickets, {r('rate')} AS sla_compliance_rate, {r('mttr')} AS avg_resolution_hrs,
  aged_tickets_7d, {r('avg_satisfaction_score')} AS avg_satisfaction_score,
  CAST(open_tickets > 100 AS INTEGER) AS open_alert,
  CASE WHEN rate >= 0.9 THEN 'green' WHEN rate >= 0.8 THEN 'yellow' ELSE 'red' END AS sla_band,
  CASE WHEN mttr > 48 THEN 'red' WHEN mttr > 24 THEN 'yellow' ELSE 'green' END AS mttr_band
FROM a, s"""

SQL["page_monthly_volume_sla"] = marts(vt="vw_volume_trend", sm="vw_sla_monthly") + f""",
s AS (SELECT year_month, round(100.0 * {div('sum(within_sla)', 'sum(tickets_with_sla_resolved)')}, 2) AS sla_compliance_pct
      FROM sm GROUP BY year_month)
SELECT year_month, tickets_created, tickets_resolved, sla_compliance_pct,
  round(avg_resolution_min / 60.0, 4) AS avg_resolution_hrs FROM vt LEFT JOIN s USING (year_month)"""

SQL["page_status_mix"] = marts(tk="vw_glpi_tickets") + """
SELECT status_code, status_label, count(*) AS tickets FROM tk GROUP BY status_code, status_label"""

SQL["page_entity_treemap"] = marts(ft="vw_fact_tickets", de="vw_dim_entity") + f"""
SELECT entity_id, de.entity_name, count(*) AS total_tickets, {cnt('is_open = 1')} AS open_tickets,
  {SLA_PCT} AS sla_compliance_pct
FROM ft LEFT JOIN de USING (entity_id) GROUP BY entity_id, de.entity_name"""

SQL["page_top_categories"] = marts(tk="vw_glpi_tickets") + f"""
SELECT category_name, count(*) AS total_tickets, {cnt('is_open = 1')} AS open_tickets,
  {cnt('is_resolved = 1')} AS closed_tickets, {SLA_PCT} AS sla_pct,
  round(avg(resolution_time_min) / 60.0, 4) AS avg_resolution_hrs,
  {cnt("created_year_month = '2001-08'")} AS this_month, {cnt("created_year_month = '2001-07'")} AS last_month,
  CASE WHEN {cnt("created_year_month = '2001-08'")} > {cnt("created_year_month = '2001-07'")} THEN '↑'
       WHEN {cnt("created_year_month = '2001-08'")} < {cnt("created_year_month = '2001-07'")} THEN '↓' ELSE '→' END AS trend
FROM tk GROUP BY category_name ORDER BY total_tickets DESC, category_name LIMIT 5"""

SQL["page_entity_sla_trend"] = marts(es="vw_entity_sla_monthly") + """
SELECT entity_name, year_month, within_sla, breached_sla, total_tickets, sla_compliance_pct,
  CAST(sla_compliance_pct < 90 AS INTEGER) AS below_target FROM es"""

SQL["page_sla_by_category"] = marts(tk="vw_glpi_tickets") + f"""
SELECT category_name, pct AS sla_compliance_pct, {band('pct', 70.0, 90.0)} AS band
FROM (SELECT category_name, {SLA_PCT} AS pct FROM tk GROUP BY category_name)"""

SQL["page_sla_matrix"] = marts(tk="vw_glpi_tickets") + ",\ncell AS (SELECT assigned_group_name, CASE WHEN priority_code IN (" + \
    ", ".join(str(p) for p in D.PRIORITY_LABELS) + ") THEN priority_code ELSE -1 END AS priority_code, " + \
    f"{SLA_PCT} AS v FROM tk GROUP BY 1, 2)\nSELECT assigned_group_name, " + ", ".join(
        f"max(CASE WHEN priority_code = {p} THEN v END) AS p{p}" for p in D.PRIORITY_LABELS) + \
    ", max(CASE WHEN priority_code = -1 THEN v END) AS p_other FROM cell GROUP BY assigned_group_name"

SQL["page_recent_breaches"] = marts(tk="vw_glpi_tickets", ds="vw_dim_sla") + f"""
SELECT ticket_id, ticket_title, priority_label, assigned_group_name, created_at, sla_status,
  coalesce(resolution_time_min, age_open_min) AS elapsed_min,
  round((coalesce(resolution_time_min, age_open_min) - ds.sla_target_min) / 60.0, 4) AS excess_hours
FROM tk LEFT JOIN ds ON ds.id = tk.sla_id
WHERE {BRE} AND sla_due_at > {NOW} - INTERVAL 30 DAY AND sla_due_at <= {NOW}
ORDER BY excess_hours DESC NULLS LAST, ticket_id LIMIT 20"""

SQL["page_at_risk"] = marts(tk="vw_glpi_tickets") + f"""
SELECT ticket_id, ticket_title, priority_label, assigned_group_name, sla_due_at,
  date_sub('hour', {NOW}, sla_due_at) AS hours_left FROM tk WHERE sla_status = '{D.SLA_AT_RISK}'"""

SQL["page_category_type"] = marts(tk="vw_glpi_tickets") + """,
top AS (SELECT category_name, count(*) AS total_tickets FROM tk GROUP BY category_name
        ORDER BY total_tickets DESC, category_name LIMIT 10)
SELECT category_name, top.total_tickets, count(*) FILTER (WHERE ticket_type_code = 1) AS incidents,
  count(*) FILTER (WHERE ticket_type_code = 2) AS requests,
  count(*) FILTER (WHERE ticket_type_code IS NULL OR ticket_type_code NOT IN (1, 2)) AS others
FROM tk JOIN top USING (category_name) GROUP BY category_name, top.total_tickets"""

SQL["page_lifecycle_funnel"] = marts(tk="vw_glpi_tickets") + f""",
a AS (SELECT count(*) AS s1, {cnt('technician_id IS NOT NULL')} AS s2, {cnt('status_code IN (2, 3)')} AS s3,
        {cnt('status_code = 4')} AS s4, {cnt('status_code IN (5, 6)')} AS s5, {cnt('status_code = 6')} AS s6 FROM tk)
SELECT 1 AS stage_order, 'Criado' AS stage, s1 AS tickets FROM a
UNION ALL SELECT 2, 'Atribuído', s2 FROM a UNION ALL SELECT 3, 'Em andamento', s3 FROM a
UNION ALL SELECT 4, 'Pendente', s4 FROM a UNION ALL SELECT 5, 'Resolvido', s5 FROM a
UNION ALL SELECT 6, 'Fechado', s6 FROM a"""

SQL["page_backlog_histogram"] = marts(bk="vw_backlog_open") + """
SELECT bucket_order, bucket, count(*) AS tickets, CAST(bucket_order >= 4 AS INTEGER) AS alert FROM (
  SELECT CASE WHEN age_days <= 1 THEN 1 WHEN age_days <= 7 THEN 2 WHEN age_days <= 30 THEN 3 WHEN age_days <= 90 THEN 4
              ELSE 5 END AS bucket_order,
         CASE WHEN age_days <= 1 THEN '0-1 dia' WHEN age_days <= 7 THEN '2-7 dias' WHEN age_days <= 30 THEN '8-30 dias'
              WHEN age_days <= 90 THEN '31-90 dias' ELSE '> 90 dias' END AS bucket FROM bk)
GROUP BY bucket_order, bucket"""

SQL["page_backlog_table"] = marts(bk="vw_backlog_open") + """
SELECT ticket_id, priority_label, category_name, assigned_group, technician_name, age_days,
  CASE WHEN age_days > 30 THEN 'red' WHEN age_days > 7 THEN 'yellow' END AS row_alert,
  CAST(priority_code IN (4, 5) AS INTEGER) AS urgent FROM bk"""

SQL["page_open_problems"] = marts(pr="vw_fact_problems") + """
SELECT DISTINCT problem_id, problem_name, linked_tickets, status_label, open_date FROM pr WHERE status_code <> 6"""

SQL["page_changes_in_progress"] = marts(ch="vw_fact_changes") + """
SELECT DISTINCT change_id, change_name, status_label, linked_tickets FROM ch WHERE status_code NOT IN (5, 6)"""

TECH = f"""ts AS (SELECT technician_id, technician_name, technician_group, {cnt('is_resolved = 1')} AS tickets_closed,
        {cnt('is_open = 1')} AS tickets_open, round(avg(resolution_time_min) / 60.0, 4) AS mttr_hours,
        {SLA_PCT} AS sla_pct
      FROM tk WHERE technician_id IS NOT NULL GROUP BY technician_id, technician_name, technician_group)"""

SQL["page_technician_ranking"] = marts(tk="vw_glpi_tickets") + f""",
{TECH},
g AS (SELECT avg(tickets_closed) AS m, max(mttr_hours) AS mx, min(sla_pct) AS mn FROM ts)
SELECT CAST(rank() OVER (ORDER BY tickets_closed DESC) AS BIGINT) AS rank, technician_id, technician_name,
  technician_group, tickets_closed, tickets_open, {r('mttr_hours')} AS mttr_hours, {r('sla_pct')} AS sla_pct,
  {r('tickets_closed - m')} AS gap_to_mean,
  CASE WHEN tickets_closed > 2 * m THEN 'red' WHEN tickets_closed > 1.5 * m THEN 'yellow' ELSE 'green' END AS load_color,
  CAST(sla_pct < 70 AS INTEGER) AS sla_alert, CAST(mttr_hours = mx AS INTEGER) AS is_max_mttr,
  CAST(sla_pct = mn AS INTEGER) AS is_worst_sla
FROM ts, g"""

SQL["page_volume_mttr_quadrants"] = marts(tk="vw_glpi_tickets") + f""",
{TECH},
f AS (SELECT * FROM ts WHERE mttr_hours IS NOT NULL),
g AS (SELECT quantile_cont(tickets_closed, 0.5) AS mv, quantile_cont(mttr_hours, 0.5) AS mm FROM f)
SELECT technician_id, technician_name, tickets_closed, mttr_hours,
  CASE WHEN tickets_closed > mv AND NOT mttr_hours > mm THEN 'Eficientes'
       WHEN NOT tickets_closed > mv AND mttr_hours > mm THEN 'Precisam de apoio'
       WHEN tickets_closed > mv AND mttr_hours > mm THEN 'Sobrecarregados' ELSE 'Subutilizados' END AS quadrant
FROM f, g"""

SQL["page_tech_weekday_heatmap"] = marts(tk="vw_glpi_tickets") + "\nSELECT technician_id, technician_name, " + ", ".join(
    f"count(*) FILTER (WHERE isodow(closed_at) = {d}) AS d{d}" for d in range(1, 8)) + \
    " FROM tk WHERE is_closed = 1 AND technician_id IS NOT NULL GROUP BY technician_id, technician_name"

SQL["page_weekday_volume"] = marts(tk="vw_glpi_tickets") + """,
w AS (SELECT count(DISTINCT date_trunc('week', created_at)) AS weeks FROM tk)
SELECT CAST(isodow(created_at) AS INTEGER) AS weekday, count(*) AS tickets, round(count(*) / any_value(weeks), 4) AS tickets_per_week
FROM tk, w GROUP BY 1"""

SQL["page_hour_heatmap"] = marts(pr="vw_fact_problems", ch="vw_fact_changes", tk="vw_glpi_tickets") + """,
k AS (SELECT CAST(isodow(created_at) AS INTEGER) AS weekday, CAST(hour(created_at) AS INTEGER) AS hour, count(*) AS created
      FROM tk GROUP BY 1, 2),
o AS (SELECT open_date FROM (SELECT DISTINCT problem_id, open_date FROM pr)
      UNION ALL SELECT open_date FROM (SELECT DISTINCT change_id, open_date FROM ch)),
c AS (SELECT CAST(isodow(open_date) AS INTEGER) AS weekday, CAST(hour(open_date) AS INTEGER) AS hour, count(*) AS n
      FROM o GROUP BY 1, 2),
grid AS (SELECT CAST(w AS INTEGER) AS weekday, CAST(h AS INTEGER) AS hour FROM range(1, 8) a(w), range(0, 24) b(h))
SELECT weekday, hour, coalesce(created, 0) AS tickets, coalesce(n, 0) AS records
FROM grid LEFT JOIN k USING (weekday, hour) LEFT JOIN c USING (weekday, hour)"""

SQL["page_priority_mom"] = marts(tk="vw_glpi_tickets") + f"""
SELECT priority_code, priority_label, {cnt("created_year_month = '2001-08'")} AS current_month,
  {cnt("created_year_month = '2001-07'")} AS previous_month,
  {cnt("created_year_month = '2001-08'")} - {cnt("created_year_month = '2001-07'")} AS change
FROM tk GROUP BY priority_code, priority_label"""

def _trend(unit: str, step: str, back: int, where: str = "true") -> str:
    return marts(tk="vw_glpi_tickets", dc="vw_dim_category", de="vw_dim_entity") + f""",
per AS (SELECT CAST(date_trunc('{unit}', created_at) AS DATE) AS p, count(*) AS n FROM tk WHERE {where} GROUP BY 1),
sp AS (SELECT CAST(unnest(generate_series(min(p), max(p), INTERVAL {step})) AS DATE) AS p FROM per),
s AS (SELECT p, coalesce(n, 0) AS tickets FROM sp LEFT JOIN per USING (p)),
w AS (SELECT p, tickets, avg(tickets) OVER (ORDER BY p ROWS BETWEEN {back} PRECEDING AND CURRENT ROW) AS a3,
        stddev_pop(tickets) OVER (ORDER BY p ROWS BETWEEN {back} PRECEDING AND CURRENT ROW) AS s3 FROM s)
SELECT p AS {unit}, tickets, {r('a3')} AS avg_3, {r('a3 - s3')} AS band_low, {r('a3 + s3')} AS band_high FROM w"""


SQL["page_trend_weekly"] = _trend("week", "7 DAY", 2)
SQL["page_trend_daily"] = _trend("day", "1 DAY", 6)
SQL["page_trend_monthly"] = _trend("month", "1 MONTH", 2, f"""category_id IN (SELECT id FROM dc WHERE category_level_label = '{D.CATEGORY_SUB}')
  AND entity_id IN (SELECT entity_id FROM de WHERE entity_type = 'Sub-entidade')""")

SQL["page_projection_30d"] = marts(tk="vw_glpi_tickets") + f""",
d AS (SELECT CAST(created_at AS DATE) AS date, count(*) AS n FROM tk
      WHERE CAST(created_at AS DATE) <= {TODAY} GROUP BY 1),
sp AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM d), {TODAY}, INTERVAL 1 DAY)) AS DATE) AS date),
s AS (SELECT date, CAST(coalesce(n, 0) AS DOUBLE) AS y, CAST(date - DATE '1970-01-01' AS DOUBLE) AS x
      FROM sp LEFT JOIN d USING (date)),
fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(date) AS last FROM s),
h AS (SELECT CAST(unnest(generate_series(last + 1, last + 30, INTERVAL 1 DAY)) AS DATE) AS date, a, b FROM fit)
SELECT date, {r("a + b * CAST(date - DATE '1970-01-01' AS DOUBLE)")} AS projected_tickets FROM h"""

SQL["page_entity_scorecard"] = marts(eo="vw_entity_overview", es="vw_entity_sla_monthly",
                                     ea="vw_entity_asset_distribution") + f""",
s AS (SELECT entity_id, {div('sum(within_sla)', 'sum(within_sla) + sum(breached_sla)')} AS rate FROM es GROUP BY entity_id),
a AS (SELECT entity_id, sum(total_assets) AS n FROM ea GROUP BY entity_id)
SELECT entity_id, entity_name, total_tickets, open_tickets, {r('avg_resolution_hours')} AS avg_resolution_hours,
  {r('rate')} AS sla_rate, CASE WHEN rate IS NOT NULL THEN {icon('rate')} END AS sla_icon,
  CAST(coalesce(n, 0) AS BIGINT) AS asset_count, total_projects AS project_count
FROM eo LEFT JOIN s USING (entity_id) LEFT JOIN a USING (entity_id)"""

SQL["page_asset_treemap"] = marts(ea="vw_entity_asset_distribution") + f"""
SELECT entity_name, asset_type, CAST(sum(total_assets) AS BIGINT) AS total_assets, {r('sum(total_value_brl)')} AS total_value,
  CAST(grouping(entity_name, asset_type) AS INTEGER) AS level
FROM ea GROUP BY ROLLUP (entity_name, asset_type)"""

SQL["page_top_assets"] = marts(ai="vw_fact_asset_incidents", da="vw_dim_asset", de="vw_dim_entity") + """,
top AS (SELECT * FROM ai ORDER BY total_tickets DESC, asset_key LIMIT 10)
SELECT top.asset_key, top.asset_itemtype, da.asset_name, da.asset_type, de.entity_name, top.total_tickets,
  round(top.avg_resolution_min / 60.0, 4) AS avg_resolution_hrs
FROM top LEFT JOIN da ON da.asset_key = top.asset_key LEFT JOIN de ON de.entity_id = da.entity_id"""

SQL["page_asset_kind_share"] = marts(cs="vw_cmdb_summary") + """,
k AS (SELECT asset_type AS kind, CAST(sum(total_assets) AS BIGINT) AS assets FROM cs GROUP BY asset_type
      UNION ALL SELECT 'Phone', count(*) FROM glpi_phones WHERE is_deleted = 0
      UNION ALL SELECT 'Peripheral', count(*) FROM glpi_peripherals WHERE is_deleted = 0)
SELECT kind, assets, round(100.0 * assets / (SELECT sum(assets) FROM k), 2) AS share_pct FROM k"""

SQL["page_rack_matrix"] = marts(rk="vw_rack_inventory") + """
SELECT rack_name, unit_position, asset_name, itemtype, asset_serial, incident_count,
  CAST(incident_count > 0 AS INTEGER) AS is_hot FROM rk"""

SQL["page_license_bands"] = marts(sl="vw_fact_software_licenses") + f"""
SELECT software_id, software_name, licenses_qty, installations_count, u AS utilization_pct,
  CASE WHEN u > 100 THEN 'red' WHEN u < 50 THEN 'yellow' WHEN u IS NOT NULL THEN 'green' END AS band,
  license_expiry, CAST(license_expiry < {TODAY} + 30 AS INTEGER) AS expiry_alert
FROM (SELECT *, round(100.0 * {div('installations_count', 'licenses_qty')}, 2) AS u FROM sl)"""

SQL["page_asset_drillthrough"] = marts(atk="vw_fact_asset_tickets", tk="vw_glpi_tickets") + f""",
h AS (SELECT atk.asset_key, count(*) AS tickets, min(atk.ticket_date) AS first_ticket, max(atk.ticket_date) AS last_ticket,
        sum(coalesce(tk.resolution_time_min, 0)) AS mins
      FROM atk LEFT JOIN tk ON tk.ticket_id = atk.ticket_id GROUP BY atk.asset_key),
c AS (SELECT itemtype || '-' || items_id AS asset_key, count(DISTINCT contracts_id) AS n FROM glpi_contracts_items GROUP BY 1)
SELECT h.asset_key, tickets, first_ticket, last_ticket, coalesce(n, 0) AS contracts,
  {r('mins / 60.0 * 100.0')} AS support_cost FROM h LEFT JOIN c USING (asset_key)"""

_SPANS = """spans AS (
  SELECT DISTINCT i.itemtype || '-' || i.items_id AS asset_key, c.id AS contract_id, c.name AS contract_name, CAST(c.begin_date AS DATE) AS begin_date,
    CAST(c.begin_date + to_months(c.duration) AS DATE) AS end_date
  FROM glpi_contracts_items i JOIN glpi_contracts c ON c.id = i.contracts_id WHERE c.is_deleted = 0),
linked AS (SELECT DISTINCT atk.asset_key, tk.ticket_id, tk.created_at, tk.resolved_at, tk.resolution_time_min
           FROM atk JOIN tk ON tk.ticket_id = atk.ticket_id)"""

SQL["page_asset_events"] = marts(atk="vw_fact_asset_tickets", tk="vw_glpi_tickets", fin="vw_fact_asset_financials") + f""",
{_SPANS},
line AS (
  SELECT itemtype || '-' || items_id AS asset_key, CAST(buy_date AS TIMESTAMP) AS event_at, 'bought' AS event, CAST(NULL AS BIGINT) AS ref_id, 0 AS opens, 0 AS covers
  FROM fin WHERE buy_date IS NOT NULL
  UNION ALL SELECT itemtype || '-' || items_id, CAST(warranty_end_date AS TIMESTAMP), 'warranty_end', NULL, 0, 0 FROM fin WHERE warranty_end_date IS NOT NULL
  UNION ALL SELECT asset_key, created_at, 'ticket_opened', ticket_id, 1, 0 FROM linked WHERE created_at IS NOT NULL
  UNION ALL SELECT asset_key, resolved_at, 'ticket_solved', ticket_id, -1, 0 FROM linked WHERE resolved_at IS NOT NULL
  UNION ALL SELECT asset_key, CAST(begin_date AS TIMESTAMP), 'contract_begin', contract_id, 0, 1 FROM spans WHERE begin_date IS NOT NULL
  UNION ALL SELECT asset_key, CAST(end_date AS TIMESTAMP), 'contract_end', contract_id, 0, -1 FROM spans WHERE end_date IS NOT NULL)
SELECT asset_key, row_number() OVER k AS event_no, event_at, event, ref_id, CAST(sum(opens) OVER k AS BIGINT) AS open_tickets,
  CAST(sum(covers) OVER k > 0 AS INTEGER) AS covered
FROM line WINDOW k AS (PARTITION BY asset_key ORDER BY event_at, event, ref_id NULLS FIRST ROWS UNBOUNDED PRECEDING)"""

SQL["page_asset_contracts"] = marts(atk="vw_fact_asset_tickets", tk="vw_glpi_tickets") + f""",
{_SPANS}
SELECT s.asset_key, contract_id, contract_name, begin_date, end_date, count(l.ticket_id) AS tickets_in_period,
  {r('coalesce(sum(l.resolution_time_min), 0) / 60.0 * 100.0')} AS support_cost,
  CAST(coalesce(begin_date <= CAST({AS_OF_SQL} AS DATE) AND (end_date IS NULL OR CAST({AS_OF_SQL} AS DATE) < end_date), false) AS INTEGER) AS is_running
FROM spans s LEFT JOIN linked l ON l.asset_key = s.asset_key AND CAST(l.created_at AS DATE) >= begin_date
  AND (end_date IS NULL OR CAST(l.created_at AS DATE) < end_date)
GROUP BY ALL"""

SQL["page_technician_load"] = marts(tp="vw_tech_productivity") + f""",
m AS (SELECT year_month, avg(tickets_assigned) AS mean FROM tp GROUP BY 1)
SELECT tp.year_month, technician_id, tickets_assigned, {r('tickets_assigned / mean')} AS value,
  CASE WHEN tickets_assigned > 2 * mean THEN 'red' WHEN tickets_assigned > 1.5 * mean THEN 'yellow' ELSE 'green' END AS color
FROM tp JOIN m ON m.year_month = tp.year_month"""

SQL["page_traffic_lights"] = marts(tk="vw_glpi_tickets", bk="vw_backlog_open", sl="vw_fact_software_licenses", tp="vw_tech_productivity") + f""",
v AS (SELECT 'sla_pct' AS indicator, 100 * {div(cnt(MET), cnt(MET) + ' + ' + cnt(BRE))} AS value FROM tk
      UNION ALL SELECT 'mttr_hours', avg(resolution_time_min) / 60.0 FROM tk
      UNION ALL SELECT 'backlog_days', avg(age_days) FROM bk
      UNION ALL SELECT 'tickets_per_mean', max(n) / avg(n) FROM (SELECT sum(tickets_assigned) AS n FROM tp GROUP BY technician_id)
      UNION ALL SELECT 'license_use_pct', 100 * {div('sum(installations_count)', 'sum(licenses_qty)')} FROM sl)
SELECT indicator, {r('value')} AS value,
  CASE WHEN value IS NULL THEN NULL
       WHEN indicator = 'sla_pct' THEN CASE WHEN value >= 90 THEN 'green' WHEN value >= 80 THEN 'yellow' ELSE 'red' END
       WHEN indicator = 'mttr_hours' THEN CASE WHEN value <= 24 THEN 'green' WHEN value <= 48 THEN 'yellow' ELSE 'red' END
       WHEN indicator = 'tickets_per_mean' THEN CASE WHEN value > 2 THEN 'red' WHEN value > 1.5 THEN 'yellow' ELSE 'green' END
       WHEN indicator = 'backlog_days' THEN CASE WHEN value <= 7 THEN 'green' WHEN value <= 30 THEN 'yellow' ELSE 'red' END
       ELSE CASE WHEN value >= 50 AND value <= 100 THEN 'green' WHEN value > 100 THEN 'yellow' WHEN value < 30 THEN 'red'
                 ELSE 'yellow' END END AS color
FROM v"""
