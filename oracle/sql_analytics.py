"""Oracle SQL (DuckDB) for measure and time-intelligence queries.

Marts are re-used as CTEs from their own oracle bodies.  Arg-max measures
use the literal "rows with the top value, then the largest name" form.
"""

from __future__ import annotations

from oracle import sql_cmdb, sql_entity, sql_finance, sql_tickets
from tessera import domains as D

MART_SQL = {**sql_tickets.SQL, **sql_cmdb.SQL, **sql_finance.SQL, **sql_entity.SQL}
TODAY = "DATE '2001-08-01'"
NOW = "TIMESTAMP '2001-08-01 00:00:00'"


def marts(**alias) -> str:
    return "WITH " + ",\n".join(f"{a} AS ({MART_SQL[m]})" for a, m in alias.items())


def r(x: str, d: int = 4) -> str:
    return f"round(CAST({x} AS DOUBLE), {d})"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def icon(x: str) -> str:
    return f"(CASE WHEN {x} >= 0.9 THEN '✓' WHEN {x} >= 0.8 THEN '⚠' ELSE '🔴' END)"


def cnt(pred: str) -> str:
    return f"CAST(sum(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)"


SQL = {}

SQL["measures_ticket_kpis"] = marts(tk="vw_glpi_tickets", bk="vw_backlog_open", tp="vw_tech_productivity") + f""",
a AS (SELECT count(*) AS total_tickets, {cnt('is_open = 1')} AS open_tickets, {cnt('is_resolved = 1')} AS closed_tickets,
        count(*) AS tickets_created, {cnt(f"sla_status = '{D.SLA_MET}'")} AS sla_compliant,
        {cnt(f"sla_status IN ('{D.SLA_BREACHED}', '{D.SLA_BREACHED_OPEN}')")} AS sla_breached,
        avg(resolution_time_min) AS avg_resolution_min,
        quantile_cont(resolution_time_min, 0.5) AS median_resolution_min,
        quantile_cont(resolution_time_min, 0.9) AS p90_resolution_min,
        {cnt(f"is_open = 1 AND date_diff('day', CAST(created_at AS DATE), {TODAY}) > 7")} AS aged_tickets_7d,
        count(DISTINCT technician_id) + max(CASE WHEN technician_id IS NULL THEN 1 ELSE 0 END) AS active_technicians,
        {cnt(f"CAST(created_at AS DATE) = {TODAY}")} AS created_today
      FROM tk),
rz AS (SELECT {cnt('resolved_at IS NOT NULL')} AS tickets_resolved, {cnt(f"CAST(resolved_at AS DATE) = {TODAY}")} AS resolved_today
       FROM tk WHERE resolved_at IS NOT NULL),
b AS (SELECT {cnt('age_days <= 1')} AS backlog_0_1d, {cnt('age_days BETWEEN 2 AND 7')} AS backlog_2_7d,
        {cnt('age_days BETWEEN 8 AND 30')} AS backlog_8_30d, {cnt('age_days > 30')} AS backlog_over_30d,
        avg(age_days) AS avg_backlog_age_days FROM bk),
w AS (SELECT stddev_pop(s) AS workload_stddev FROM (SELECT technician_name, sum(tickets_closed) AS s FROM tp GROUP BY technician_name)),
tpf AS (SELECT max(technician_name) AS top_performer FROM tp WHERE tickets_closed = (SELECT max(tickets_closed) FROM tp)),
wd AS (SELECT dayname(created_at) AS n, count(*) AS c FROM tk GROUP BY 1),
pk AS (SELECT max(n) AS peak_weekday FROM wd WHERE c = (SELECT max(c) FROM wd))
SELECT total_tickets, open_tickets, closed_tickets, tickets_created, tickets_resolved,
  {r(div('tickets_resolved', 'tickets_created'))} AS resolution_rate, sla_compliant, sla_breached,
  {r(div('sla_compliant', 'sla_compliant + sla_breached'))} AS sla_compliance_rate,
  {icon(div('sla_compliant', 'sla_compliant + sla_breached'))} AS sla_status_icon,
  {r('avg_resolution_min')} AS avg_resolution_min, {r(div('avg_resolution_min', '60'))} AS avg_resolution_hrs,
  {r('median_resolution_min')} AS median_resolution_min, {r('p90_resolution_min')} AS p90_resolution_min,
  aged_tickets_7d, backlog_0_1d, backlog_2_7d, backlog_8_30d, backlog_over_30d,
  {r('avg_backlog_age_days')} AS avg_backlog_age_days, active_technicians,
  {r(div('closed_tickets', 'active_technicians'))} AS tickets_per_technician, CAST(NULL AS DOUBLE) AS reopen_rate,
  {r('workload_stddev')} AS workload_stddev, top_performer, peak_weekday, created_today, resolved_today,
  {r(div('resolved_today', 'created_today'))} AS today_resolution_rate
FROM a, rz, b, w, tpf, pk"""

SQL["measures_entity_kpis"] = marts(eo="vw_entity_overview", es="vw_entity_sla_monthly",
                                    ea="vw_entity_asset_distribution", ep="vw_entity_project_performance",
                                    rk="vw_rack_inventory") + f""",
o AS (SELECT CAST(sum(total_tickets) AS BIGINT) AS entity_tickets, avg(avg_resolution_hours) AS entity_avg_resolution_hrs FROM eo),
s AS (SELECT CAST(sum(within_sla) AS BIGINT) AS w, CAST(sum(breached_sla) AS BIGINT) AS entity_sla_breached FROM es),
a AS (SELECT sum(total_value_brl) AS entity_asset_value, sum(total_assets) AS n FROM ea),
te AS (SELECT max(entity_name) AS top_entity_by_tickets FROM eo WHERE total_tickets = (SELECT max(total_tickets) FROM eo)),
ws AS (SELECT entity_name, coalesce({div('sum(within_sla)', 'sum(within_sla) + sum(breached_sla)')}, 1.0) AS c
       FROM es GROUP BY entity_name),
wse AS (SELECT max(entity_name) AS worst_sla_entity FROM ws WHERE c = (SELECT min(c) FROM ws)),
p AS (SELECT {cnt('completed_tasks < total_tasks')} AS entity_active_projects,
        {div('sum(completed_tasks)', 'sum(total_tasks)')} AS entity_task_completion FROM ep),
k AS (SELECT count(*) AS rack_items, CAST(sum(incident_count) AS BIGINT) AS rack_linked_incidents,
        {cnt('incident_count > 0')} AS rack_assets_with_incidents, {cnt('asset_name IS NOT NULL')} AS rack_utilisation FROM rk),
hr AS (SELECT rack_name, sum(incident_count) AS c FROM rk GROUP BY rack_name),
h AS (SELECT max(rack_name) AS hottest_rack FROM hr WHERE c = (SELECT max(c) FROM hr))
SELECT entity_tickets, {r('entity_avg_resolution_hrs')} AS entity_avg_resolution_hrs,
  {r(div('w', 'w + entity_sla_breached'))} AS entity_sla_compliance, entity_sla_breached,
  {r('entity_asset_value')} AS entity_asset_value, {r(div('n', 'n'))} AS entity_asset_share,
  top_entity_by_tickets, worst_sla_entity, {icon(div('w', 'w + entity_sla_breached'))} AS entity_sla_icon,
  entity_active_projects, {r('entity_task_completion')} AS entity_task_completion,
  rack_items, rack_linked_incidents, rack_assets_with_incidents, rack_utilisation, hottest_rack
FROM o, s, a, te, wse, p, k, h"""

SQL["measures_cmdb_kpis"] = marts(da="vw_dim_asset", ai="vw_fact_asset_incidents", af="vw_fact_asset_financials",
                                  sc="vw_fact_supplier_contracts", sl="vw_fact_software_licenses",
                                  kb="vw_fact_kb_usage", ss="vw_fact_satisfaction_summary", pr="vw_fact_problems",
                                  ch="vw_fact_changes", pj="vw_fact_projects", pt="vw_fact_project_tasks",
                                  tk="vw_glpi_tickets") + f""",
d AS (SELECT count(DISTINCT asset_key) AS total_assets,
        {cnt("asset_itemtype = 'Computer' AND substr(asset_name, 1, 3) = 'SRV'")} AS server_count,
        {cnt("asset_itemtype = 'Computer' AND substr(asset_name, 1, 2) = 'WS'")} AS desktop_count,
        {cnt("asset_itemtype = 'NetworkEquipment'")} AS network_equipment_count FROM da),
i AS (SELECT count(DISTINCT asset_key) AS assets_with_incidents, CAST(sum(total_tickets) AS BIGINT) AS total_asset_incidents FROM ai),
mp AS (SELECT max(da.asset_name) AS most_incident_prone_asset FROM ai LEFT JOIN da ON da.asset_key = ai.asset_key
       WHERE ai.total_tickets = (SELECT max(total_tickets) FROM ai)),
f AS (SELECT sum(purchase_value) AS total_asset_value, avg(purchase_value) AS avg_asset_value FROM af),
c AS (SELECT {cnt(f'end_date >= {TODAY}')} AS active_contracts,
        {cnt(f'end_date BETWEEN {TODAY} AND {TODAY} + 30')} AS expiring_contracts_30d FROM sc),
l AS (SELECT count(DISTINCT software_id) AS total_softwares, CAST(sum(installations_count) AS BIGINT) AS total_installations,
        CAST(sum(licenses_qty) AS BIGINT) AS total_licenses,
        {cnt('installations_count > licenses_qty')} AS over_licensed_softwares,
        {cnt(f'license_expiry <= {TODAY} + 30 AND license_expiry >= {TODAY}')} AS expiring_licenses_30d FROM sl),
k AS (SELECT count(*) AS kb_articles, {cnt('view_count > 0')} AS kb_articles_viewed,
        CAST(sum(view_count) AS BIGINT) AS kb_views FROM kb),
s AS (SELECT avg(avg_satisfaction) AS avg_satisfaction_score, CAST(sum(responses) AS BIGINT) AS total_ratings,
        CAST(sum(CASE WHEN avg_satisfaction < 3 THEN responses END) AS BIGINT) AS negative_ratings FROM ss),
cl AS (SELECT {cnt('is_resolved = 1')} AS closed_tickets FROM tk),
p AS (SELECT {cnt('status_code <> 6')} AS open_problems, {cnt('linked_tickets > 0')} AS problems_with_tickets,
        avg(linked_tickets) AS avg_tickets_per_problem FROM pr),
h AS (SELECT {cnt('status_code NOT IN (5, 6)')} AS changes_in_progress FROM ch),
j AS (SELECT {cnt(f"state_category <> '{D.PROJECT_FINISHED}'")} AS active_projects,
        {cnt(f"planned_end < {NOW} AND state_category <> '{D.PROJECT_FINISHED}'")} AS overdue_projects FROM pj),
t AS (SELECT {div(cnt('pct_done = 100'), 'count(*)')} AS project_task_completion FROM pt)
SELECT total_assets, assets_with_incidents, {r(div('assets_with_incidents', 'total_assets'))} AS assets_with_incidents_pct,
  total_asset_incidents, most_incident_prone_asset, server_count, desktop_count, network_equipment_count,
  {r('total_asset_value')} AS total_asset_value, {r('avg_asset_value')} AS avg_asset_value,
  {r('total_asset_value')} AS entity_asset_financial_value, CAST(NULL AS BIGINT) AS total_contract_value,
  active_contracts, expiring_contracts_30d, total_softwares, total_installations,
  {r(div('total_installations', 'total_licenses'))} AS license_utilization, over_licensed_softwares,
  expiring_licenses_30d, kb_articles, kb_articles_viewed, {r(div('kb_articles_viewed', 'kb_articles'))} AS kb_adoption_rate,
  kb_views, {r('avg_satisfaction_score')} AS avg_satisfaction_score, total_ratings,
  {r(div('total_ratings', 'closed_tickets'))} AS satisfaction_response_rate, negative_ratings,
  {r(div('negative_ratings', 'total_ratings'))} AS negative_rating_rate, open_problems, problems_with_tickets,
  {r('avg_tickets_per_problem')} AS avg_tickets_per_problem, changes_in_progress, CAST(NULL AS BIGINT) AS emergency_changes,
  active_projects, {r('project_task_completion')} AS project_task_completion, overdue_projects
FROM d, i, mp, f, c, l, k, s, cl, p, h, j, t"""

SQL["measures_ticket_monthly"] = marts(tk="vw_glpi_tickets") + f""",
c AS (SELECT strftime(created_at, '%Y-%m') AS year_month, count(*) AS tickets_created,
        {cnt(f"sla_status = '{D.SLA_MET}'")} AS sla_compliant,
        {cnt(f"sla_status IN ('{D.SLA_BREACHED}', '{D.SLA_BREACHED_OPEN}')")} AS sla_breached,
        avg(resolution_time_min) AS avg_resolution_min FROM tk GROUP BY 1),
v AS (SELECT strftime(resolved_at, '%Y-%m') AS year_month, count(*) AS tickets_resolved FROM tk
      WHERE resolved_at IS NOT NULL GROUP BY 1)
SELECT year_month, tickets_created, tickets_resolved, {r(div('tickets_resolved', 'tickets_created'))} AS resolution_rate,
  sla_compliant, sla_breached, {r(div('sla_compliant', 'sla_compliant + sla_breached'))} AS sla_compliance_rate,
  {r('avg_resolution_min')} AS avg_resolution_min
FROM c FULL OUTER JOIN v USING (year_month)"""

SQL["measures_by_entity_filtered"] = marts(tk="vw_glpi_tickets", de="vw_dim_entity",
                                           ea="vw_entity_asset_distribution") + f""",
sub AS (SELECT entity_id FROM de WHERE entity_type = 'Sub-entidade'),
t AS (SELECT entity_id, count(*) AS total_tickets, {cnt('is_open = 1')} AS open_tickets,
        {cnt(f"sla_status = '{D.SLA_MET}'")} AS m,
        {cnt(f"sla_status IN ('{D.SLA_BREACHED}', '{D.SLA_BREACHED_OPEN}')")} AS b,
        avg(resolution_time_min) AS avg_resolution_min
      FROM tk WHERE priority_code IN (5, 6) AND entity_id IN (SELECT entity_id FROM sub) GROUP BY entity_id),
a AS (SELECT entity_id, sum(total_assets) AS n FROM ea WHERE entity_id IN (SELECT entity_id FROM sub) GROUP BY entity_id),
al AS (SELECT sum(total_assets) AS n_all FROM ea)
SELECT entity_id, total_tickets, open_tickets, {r(div('m', 'm + b'))} AS sla_compliance_rate,
  {r('avg_resolution_min')} AS avg_resolution_min, {r(div('n', 'n_all'))} AS entity_asset_share
FROM t FULL OUTER JOIN a USING (entity_id), al"""

_SPINE = """(SELECT strftime(m, '%Y-%m') AS year_month FROM (SELECT unnest(generate_series(
    CAST(min(year_month) || '-01' AS DATE), CAST(max(year_month) || '-01' AS DATE), INTERVAL 1 MONTH)) AS m FROM {src}))"""

SQL["ti_ticket_volume"] = marts(tk="vw_glpi_tickets") + f""",
c AS (SELECT strftime(created_at, '%Y-%m') AS year_month, count(*) AS n FROM tk GROUP BY 1),
s AS (SELECT sp.year_month, coalesce(c.n, 0) AS tickets_created FROM {_SPINE.format(src='c')} sp
      LEFT JOIN c USING (year_month)),
w AS (SELECT year_month, tickets_created,
        lag(tickets_created, 1) OVER (ORDER BY year_month) AS prev_month,
        lag(tickets_created, 12) OVER (ORDER BY year_month) AS prev_year,
        avg(tickets_created) OVER (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS a3,
        stddev_pop(tickets_created) OVER (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s3
      FROM s)
SELECT year_month, tickets_created, prev_month, tickets_created - coalesce(prev_month, 0) AS mom_change,
  {r(div('tickets_created - coalesce(prev_month, 0)', 'prev_month'))} AS mom_change_pct,
  {r('a3')} AS moving_avg_3m, {r('a3 - s3')} AS band_low, {r('a3 + s3')} AS band_high,
  CAST(tickets_created < a3 - s3 OR tickets_created > a3 + s3 AS INTEGER) AS is_spike,
  {r(div('tickets_created - coalesce(prev_year, 0)', 'prev_year'))} AS yoy_growth_pct
FROM w"""

SQL["ti_sla_mom"] = marts(tk="vw_glpi_tickets") + f""",
c AS (SELECT strftime(created_at, '%Y-%m') AS year_month,
        {div(cnt(f"sla_status = '{D.SLA_MET}'"), cnt(f"sla_status IN ('{D.SLA_MET}', '{D.SLA_BREACHED}', '{D.SLA_BREACHED_OPEN}')"))} AS rate
      FROM tk GROUP BY 1),
s AS (SELECT sp.year_month, c.rate FROM {_SPINE.format(src='c')} sp LEFT JOIN c USING (year_month)),
w AS (SELECT year_month, rate, lag(rate, 1) OVER (ORDER BY year_month) AS prev FROM s)
SELECT year_month, {r('rate')} AS sla_compliance_rate, {r('prev')} AS prev_rate,
  {r('rate - coalesce(prev, 0)')} AS sla_compliance_mom FROM w"""

SQL["ti_entity_sla_mom"] = marts(es="vw_entity_sla_monthly") + f""",
c AS (SELECT entity_id, year_month, {div('sum(within_sla)', 'sum(within_sla) + sum(breached_sla)')} AS rate
      FROM es GROUP BY entity_id, year_month),
s AS (SELECT sp.year_month, e.entity_id, c.rate FROM {_SPINE.format(src='c')} sp
      CROSS JOIN (SELECT DISTINCT entity_id FROM c) e LEFT JOIN c USING (year_month, entity_id)),
w AS (SELECT entity_id, year_month, rate, lag(rate, 1) OVER (PARTITION BY entity_id ORDER BY year_month) AS prev FROM s)
SELECT entity_id, year_month, {r('rate')} AS entity_sla_compliance, {r('prev')} AS prev_compliance,
  CASE WHEN rate IS NOT NULL THEN {icon('rate')} END AS entity_sla_icon,
  {r('rate - coalesce(prev, 0)')} AS entity_sla_mom FROM w"""

SQL["measures_region_scope"] = marts(tk="vw_glpi_tickets", eo="vw_entity_overview", da="vw_dim_asset",
                                     fat="vw_fact_asset_tickets") + f""",
sc AS (SELECT e.id AS entity_id FROM glpi_entities e JOIN glpi_entities p ON e.entities_id = p.id WHERE p.name = 'AMERICA'),
t AS (SELECT entity_id, count(*) AS total_tickets, {cnt('is_open = 1')} AS open_tickets,
        {cnt(f"sla_status = '{D.SLA_MET}'")} AS m,
        {cnt(f"sla_status IN ('{D.SLA_BREACHED}', '{D.SLA_BREACHED_OPEN}')")} AS b
      FROM tk WHERE entity_id IN (SELECT entity_id FROM sc) GROUP BY entity_id),
o AS (SELECT entity_id, CAST(sum(total_tickets) AS BIGINT) AS entity_tickets FROM eo
      WHERE entity_id IN (SELECT entity_id FROM sc) GROUP BY entity_id),
a AS (SELECT entity_id, count(DISTINCT asset_key) AS total_assets FROM da
      WHERE entity_id IN (SELECT entity_id FROM sc)
        AND asset_key IN (SELECT asset_key FROM fat JOIN tk USING (ticket_id) JOIN sc ON sc.entity_id = tk.entity_id
                          WHERE fat.ticket_priority IN (5, 6)) GROUP BY entity_id)
SELECT entity_id, total_tickets, open_tickets, {r(div('m', 'm + b'))} AS sla_compliance_rate, entity_tickets, total_assets
FROM t FULL OUTER JOIN o USING (entity_id) FULL OUTER JOIN a USING (entity_id)"""

# Months are numbered; earlier months are found by self-join on the number.
SQL["ti_measures_by_entity"] = """
WITH made AS (
  SELECT entities_id, CAST(year(date) * 12 + month(date) - 1 AS BIGINT) AS m, count(*) AS n FROM glpi_tickets
  WHERE is_deleted = 0 AND priority IN (5, 6) GROUP BY ALL),
span AS (SELECT unnest(range((SELECT min(m) FROM made), (SELECT max(m) FROM made) + 1)) AS m),
series AS (
  SELECT e.entities_id, span.m, made.n AS found, coalesce(made.n, 0) AS n
  FROM (SELECT DISTINCT entities_id FROM made) e, span LEFT JOIN made ON made.entities_id = e.entities_id AND made.m = span.m),
seen AS (
  SELECT s.entities_id, s.m, s.found, s.n, max(b.n) FILTER (WHERE b.m = s.m - 1) AS before,
    avg(b.n) FILTER (WHERE b.m >= s.m - 2) AS average, max(b.n) FILTER (WHERE b.m = s.m - 12) AS year_before
  FROM series s INNER JOIN series b ON b.entities_id = s.entities_id AND b.m BETWEEN s.m - 12 AND s.m GROUP BY ALL)
SELECT entities_id AS entity_id, printf('%04d-%02d', m // 12, m % 12 + 1) AS year_month, found AS tickets_created,
  before AS tickets_prev_month, n - coalesce(before, 0) AS tickets_mom_change,
  round((n - before) / nullif(CAST(before AS DOUBLE), 0), 4) AS tickets_mom_pct, round(average, 4) AS tickets_avg_3m,
  round((n - year_before) / nullif(CAST(year_before AS DOUBLE), 0), 4) AS tickets_yoy_pct
FROM seen"""
