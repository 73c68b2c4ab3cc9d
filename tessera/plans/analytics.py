"""Registered measure and time-intelligence queries (each ``(src, as_of)``).

Doubles are rounded to 4 places at the end (presentation), so results are
stable across engines' floating summation order.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tessera.operators import timeintel as TI
from tessera.plans.measures import evaluate
from tessera.plans.model import Model

T = F.col


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(T(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
                       else T(f.name) for f in df.schema.fields])


TICKET_KPIS = [
    "total_tickets", "open_tickets", "closed_tickets", "tickets_created", "tickets_resolved", "resolution_rate",
    "sla_compliant", "sla_breached", "sla_compliance_rate", "sla_status_icon", "avg_resolution_min",
    "avg_resolution_hrs", "median_resolution_min", "p90_resolution_min", "aged_tickets_7d", "backlog_0_1d",
    "backlog_2_7d", "backlog_8_30d", "backlog_over_30d", "avg_backlog_age_days", "active_technicians",
    "tickets_per_technician", "reopen_rate", "workload_stddev", "top_performer", "peak_weekday", "created_today",
    "resolved_today", "today_resolution_rate",
]

ENTITY_KPIS = [
    "entity_tickets", "entity_avg_resolution_hrs", "entity_sla_compliance", "entity_sla_breached",
    "entity_asset_value", "entity_asset_share", "top_entity_by_tickets", "worst_sla_entity", "entity_sla_icon",
    "entity_active_projects", "entity_task_completion", "rack_items", "rack_linked_incidents",
    "rack_assets_with_incidents", "rack_utilisation", "hottest_rack",
]

CMDB_KPIS = [
    "total_assets", "assets_with_incidents", "assets_with_incidents_pct", "total_asset_incidents",
    "most_incident_prone_asset", "server_count", "desktop_count", "network_equipment_count", "total_asset_value",
    "avg_asset_value", "entity_asset_financial_value", "total_contract_value", "active_contracts",
    "expiring_contracts_30d", "total_softwares", "total_installations", "license_utilization",
    "over_licensed_softwares", "expiring_licenses_30d", "kb_articles", "kb_articles_viewed", "kb_adoption_rate",
    "kb_views", "avg_satisfaction_score", "total_ratings", "satisfaction_response_rate", "negative_ratings",
    "negative_rating_rate", "open_problems", "problems_with_tickets", "avg_tickets_per_problem",
    "changes_in_progress", "emergency_changes", "active_projects", "project_task_completion", "overdue_projects",
]

MONTHLY = ["tickets_created", "tickets_resolved", "resolution_rate", "sla_compliant", "sla_breached",
           "sla_compliance_rate", "avg_resolution_min"]


def measures_ticket_kpis(src, as_of: datetime) -> DataFrame:
    return round_doubles(evaluate(Model(src, as_of), TICKET_KPIS))


def measures_entity_kpis(src, as_of: datetime) -> DataFrame:
    return round_doubles(evaluate(Model(src, as_of), ENTITY_KPIS))


def measures_cmdb_kpis(src, as_of: datetime) -> DataFrame:
    return round_doubles(evaluate(Model(src, as_of), CMDB_KPIS))


def measures_ticket_monthly(src, as_of: datetime) -> DataFrame:
    """Created and resolved counts on one month axis (date-role switch W9)."""
    return round_doubles(evaluate(Model(src, as_of), MONTHLY, by=["year_month"]))


def measures_by_entity_filtered(src, as_of: datetime) -> DataFrame:
    """Filter context: a column slicer (priority 5-6) plus a dimension
    slicer (entity type) that reaches the fact through the relationship."""
    m = Model(src, as_of)
    return round_doubles(evaluate(
        m, ["total_tickets", "open_tickets", "sla_compliance_rate", "avg_resolution_min", "entity_asset_share"],
        by=["entity_id"],
        filters={"priority_code": [5, 6], "vw_dim_entity.entity_type": "Sub-entidade"}))


def measures_region_scope(src, as_of: datetime, region: str = "AMERICA") -> DataFrame:
    """X5 row-level scope: a reader restricted to the entities below one
    region sees KPIs of those entities only (marts are semi-joined with the
    scope by their own entity or by that of their ticket or asset); J13: assets filtered through their tickets
    (bidirectional asset <-> asset-ticket relationship)."""
    ents = src["entities"]
    parent = ents.where(F.col("name") == region).select(F.col("id").alias("_p"))
    scope = ents.join(parent, F.col("entities_id") == F.col("_p"), "left_semi").select(F.col("id").alias("entity_id"))
    m = Model(src, as_of, scope=scope)
    k = evaluate(m, ["total_tickets", "open_tickets", "sla_compliance_rate", "entity_tickets"], by=["entity_id"])
    assets = evaluate(m, ["total_assets"], by=["entity_id"],
                      filters={"vw_fact_asset_tickets.ticket_priority": [5, 6]})
    return round_doubles(k.join(assets, "entity_id", "full_outer"))


def ti_ticket_volume(src, as_of: datetime) -> DataFrame:
    """M28-M32 + W4/W5: monthly created tickets on a dense spine with previous
    month, MoM delta and %, trailing 3-month average, +/- 1 std band, spike
    flag and YoY %."""
    monthly = evaluate(Model(src, as_of), ["tickets_created"], by=["year_month"])
    s = TI.on_spine(monthly, ["tickets_created"], fill={"tickets_created": 0})
    v = T("tickets_created")
    prev, prev_year = TI.shift_period("tickets_created", 1), TI.shift_period("tickets_created", 12)
    avg3, std3 = TI.moving_avg("tickets_created", 3), TI.moving_std("tickets_created", 3)
    out = s.select("year_month", "tickets_created", prev.alias("prev_month"), prev_year.alias("prev_year"),
                   avg3.alias("moving_avg_3m"), std3.alias("std_3m"))
    out = out.select(
        "year_month", "tickets_created", "prev_month", TI.delta(v, T("prev_month")).alias("mom_change"),
        TI.pct_change(v, T("prev_month")).alias("mom_change_pct"), "moving_avg_3m",
        (T("moving_avg_3m") - T("std_3m")).alias("band_low"), (T("moving_avg_3m") + T("std_3m")).alias("band_high"),
        ((v < T("moving_avg_3m") - T("std_3m")) | (v > T("moving_avg_3m") + T("std_3m"))).cast("int").alias("is_spike"),
        TI.pct_change(v, T("prev_year")).alias("yoy_growth_pct"))
    return round_doubles(out)


def ti_sla_mom(src, as_of: datetime) -> DataFrame:
    """SLA compliance rate per month and its change vs previous month."""
    monthly = evaluate(Model(src, as_of), ["sla_compliance_rate"], by=["year_month"])
    s = TI.on_spine(monthly, ["sla_compliance_rate"])
    prev = TI.shift_period("sla_compliance_rate", 1)
    out = s.select("year_month", "sla_compliance_rate", prev.alias("prev_rate"))
    return round_doubles(out.select("year_month", "sla_compliance_rate", "prev_rate",
                                    TI.delta(T("sla_compliance_rate"), T("prev_rate")).alias("sla_compliance_mom")))


def ti_entity_sla_mom(src, as_of: datetime) -> DataFrame:
    """Entity SLA compliance per month, icon, change vs previous
    month; months come from the entity SLA mart (period = year_month)."""
    model = Model(src, as_of)
    es = model.mart("vw_entity_sla_monthly")
    per = es.groupBy("entity_id", "year_month").agg(F.sum("within_sla").alias("_in"), F.sum("breached_sla").alias("_out"))
    per = per.select("entity_id", "year_month",
                     (T("_in").cast("double") / F.nullif((T("_in") + T("_out")).cast("double"), F.lit(0.0)))
                     .alias("entity_sla_compliance"))
    s = TI.on_spine(per, ["entity_sla_compliance"], by=["entity_id"])
    prev = TI.shift_period("entity_sla_compliance", 1, by=["entity_id"])
    out = s.select("entity_id", "year_month", "entity_sla_compliance", prev.alias("prev_compliance"))
    from tessera.plans.measures import icon
    return round_doubles(out.select(
        "entity_id", "year_month", "entity_sla_compliance", "prev_compliance",
        F.when(T("entity_sla_compliance").isNotNull(), icon(T("entity_sla_compliance"))).alias("entity_sla_icon"),
        TI.delta(T("entity_sla_compliance"), T("prev_compliance")).alias("entity_sla_mom")))


def ti_measures_by_entity(src, as_of: datetime) -> DataFrame:
    """M28-M32 as measures: created tickets of the two highest priorities per
    entity and month, compared along each entity's own spine."""
    return round_doubles(evaluate(
        Model(src, as_of), ["tickets_created", "tickets_prev_month", "tickets_mom_change", "tickets_mom_pct",
                            "tickets_avg_3m", "tickets_yoy_pct"],
        by=["entity_id", "year_month"], filters={"priority_code": [5, 6]}))


ANALYTICS = {
    "measures_ticket_kpis": measures_ticket_kpis,
    "measures_entity_kpis": measures_entity_kpis,
    "measures_cmdb_kpis": measures_cmdb_kpis,
    "measures_ticket_monthly": measures_ticket_monthly,
    "measures_by_entity_filtered": measures_by_entity_filtered,
    "measures_region_scope": measures_region_scope,
    "ti_ticket_volume": ti_ticket_volume,
    "ti_sla_mom": ti_sla_mom,
    "ti_entity_sla_mom": ti_entity_sla_mom,
    "ti_measures_by_entity": ti_measures_by_entity,
}
