"""Dashboard page queries G1-G27 (``page_<id>(src, as_of) -> DataFrame``).

Each page query reads marts through one ``Model`` and ends in a small
result.  Top-k pages keep their limit (it is the report); rankings use the
histogram rank of ``operators.ranking`` instead of a global window; pivots
pass their value list so Spark does not run an extra job to discover it.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import domains as D
from tessera.functions.time import add_months_ts, date_lit, diff_units, ntz
from tessera.operators import timeintel as TI
from tessera.operators.percentile import exact_percentiles
from tessera.operators.ranking import rank_desc, reuse, top_k, with_global
from tessera.plans.analytics import round_doubles
from tessera.plans.measures import count_if, divide, evaluate, icon
from tessera.plans.marts_cmdb import build_vw_dim_asset
from tessera.plans.model import Model

T = F.col

# FIXED VALUES: dashboard colour words and labels
GREEN, YELLOW, RED = "green", "yellow", "red"
QUADRANTS = ("Eficientes", "Precisam de apoio", "Sobrecarregados", "Subutilizados")
BACKLOG_BUCKETS = ("0-1 dia", "2-7 dias", "8-30 dias", "31-90 dias", "> 90 dias")
FUNNEL_STAGES = ("Criado", "Atribuído", "Em andamento", "Pendente", "Resolvido", "Fechado")
TREND_UP, TREND_DOWN, TREND_FLAT = "↑", "↓", "→"
DEFAULT_HOURLY_RATE = 100.0


def _met() -> Column:
    return count_if(T("sla_status") == D.SLA_MET)


def _breached() -> Column:
    return count_if(T("sla_status").isin(D.SLA_BREACHED, D.SLA_BREACHED_OPEN))


def _sla_pct(digits: int = 2) -> Column:
    return F.round(100.0 * divide(_met(), _met() + _breached()), digits)


def _sla_band(pct: Column, low: float = 80.0, high: float = 90.0) -> Column:
    return F.when(pct >= high, F.lit(GREEN)).when(pct >= low, F.lit(YELLOW)).when(pct.isNotNull(), F.lit(RED))


# ---------------------------------------------------------------- p01
def page_kpi_strip(src, as_of: datetime) -> DataFrame:
    """G1: six KPIs with alert bands (SLA target 90 %, MTTR target 24 h)."""
    m = Model(src, as_of)
    k = evaluate(m, ["total_tickets", "open_tickets", "sla_compliance_rate", "avg_resolution_hrs",
                     "aged_tickets_7d", "avg_satisfaction_score"])
    sla = T("sla_compliance_rate")
    mttr = T("avg_resolution_hrs")
    return round_doubles(k.select(
        "*", (T("open_tickets") > 100).cast("int").alias("open_alert"),
        F.when(sla >= 0.9, F.lit(GREEN)).when(sla >= 0.8, F.lit(YELLOW)).otherwise(F.lit(RED)).alias("sla_band"),
        F.when(mttr > 2 * D.MTTR_TARGET_HOURS, F.lit(RED)).when(mttr > D.MTTR_TARGET_HOURS, F.lit(YELLOW))
         .otherwise(F.lit(GREEN)).alias("mttr_band")))


def page_monthly_volume_sla(src, as_of: datetime) -> DataFrame:
    """Monthly created vs resolved with the month's SLA % (from V7)."""
    m = Model(src, as_of)
    vt = m.mart("vw_volume_trend")
    sla = m.mart("vw_sla_monthly").groupBy("year_month").agg(
        F.round(100.0 * divide(F.sum("within_sla"), F.sum("tickets_with_sla_resolved")), 2).alias("sla_compliance_pct"))
    return vt.join(sla, "year_month", "left").select(
        "year_month", "tickets_created", "tickets_resolved", "sla_compliance_pct",
        F.round(T("avg_resolution_min") / 60.0, 4).alias("avg_resolution_hrs"))


def page_status_mix(src, as_of: datetime) -> DataFrame:
    """Status donut."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=())
    return t.groupBy("status_code", "status_label").agg(F.count(F.lit(1)).alias("tickets"))


def page_entity_treemap(src, as_of: datetime) -> DataFrame:
    """Tickets per entity coloured by SLA %."""
    m = Model(src, as_of)
    agg = m.mart("vw_fact_tickets").groupBy("entity_id").agg(F.count(F.lit(1)).alias("total_tickets"),
                                      count_if(T("is_open") == 1).alias("open_tickets"),
                                      _sla_pct().alias("sla_compliance_pct"))
    names = m.mart("vw_dim_entity").select("entity_id", "entity_name")
    return agg.join(names, "entity_id", "left").select("entity_id", "entity_name", "total_tickets", "open_tickets",
                                                       "sla_compliance_pct")


def page_top_categories(src, as_of: datetime) -> DataFrame:
    """Top 5 categories with open, SLA %, MTTR and month-over-month trend."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=("category_name",))
    cur = as_of.strftime("%Y-%m")
    prev = (as_of.replace(day=1) - timedelta(days=1)).strftime("%Y-%m")
    agg = t.groupBy("category_name").agg(
        F.count(F.lit(1)).alias("total_tickets"), count_if(T("is_open") == 1).alias("open_tickets"),
        count_if(T("is_resolved") == 1).alias("closed_tickets"), _sla_pct().alias("sla_pct"),
        F.round(F.avg("resolution_time_min") / 60.0, 4).alias("avg_resolution_hrs"),
        count_if(T("created_year_month") == cur).alias("this_month"),
        count_if(T("created_year_month") == prev).alias("last_month"))
    trend = (F.when(T("this_month") > T("last_month"), F.lit(TREND_UP))
             .when(T("this_month") < T("last_month"), F.lit(TREND_DOWN)).otherwise(F.lit(TREND_FLAT)))
    return top_k(agg.withColumn("trend", trend), 5, [F.desc("total_tickets"), F.asc("category_name")])


# ---------------------------------------------------------------- p02
def page_entity_sla_trend(src, as_of: datetime) -> DataFrame:
    """SLA % per entity and month against the 90 % target."""
    es = Model(src, as_of).mart("vw_entity_sla_monthly")
    return es.select("entity_name", "year_month", "within_sla", "breached_sla", "total_tickets",
                     "sla_compliance_pct",
                     (T("sla_compliance_pct") < D.SLA_TARGET_PCT).cast("int").alias("below_target"))


def page_sla_by_category(src, as_of: datetime) -> DataFrame:
    """SLA % by category, worst first, bands <70 / 70-89 / >=90."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=("category_name",))
    agg = t.groupBy("category_name").agg(_sla_pct().alias("sla_compliance_pct"))
    return agg.select("category_name", "sla_compliance_pct",
                      _sla_band(T("sla_compliance_pct"), 70.0, 90.0).alias("band")
                      ).orderBy(F.asc_nulls_last("sla_compliance_pct"), "category_name")


def page_sla_matrix(src, as_of: datetime) -> DataFrame:
    """SLA % matrix, assigned group x priority (pivot; other codes and
    tickets without one share ``p_other``)."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=("assigned_group_name",))
    known = [str(p) for p in D.PRIORITY_LABELS]
    code = T("priority_code").cast("string")
    t = t.withColumn("_p", F.when(code.isin(*known), code).otherwise(F.lit("other")))
    pv = t.groupBy("assigned_group_name").pivot("_p", [*known, "other"]).agg(_sla_pct())
    return pv.select("assigned_group_name", *[T(p).alias(f"p{p}") for p in known], T("other").alias("p_other"))


def page_recent_breaches(src, as_of: datetime, days: int = 30, k: int = 20) -> DataFrame:
    """Breaches whose due time fell in the last ``days`` days, top ``k``
    by hours over target: (minutes - target minutes) / 60."""
    m = Model(src, as_of)
    t = m.mart("vw_glpi_tickets", needs=("assigned_group_name",)).where(
        T("sla_status").isin(D.SLA_BREACHED, D.SLA_BREACHED_OPEN))
    now = ntz(as_of)
    t = t.where((T("sla_due_at") > F.timestamp_add("DAY", F.lit(-days), now)) & (T("sla_due_at") <= now))
    sla = m.mart("vw_dim_sla").select(T("id").alias("_sid"), "sla_target_min")
    j = t.join(sla, T("sla_id") == T("_sid"), "left")
    minutes = F.coalesce(T("resolution_time_min"), T("age_open_min"))
    out = j.select("ticket_id", "ticket_title", "priority_label", "assigned_group_name", "created_at", "sla_status",
                   minutes.alias("elapsed_min"),
                   F.round((minutes - T("sla_target_min")) / 60.0, 4).alias("excess_hours"))
    return top_k(out, k, [F.desc_nulls_last("excess_hours"), F.asc("ticket_id")])


def page_at_risk(src, as_of: datetime) -> DataFrame:
    """Open tickets still inside their SLA."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=("assigned_group_name",)).where(
        T("sla_status") == D.SLA_AT_RISK)
    return t.select("ticket_id", "ticket_title", "priority_label", "assigned_group_name", "sla_due_at",
                    diff_units("HOUR", ntz(as_of), T("sla_due_at")).alias("hours_left"))


# ---------------------------------------------------------------- p03
def page_category_type(src, as_of: datetime, k: int = 10) -> DataFrame:
    """Top-k categories x ticket type (semi-join on the top list + pivot);
    ``others`` counts tickets of any other type or none."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=("category_name",))
    top = top_k(t.groupBy("category_name").agg(F.count(F.lit(1)).alias("total_tickets")), k,
                [F.desc("total_tickets"), F.asc("category_name")])
    pv = (t.join(top.select("category_name"), "category_name", "left_semi")
          .groupBy("category_name").pivot("ticket_type_code", [1, 2]).agg(F.count(F.lit(1))))
    return pv.join(top, "category_name").select(
        "category_name", "total_tickets", F.coalesce(T("1"), F.lit(0)).alias("incidents"),
        F.coalesce(T("2"), F.lit(0)).alias("requests"),
        (T("total_tickets") - F.coalesce(T("1"), F.lit(0)) - F.coalesce(T("2"), F.lit(0))).alias("others"))


def page_lifecycle_funnel(src, as_of: datetime) -> DataFrame:
    """Volume at each lifecycle stage (one pass + stack unpivot)."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=("technician_id",))
    s = T("status_code")
    agg = t.agg(F.count(F.lit(1)).alias("s1"), count_if(T("technician_id").isNotNull()).alias("s2"),
                count_if(s.isin(2, 3)).alias("s3"), count_if(s == 4).alias("s4"),
                count_if(s.isin(5, 6)).alias("s5"), count_if(s == 6).alias("s6"))
    pairs = ", ".join(f"{i + 1}, '{name}', s{i + 1}" for i, name in enumerate(FUNNEL_STAGES))
    return agg.selectExpr(f"stack({len(FUNNEL_STAGES)}, {pairs}) AS (stage_order, stage, tickets)")


def _backlog_bucket(age: Column) -> Column:
    b = BACKLOG_BUCKETS
    return (F.when(age <= 1, F.lit(b[0])).when(age <= 7, F.lit(b[1])).when(age <= 30, F.lit(b[2]))
            .when(age <= 90, F.lit(b[3])).otherwise(F.lit(b[4])))


def page_backlog_histogram(src, as_of: datetime) -> DataFrame:
    """Backlog age histogram, five buckets, alert above 30 days."""
    b = Model(src, as_of).mart("vw_backlog_open", needs=())
    order = F.when(T("age_days") <= 1, 1).when(T("age_days") <= 7, 2).when(T("age_days") <= 30, 3) \
             .when(T("age_days") <= 90, 4).otherwise(5)
    return (b.groupBy(order.alias("bucket_order"), _backlog_bucket(T("age_days")).alias("bucket"))
             .agg(F.count(F.lit(1)).alias("tickets"))
             .withColumn("alert", (T("bucket_order") >= 4).cast("int")))


def page_backlog_table(src, as_of: datetime) -> DataFrame:
    """Open backlog with row alerts, oldest first."""
    b = Model(src, as_of).mart("vw_backlog_open")
    return b.select("ticket_id", "priority_label", "category_name", "assigned_group", "technician_name", "age_days",
                    F.when(T("age_days") > 30, F.lit(RED)).when(T("age_days") > 7, F.lit(YELLOW)).alias("row_alert"),
                    T("priority_code").isin(4, 5).cast("int").alias("urgent")
                    ).orderBy(F.desc("age_days"), "ticket_id")


def page_open_problems(src, as_of: datetime) -> DataFrame:
    """Open problems (one row per problem)."""
    p = Model(src, as_of).mart("vw_fact_problems").where(T("status_code") != D.CLOSED_CODE)
    return p.select("problem_id", "problem_name", "linked_tickets", "status_label", "open_date").distinct()


def page_changes_in_progress(src, as_of: datetime) -> DataFrame:
    """Changes not yet solved (one row per change)."""
    c = Model(src, as_of).mart("vw_fact_changes").where(~T("status_code").isin(*D.RESOLVED_CODES))
    return c.select("change_id", "change_name", "status_label", "linked_tickets").distinct()


# ---------------------------------------------------------------- p04
def _tech_stats(m: Model) -> DataFrame:
    t = m.mart("vw_glpi_tickets", needs=("technician_id",)).where(T("technician_id").isNotNull())
    return t.groupBy("technician_id", "technician_name", "technician_group").agg(
        count_if(T("is_resolved") == 1).alias("tickets_closed"), count_if(T("is_open") == 1).alias("tickets_open"),
        F.round(F.avg("resolution_time_min") / 60.0, 4).alias("mttr_hours"), _sla_pct().alias("sla_pct"))


def page_technician_ranking(src, as_of: datetime) -> DataFrame:
    """G14 + W7/W8: rank by closed tickets, gap to the mean, load colour
    (>1.5x mean yellow, >2x red), worst-SLA and highest-MTTR flags."""
    s = rank_desc(reuse(_tech_stats(Model(src, as_of))), "tickets_closed", "rank")
    s = with_global(s, _mean=F.avg("tickets_closed"), _max_mttr=F.max("mttr_hours"), _min_sla=F.min("sla_pct"))
    load = (F.when(T("tickets_closed") > 2 * T("_mean"), F.lit(RED))
            .when(T("tickets_closed") > 1.5 * T("_mean"), F.lit(YELLOW)).otherwise(F.lit(GREEN)))
    return round_doubles(s.select(
        "rank", "technician_id", "technician_name", "technician_group", "tickets_closed", "tickets_open",
        "mttr_hours", "sla_pct", (T("tickets_closed") - T("_mean")).alias("gap_to_mean"), load.alias("load_color"),
        (T("sla_pct") < 70).cast("int").alias("sla_alert"),
        (T("mttr_hours") == T("_max_mttr")).cast("int").alias("is_max_mttr"),
        (T("sla_pct") == T("_min_sla")).cast("int").alias("is_worst_sla")))


def page_volume_mttr_quadrants(src, as_of: datetime) -> DataFrame:
    """Volume x MTTR quadrants split at the medians."""
    s = reuse(_tech_stats(Model(src, as_of)).where(T("mttr_hours").isNotNull()))
    middle = [exact_percentiles(s, [], c, {n: 0.5}) for c, n in (("tickets_closed", "_mv"), ("mttr_hours", "_mm"))]
    for one in middle:                                                              # one row each
        s = s.crossJoin(F.broadcast(one))
    hv, hm = T("tickets_closed") > T("_mv"), T("mttr_hours") > T("_mm")
    q = (F.when(hv & ~hm, F.lit(QUADRANTS[0])).when(~hv & hm, F.lit(QUADRANTS[1]))
         .when(hv & hm, F.lit(QUADRANTS[2])).otherwise(F.lit(QUADRANTS[3])))
    return s.select("technician_id", "technician_name", "tickets_closed", "mttr_hours", q.alias("quadrant"))


def page_tech_weekday_heatmap(src, as_of: datetime) -> DataFrame:
    """Closed tickets per technician x weekday of closure (Mon=1)."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=("technician_id",)).where(
        (T("is_closed") == 1) & T("technician_id").isNotNull())
    pv = (t.withColumn("wd", F.weekday("closed_at") + 1)
           .groupBy("technician_id", "technician_name").pivot("wd", list(range(1, 8))).agg(F.count(F.lit(1))))
    return pv.select("technician_id", "technician_name",
                     *[F.coalesce(T(str(d)), F.lit(0)).alias(f"d{d}") for d in range(1, 8)])


# ---------------------------------------------------------------- p05
def page_weekday_volume(src, as_of: datetime) -> DataFrame:
    """Tickets per weekday normalised by the number of weeks seen."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=())
    weeks = t.agg(F.count_distinct(F.date_trunc("week", "created_at")).alias("_weeks"))
    per = t.groupBy((F.weekday("created_at") + 1).alias("weekday")).agg(F.count(F.lit(1)).alias("tickets"))
    return per.crossJoin(F.broadcast(weeks)).select(
        "weekday", "tickets", F.round(T("tickets") / T("_weeks"), 4).alias("tickets_per_week"))


def page_hour_heatmap(src, as_of: datetime) -> DataFrame:
    """Weekday x hour grid (dense 7 x 24) of tickets created, beside
    the problems and changes opened (``records``)."""
    m = Model(src, as_of)
    slot = lambda c: ((F.weekday(c) + 1).alias("weekday"), F.hour(c).alias("hour"))
    created = m.mart("vw_glpi_tickets", needs=()).groupBy(*slot("created_at")).agg(F.count(F.lit(1)).alias("tickets"))
    opened = (m.mart("vw_fact_problems").select("problem_id", "open_date").distinct().select("open_date")
              .unionByName(m.mart("vw_fact_changes").select("change_id", "open_date").distinct().select("open_date")))
    counts = opened.groupBy(*slot("open_date")).agg(F.count(F.lit(1)).alias("records"))
    grid = (m.src["tickets"].sparkSession.range(1, 8).select(T("id").cast("int").alias("weekday"))
            .crossJoin(m.src["tickets"].sparkSession.range(0, 24).select(T("id").cast("int").alias("hour"))))
    return (grid.join(created, ["weekday", "hour"], "left").join(counts, ["weekday", "hour"], "left")
            .select("weekday", "hour", F.coalesce("tickets", F.lit(0)).alias("tickets"),
                    F.coalesce("records", F.lit(0)).alias("records")))


def page_priority_mom(src, as_of: datetime) -> DataFrame:
    """Created tickets per priority, current vs previous month."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=())
    cur = as_of.strftime("%Y-%m")
    prev = (as_of.replace(day=1) - timedelta(days=1)).strftime("%Y-%m")
    agg = t.groupBy("priority_code", "priority_label").agg(
        count_if(T("created_year_month") == cur).alias("current_month"),
        count_if(T("created_year_month") == prev).alias("previous_month"))
    return agg.withColumn("change", T("current_month") - T("previous_month"))


# FIXED VALUES: granularities of the series and their steps
TREND_STEPS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH"}


def trend(src, as_of: datetime, unit: str, width: int = 3, filters: dict | None = None) -> DataFrame:
    """Created tickets by day, week or month on a dense spine, with the
    average of the last ``width`` periods and a band of one standard deviation."""
    m = Model(src, as_of)
    t = m.star("vw_glpi_tickets", filters=filters) if filters else m.mart("vw_glpi_tickets", needs=())
    per = t.groupBy(F.to_date(F.date_trunc(unit, "created_at")).alias(unit)).agg(F.count(F.lit(1)).alias("tickets"))
    spine = per.agg(F.min(unit).alias("lo"), F.max(unit).alias("hi")).where("lo is not null").select(
        F.explode(F.sequence("lo", "hi", F.expr(TREND_STEPS[unit]))).alias(unit))
    s = spine.join(per, unit, "left").fillna({"tickets": 0})
    out = s.select(unit, "tickets", TI.moving_avg("tickets", width, month_col=unit).alias("avg_3"),
                   TI.moving_std("tickets", width, month_col=unit).alias("std_3"))
    return round_doubles(out.select(unit, "tickets", "avg_3", (T("avg_3") - T("std_3")).alias("band_low"),
                                    (T("avg_3") + T("std_3")).alias("band_high")))


def page_trend_weekly(src, as_of: datetime) -> DataFrame:
    return trend(src, as_of, "week")


def page_trend_daily(src, as_of: datetime) -> DataFrame:
    return trend(src, as_of, "day", width=7)


def page_trend_monthly(src, as_of: datetime) -> DataFrame:
    """Sliced by the category tree and the kind of entity, as a page's filters do."""
    return trend(src, as_of, "month", filters={"vw_dim_category.category_level_label": D.CATEGORY_SUB, "vw_dim_entity.entity_type": "Sub-entidade"})


def page_projection_30d(src, as_of: datetime, history_days: int | None = None, horizon: int = 30) -> DataFrame:
    """Linear projection of daily created tickets for the next
    ``horizon`` days, fitted on the whole daily series up to ``as_of`` (dense),
    or on its last ``history_days`` days when given."""
    t = Model(src, as_of).mart("vw_glpi_tickets", needs=())
    end = as_of.date()
    daily = (t.where(F.to_date("created_at") <= date_lit(end))
              .groupBy(F.to_date("created_at").alias("date")).agg(F.count(F.lit(1)).alias("tickets")))
    if history_days is not None:
        daily = daily.where(T("date") > date_lit(end - timedelta(days=history_days)))
        first = t.sparkSession.range(1).select(date_lit(end - timedelta(days=history_days - 1)).alias("first"))
    else:
        first = daily.agg(F.min("date").alias("first")).where(T("first").isNotNull())
    spine = first.select(F.explode(F.sequence("first", date_lit(end))).alias("date"))
    dense = spine.join(daily, "date", "left").fillna({"tickets": 0})
    return round_doubles(TI.linear_projection(dense, "tickets", "date", horizon))


# ---------------------------------------------------------------- p06
def page_entity_scorecard(src, as_of: datetime) -> DataFrame:
    """Entity scorecard with traffic light, worst SLA first."""
    m = Model(src, as_of)
    eo = m.mart("vw_entity_overview")
    sla = m.mart("vw_entity_sla_monthly").groupBy("entity_id").agg(
        divide(F.sum("within_sla"), F.sum("within_sla") + F.sum("breached_sla")).alias("sla_rate"))
    assets = m.mart("vw_entity_asset_distribution").groupBy("entity_id").agg(F.sum("total_assets").alias("asset_count"))
    j = eo.join(sla, "entity_id", "left").join(assets, "entity_id", "left")
    return round_doubles(j.select(
        "entity_id", "entity_name", "total_tickets", "open_tickets", "avg_resolution_hours", "sla_rate",
        F.when(T("sla_rate").isNotNull(), icon(T("sla_rate"))).alias("sla_icon"),
        F.coalesce("asset_count", F.lit(0)).cast("bigint").alias("asset_count"),
        T("total_projects").alias("project_count")).orderBy(F.asc_nulls_last("sla_rate"), "entity_name"))


def page_asset_treemap(src, as_of: datetime) -> DataFrame:
    """Entity -> asset kind with subtotals (rollup)."""
    d = Model(src, as_of).mart("vw_entity_asset_distribution")
    r = d.rollup("entity_name", "asset_type").agg(F.sum("total_assets").cast("bigint").alias("total_assets"),
                                                  F.sum("total_value_brl").alias("total_value"),
                                                  F.grouping_id().alias("level"))
    return round_doubles(r)


# ---------------------------------------------------------------- p07
def page_top_assets(src, as_of: datetime, k: int = 10) -> DataFrame:
    """Top-k assets by linked tickets with type, entity and MTTR."""
    m = Model(src, as_of)
    ai = m.mart("vw_fact_asset_incidents")
    top = reuse(top_k(ai, k, [F.desc("total_tickets"), F.asc("asset_key")]))     # k rows, used twice
    da = build_vw_dim_asset(src, as_of, keys=top.select("asset_itemtype", "asset_id"), needs=("asset_type",)).select(
        T("asset_key").alias("_k"), "asset_name", "asset_type", "entity_id")
    ent = m.mart("vw_dim_entity").select(T("entity_id").alias("_e"), "entity_name")
    j = top.join(da, T("asset_key") == T("_k"), "left").join(ent, T("entity_id") == T("_e"), "left")
    return j.select("asset_key", "asset_itemtype", "asset_name", "asset_type", "entity_name", "total_tickets",
                    F.round(T("avg_resolution_min") / 60.0, 4).alias("avg_resolution_hrs"))


def page_asset_kind_share(src, as_of: datetime) -> DataFrame:
    """Asset kinds (four CMDB kinds + phones + peripherals) and share."""
    m = Model(src, as_of)
    kinds = m.mart("vw_cmdb_summary").groupBy(T("asset_type").alias("kind")).agg(
        F.sum("total_assets").cast("bigint").alias("assets"))
    for label, table in (("Phone", "phones"), ("Peripheral", "peripherals")):
        kinds = kinds.unionByName(src[table].where(T("is_deleted") == 0).agg(
            F.lit(label).alias("kind"), F.count(F.lit(1)).alias("assets")))
    return with_global(kinds, _all=F.sum("assets")).select(
        "kind", "assets", F.round(100.0 * T("assets") / T("_all"), 2).alias("share_pct"))


def page_rack_matrix(src, as_of: datetime) -> DataFrame:
    """Rack x position matrix with hot slots (incidents > 0)."""
    r = Model(src, as_of).mart("vw_rack_inventory")
    return r.select("rack_name", "unit_position", "asset_name", "itemtype", "asset_serial", "incident_count",
                    (T("incident_count") > 0).cast("int").alias("is_hot"))


def page_license_bands(src, as_of: datetime) -> DataFrame:
    """Licence use bands (>100 red, <50 yellow, else green) and expiry alert."""
    sl = Model(src, as_of).mart("vw_fact_software_licenses")
    use = F.round(100.0 * divide(T("installations_count"), T("licenses_qty")), 2)
    today = date_lit(as_of)
    return sl.select("software_id", "software_name", "licenses_qty", "installations_count", use.alias("utilization_pct"),
                     F.when(use > 100, F.lit(RED)).when(use < 50, F.lit(YELLOW)).when(use.isNotNull(), F.lit(GREEN))
                      .alias("band"),
                     "license_expiry",
                     (T("license_expiry") < F.date_add(today, 30)).cast("int").alias("expiry_alert"))


def page_asset_drillthrough(src, as_of: datetime, hourly_rate: float = DEFAULT_HOURLY_RATE) -> DataFrame:
    """Per asset - ticket history summary, timeline bounds, covering
    contracts and support cost = resolution hours x hourly rate."""
    m = Model(src, as_of)
    at = m.mart("vw_fact_asset_tickets")
    t = m.mart("vw_glpi_tickets", needs=()).select(T("ticket_id").alias("_t"), "resolution_time_min")
    hist = at.join(t, T("ticket_id") == T("_t"), "left").groupBy("asset_key").agg(
        F.count(F.lit(1)).alias("tickets"), F.min("ticket_date").alias("first_ticket"),
        F.max("ticket_date").alias("last_ticket"),
        F.sum(F.coalesce("resolution_time_min", F.lit(0))).alias("_mins"))
    cov = (src["contracts_items"].groupBy(F.concat(T("itemtype"), F.lit("-"), T("items_id")).alias("asset_key"))
           .agg(F.count_distinct("contracts_id").alias("contracts")))
    j = hist.join(cov, "asset_key", "left")
    return round_doubles(j.select("asset_key", "tickets", "first_ticket", "last_ticket",
                                  F.coalesce("contracts", F.lit(0)).alias("contracts"),
                                  (T("_mins") / 60.0 * F.lit(float(hourly_rate))).alias("support_cost")))


def page_asset_events(src, as_of: datetime, asset_key: str | None = None) -> DataFrame:
    """One ordered line of events per asset: purchase, warranty end, tickets opened and solved, contracts begun
    and ended.  ``event_no`` counts along an asset's line; ``open_tickets`` is the number open after the event, and
    ``covered`` whether a contract runs that day.  ``asset_key`` drills through to one asset."""
    m = Model(src, as_of)
    key = F.concat(T("itemtype"), F.lit("-"), T("items_id")).alias("asset_key")
    at = m.mart("vw_fact_asset_tickets").select("asset_key", "ticket_id")
    t = m.mart("vw_glpi_tickets", needs=()).select(T("ticket_id").alias("_t"), "created_at", "resolved_at")
    linked = at.distinct().join(t, T("ticket_id") == T("_t"))
    money = m.mart("vw_fact_asset_financials").select(key, "buy_date", "warranty_end_date")
    spans = _contract_spans(src)

    def events(df: DataFrame, when: str, what: str, ref: str, step: int, cover: int = 0) -> DataFrame:
        return df.where(T(when).isNotNull()).select("asset_key", T(when).cast("timestamp_ntz").alias("event_at"), F.lit(what).alias("event"),
                                                    T(ref).cast("bigint").alias("ref_id") if ref else F.lit(None).cast("bigint").alias("ref_id"),
                                                    F.lit(step).alias("_open"), F.lit(cover).alias("_cover"))

    parts = [events(money, "buy_date", "bought", "", 0), events(money, "warranty_end_date", "warranty_end", "", 0),
             events(linked, "created_at", "ticket_opened", "ticket_id", 1), events(linked, "resolved_at", "ticket_solved", "ticket_id", -1),
             events(spans, "begin_date", "contract_begin", "contract_id", 0, 1), events(spans, "end_date", "contract_end", "contract_id", 0, -1)]
    line = parts[0]
    for p in parts[1:]:
        line = line.unionByName(p)
    if asset_key is not None:
        line = line.where(T("asset_key") == asset_key)
    order = Window.partitionBy("asset_key").orderBy("event_at", "event", F.col("ref_id").asc_nulls_first())
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    return line.select("asset_key", F.row_number().over(order).cast("bigint").alias("event_no"), "event_at", "event", "ref_id",
                       F.sum("_open").over(so_far).alias("open_tickets"), (F.sum("_cover").over(so_far) > 0).cast("int").alias("covered"))


def _contract_spans(src) -> DataFrame:
    """(asset_key, contract_id, name, begin_date, end_date): the period in which a contract covers an asset, end excluded."""
    items = src["contracts_items"].select(T("contracts_id").alias("_c"), F.concat(T("itemtype"), F.lit("-"), T("items_id")).alias("asset_key")).distinct()
    c = src["contracts"].where(T("is_deleted") == 0).select(T("id").alias("contract_id"), T("name").alias("contract_name"), "begin_date",
                                                          add_months_ts(T("begin_date"), T("duration")).alias("end_date"))
    return items.join(c, T("_c") == T("contract_id")).drop("_c")


def page_asset_contracts(src, as_of: datetime) -> DataFrame:
    """A row per asset and covering contract, with the asset's tickets opened in the contract's period and their
    cost, and whether the contract runs at ``as_of``.

    Intervals meet points by a join on the asset alone, after tickets and contracts were reduced to (asset, day) counts
    and (asset, contract) periods: an asset's days times its contracts, not all tickets times all contracts."""
    m = Model(src, as_of)
    t = m.mart("vw_glpi_tickets", needs=()).select(T("ticket_id").alias("_t"), F.to_date("created_at").alias("_day"), "resolution_time_min")
    days = (m.mart("vw_fact_asset_tickets").select("asset_key", "ticket_id").distinct().join(t, T("ticket_id") == T("_t"))
            .groupBy(T("asset_key").alias("_k"), "_day").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.coalesce("resolution_time_min", F.lit(0))).alias("_min")))
    spans = _contract_spans(src)
    inside = (T("asset_key") == T("_k")) & (T("_day") >= F.to_date("begin_date")) & (T("end_date").isNull() | (T("_day") < F.to_date("end_date")))
    j = spans.join(days, inside, "left").groupBy("asset_key", "contract_id", "contract_name", "begin_date", "end_date").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("tickets_in_period"), (F.coalesce(F.sum("_min"), F.lit(0)) / 60.0 * DEFAULT_HOURLY_RATE).alias("support_cost"))
    today = F.lit(as_of.date())
    runs = (F.to_date("begin_date") <= today) & (T("end_date").isNull() | (today < F.to_date("end_date")))
    return round_doubles(j.select("asset_key", "contract_id", "contract_name", F.to_date("begin_date").alias("begin_date"), F.to_date("end_date").alias("end_date"),
                                  "tickets_in_period", "support_cost", F.coalesce(runs, F.lit(False)).cast("int").alias("is_running")))


# ---------------------------------------------------------------- p08
# FIXED VALUES: traffic-light rules (indicator, above this value, up to and including this one, colour); None: open
LIGHT_RULES = [
    ("sla_pct", 90.0, None, GREEN), ("sla_pct", 80.0, 90.0, YELLOW), ("sla_pct", None, 80.0, RED),
    ("mttr_hours", None, 24.0, GREEN), ("mttr_hours", 24.0, 48.0, YELLOW), ("mttr_hours", 48.0, None, RED),
    ("backlog_days", None, 7.0, GREEN), ("backlog_days", 7.0, 30.0, YELLOW), ("backlog_days", 30.0, None, RED),
    ("license_use_pct", 50.0, 100.0, GREEN), ("license_use_pct", 100.0, None, YELLOW), ("license_use_pct", 30.0, 50.0, YELLOW),
    ("license_use_pct", None, 30.0, RED),
    ("tickets_per_mean", None, 1.5, GREEN), ("tickets_per_mean", 1.5, 2.0, YELLOW), ("tickets_per_mean", 2.0, None, RED),
]
# FIXED VALUES: indicators whose bounds belong to the band above them (from and including, up to)
CLOSED_BELOW = ("sla_pct", "license_use_pct")


def light_rules(spark, rules: list[tuple] | None = None) -> DataFrame:
    """The rules as a table: a rule changes without code.  ``edge`` says to which side a bound belongs."""
    rows = [(*r, "low" if r[0] in CLOSED_BELOW else "high") for r in (LIGHT_RULES if rules is None else rules)]
    return spark.createDataFrame(rows, "indicator string, low double, high double, color string, edge string")


def colored(values: DataFrame, rules: DataFrame) -> DataFrame:
    """(indicator, value) rows with the colour of the band that holds the value (joined by interval; a few rules per
    indicator).  No value or no band: no colour.  Of bands that overlap the first by colour counts."""
    v, low, high = T("value"), T("low"), T("high")
    above = low.isNull() | F.when(T("edge") == "low", v >= low).otherwise(v > low)
    below = high.isNull() | F.when(T("edge") == "low", (v < high) | ((v == high) & (T("color") == GREEN))).otherwise(v <= high)
    r = rules.withColumnRenamed("indicator", "_indicator")
    keys = values.columns
    j = values.join(F.broadcast(r), (T("indicator") == T("_indicator")) & v.isNotNull() & above & below, "left")
    return j.groupBy(*keys).agg(F.min("color").alias("color"))


def page_traffic_lights(src, as_of: datetime) -> DataFrame:
    """The table of rules applied to the headline indicators.  The technicians' load is the highest number of
    tickets of one technician as a multiple of the mean."""
    m = Model(src, as_of)
    k = evaluate(m, ["sla_compliance_rate", "avg_resolution_hrs", "avg_backlog_age_days", "license_utilization"])
    load = m.mart("vw_tech_productivity").groupBy("technician_id").agg(F.sum("tickets_assigned").alias("n"))
    k = k.crossJoin(F.broadcast(load.agg((F.max("n") / F.avg("n")).alias("tickets_per_mean"))))
    named = {"sla_pct": 100 * T("sla_compliance_rate"), "mttr_hours": T("avg_resolution_hrs"), "backlog_days": T("avg_backlog_age_days"),
             "license_use_pct": 100 * T("license_utilization"), "tickets_per_mean": T("tickets_per_mean")}
    rows = k.select(F.explode(F.array(*[F.struct(F.lit(n).alias("indicator"), v.cast("double").alias("value")) for n, v in named.items()])).alias("r"))
    return round_doubles(colored(rows.select("r.indicator", "r.value"), light_rules(src["tickets"].sparkSession)))


def page_technician_load(src, as_of: datetime) -> DataFrame:
    """Every technician's load light by month, from the same table of rules."""
    p = Model(src, as_of).mart("vw_tech_productivity").select("year_month", "technician_id", "tickets_assigned")
    mean = p.groupBy(T("year_month").alias("_ym")).agg(F.avg("tickets_assigned").alias("_mean"))
    v = p.join(mean, T("year_month").eqNullSafe(T("_ym"))).select(
        "year_month", "technician_id", "tickets_assigned", F.lit("tickets_per_mean").alias("indicator"), (T("tickets_assigned") / T("_mean")).alias("value"))
    return round_doubles(colored(v, light_rules(src["tickets"].sparkSession)).drop("indicator"))


QUERIES = {
    "page_kpi_strip": page_kpi_strip,
    "page_monthly_volume_sla": page_monthly_volume_sla,
    "page_status_mix": page_status_mix,
    "page_entity_treemap": page_entity_treemap,
    "page_top_categories": page_top_categories,
    "page_entity_sla_trend": page_entity_sla_trend,
    "page_sla_by_category": page_sla_by_category,
    "page_sla_matrix": page_sla_matrix,
    "page_recent_breaches": page_recent_breaches,
    "page_at_risk": page_at_risk,
    "page_category_type": page_category_type,
    "page_lifecycle_funnel": page_lifecycle_funnel,
    "page_backlog_histogram": page_backlog_histogram,
    "page_backlog_table": page_backlog_table,
    "page_open_problems": page_open_problems,
    "page_changes_in_progress": page_changes_in_progress,
    "page_technician_ranking": page_technician_ranking,
    "page_volume_mttr_quadrants": page_volume_mttr_quadrants,
    "page_tech_weekday_heatmap": page_tech_weekday_heatmap,
    "page_weekday_volume": page_weekday_volume,
    "page_hour_heatmap": page_hour_heatmap,
    "page_priority_mom": page_priority_mom,
    "page_trend_weekly": page_trend_weekly,
    "page_trend_daily": page_trend_daily,
    "page_trend_monthly": page_trend_monthly,
    "page_projection_30d": page_projection_30d,
    "page_entity_scorecard": page_entity_scorecard,
    "page_asset_treemap": page_asset_treemap,
    "page_top_assets": page_top_assets,
    "page_asset_kind_share": page_asset_kind_share,
    "page_rack_matrix": page_rack_matrix,
    "page_license_bands": page_license_bands,
    "page_asset_drillthrough": page_asset_drillthrough,
    "page_asset_events": page_asset_events,
    "page_asset_contracts": page_asset_contracts,
    "page_traffic_lights": page_traffic_lights,
    "page_technician_load": page_technician_load,
}
