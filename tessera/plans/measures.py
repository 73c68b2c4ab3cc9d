"""The 88 measures, evaluated under any grouping and filter context.

A measure is one of
* ``agg``   - an aggregate Column over one mart (CALCULATE predicates are
              folded into the aggregate as ``count_if`` / ``sum(when ...)``);
* ``table`` - a small DataFrame-level computation (two-level aggregates,
              arg-max "TOPN 1 + MAXX", ALL()) returning ``by + [name]``;
* ``post``  - arithmetic over other measures (ratios, icons).

``evaluate`` runs ONE ``groupBy(by).agg(...)`` per (mart, date role) for
all ``agg`` measures, so a page that shows ten KPIs of one mart scans and
shuffles it once.  Results of different marts are joined on the ``by``
keys.  Time keys (``date``, ``year_month``, ``year``) are derived per
measure from its date role, which is how "created" and "resolved" counts
share one month axis (W9).

Bindings follow the decisions of SURVEY 2.13: codes/flags instead of the
English labels the measures test, real column names, NULL where the
source column does not exist (reopen count, contract cost, change type).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import domains as D
from tessera.functions.time import date_lit, ntz
from tessera.operators import timeintel as TI
from tessera.operators.percentile import exact_percentiles
from tessera.plans.model import Model, apply_filters, linked_columns, with_dimensions

T = F.col
TIME_KEYS = ("date", "year_month", "year")


@dataclass(frozen=True)
class Ctx:
    model: Model
    filters: dict
    exact_percentile: bool = True

    @property
    def today(self) -> Column:
        return date_lit(self.model.as_of)

    @property
    def now(self) -> Column:
        return ntz(self.model.as_of)


@dataclass(frozen=True)
class Measure:
    name: str
    ref: str
    kind: str                                   # agg | table | post
    mart: str | None = None
    expr: Callable[[Ctx], Column] | None = None
    table: Callable[[DataFrame, list, Ctx], DataFrame] | None = None
    post: Callable[[Ctx], Column] | None = None
    deps: tuple = ()
    date_col: str | None = None
    optional_col: str | None = None             # measure is NULL when the mart lacks it
    unfiltered: bool = False                    # ALL(): ignore the filter context
    needs: tuple = ()                           # join-provided mart columns the measure reads
    share: tuple | None = None                  # percentile measures: (column, share)


def count_if(pred: Column) -> Column:
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def divide(a: Column, b: Column, alt=None) -> Column:
    """DAX DIVIDE: NULL (or ``alt``) when the denominator is 0 or NULL."""
    r = a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))
    return F.coalesce(r, F.lit(alt)) if alt is not None else r


def distinct_with_blank(c: Column) -> Column:
    """DISTINCTCOUNT counts BLANK as one more value."""
    return F.count_distinct(c) + F.max(F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0)))


# FIXED VALUES: traffic-light icons
ICON_OK, ICON_WARN, ICON_BAD = "✓", "⚠", "🔴"


def icon(rate: Column) -> Column:
    return (F.when(rate >= D.SLA_ICON_GREEN, F.lit(ICON_OK)).when(rate >= D.SLA_ICON_YELLOW, F.lit(ICON_WARN))
            .otherwise(F.lit(ICON_BAD)))


def arg_max(df: DataFrame, by: list, name_col: Column, value_col: Column, out: str,
            pre_group: list | None = None, descending: bool = True) -> DataFrame:
    """TOPN(1, ..., value) + MAXX(name): all ties kept, largest name wins.
    ``pre_group`` first aggregates value per (by + pre_group) (VALUES/ADDCOLUMNS)."""
    if pre_group is not None:
        df = df.groupBy(*by, *pre_group).agg(value_col.alias("_v"))
        name_col, value_col = T(pre_group[0]), T("_v")
    key = value_col if descending else -value_col
    return df.groupBy(*by).agg(F.max_by(name_col, F.struct(key, name_col)).alias(out))


M: list[Measure] = []


def _agg(name, ref, mart, expr, date_col=None, optional_col=None, needs=()):
    M.append(Measure(name, ref, "agg", mart, expr=expr, date_col=date_col, optional_col=optional_col,
                     needs=tuple(needs)))


def _percentile(name, ref, mart, col, p, date_col=None):
    """Exact: a search in the value histogram, beside the other aggregates; else a sketch among them."""
    M.append(Measure(name, ref, "agg", mart, expr=lambda c: F.percentile_approx(T(col), p, 10000).cast("double"), date_col=date_col, share=(col, p)))


def _post(name, ref, post, deps):
    M.append(Measure(name, ref, "post", post=post, deps=tuple(deps)))


def _table(name, ref, mart, fn, date_col=None, unfiltered=False):
    M.append(Measure(name, ref, "table", mart, table=fn, date_col=date_col, unfiltered=unfiltered))


TK = "vw_glpi_tickets"
OPEN = lambda: T("is_open") == 1

# ---------------------------------------------------------------- core
_agg("total_tickets", "M1", TK, lambda c: F.count(F.lit(1)), "created_at")
_agg("open_tickets", "M2", TK, lambda c: count_if(T("is_open") == 1), "created_at")
_agg("closed_tickets", "M3", TK, lambda c: count_if(T("is_resolved") == 1), "created_at")
_agg("tickets_created", "M4", TK, lambda c: F.count(F.lit(1)), "created_at")
_agg("tickets_resolved", "M5", TK, lambda c: count_if(T("resolved_at").isNotNull()), "resolved_at")
_post("resolution_rate", "M6", lambda c: divide(T("tickets_resolved"), T("tickets_created")),
      ["tickets_resolved", "tickets_created"])
_agg("sla_compliant", "M7", TK, lambda c: count_if(T("sla_status") == D.SLA_MET), "created_at")
_agg("sla_breached", "M8", TK, lambda c: count_if(T("sla_status").isin(D.SLA_BREACHED, D.SLA_BREACHED_OPEN)),
     "created_at")
_post("sla_compliance_rate", "M9",
      lambda c: divide(T("sla_compliant"), T("sla_compliant") + T("sla_breached")), ["sla_compliant", "sla_breached"])
_post("sla_status_icon", "M11", lambda c: icon(T("sla_compliance_rate")), ["sla_compliance_rate"])
_agg("avg_resolution_min", "M12", TK, lambda c: F.avg("resolution_time_min"), "created_at")
_post("avg_resolution_hrs", "M13", lambda c: divide(T("avg_resolution_min"), F.lit(60)), ["avg_resolution_min"])
_percentile("median_resolution_min", "M14", TK, "resolution_time_min", 0.5, "created_at")
_percentile("p90_resolution_min", "M15", TK, "resolution_time_min", 0.9, "created_at")
_agg("aged_tickets_7d", "M16", TK,
     lambda c: count_if((T("is_open") == 1) & (F.datediff(c.today, F.to_date("created_at")) > 7)), "created_at")
BK = "vw_backlog_open"
_agg("backlog_0_1d", "M17", BK, lambda c: count_if(T("age_days") <= 1), "created_at")
_agg("backlog_2_7d", "M18", BK, lambda c: count_if(T("age_days").between(2, 7)), "created_at")
_agg("backlog_8_30d", "M19", BK, lambda c: count_if(T("age_days").between(8, 30)), "created_at")
_agg("backlog_over_30d", "M20", BK, lambda c: count_if(T("age_days") > 30), "created_at")
_agg("avg_backlog_age_days", "M21", BK, lambda c: F.avg("age_days"), "created_at")
_agg("active_technicians", "M22", TK, lambda c: distinct_with_blank(T("technician_id")), "created_at",
     needs=("technician_id",))
_post("tickets_per_technician", "M23", lambda c: divide(T("closed_tickets"), T("active_technicians")),
      ["closed_tickets", "active_technicians"])
_agg("reopen_tickets", "M24a", TK, lambda c: count_if(T("reopen_count") > 0), "created_at", optional_col="reopen_count")
_post("reopen_rate", "M24", lambda c: divide(T("reopen_tickets"), T("total_tickets")), ["reopen_tickets", "total_tickets"])
TP = "vw_tech_productivity"


def _tech_workload(df, by, ctx):
    """M25 + M26 from ONE pass over V8: per technician name the total and
    the best single month of closed tickets; then the population std-dev
    of the totals and the arg-max name (ties -> largest name)."""
    per = df.groupBy(*by, "technician_name").agg(F.sum("tickets_closed").alias("_t"),
                                                F.max("tickets_closed").alias("_mx"))
    return per.groupBy(*by).agg(
        F.stddev_pop("_t").alias("workload_stddev"),
        F.max_by("technician_name", F.struct(T("_mx"), T("technician_name"))).alias("top_performer"))


_table("_tech_workload", "M25/M26", TP, _tech_workload)
_post("workload_stddev", "M25", lambda c: T("workload_stddev"), ["_tech_workload"])
_post("top_performer", "M26", lambda c: T("top_performer"), ["_tech_workload"])


def _peak_weekday(ctx: Ctx) -> Column:
    """Peak weekday in the main aggregation pass: seven conditional counts,
    then the largest (count, name) struct - ties go to the largest name,
    as TOPN(1) + MAXX does.  DAYOFWEEK numbering: Sunday = 1."""
    names = (D.WEEKDAY_NAMES_EN[6],) + D.WEEKDAY_NAMES_EN[:6]
    cells = [F.struct(count_if(T("created_weekday") == i + 1).alias("n"), F.lit(n).alias("name"))
             for i, n in enumerate(names)]
    return F.array_max(F.array(*cells)).getField("name")


_agg("peak_weekday", "M27", TK, _peak_weekday, "created_at")
_agg("created_today", "M33", TK, lambda c: count_if(F.to_date("created_at") == c.today), "created_at")
_agg("resolved_today", "M34", TK, lambda c: count_if(F.to_date("resolved_at") == c.today), "resolved_at")
_post("today_resolution_rate", "M35", lambda c: divide(T("resolved_today"), T("created_today")),
      ["resolved_today", "created_today"])

# ---------------------------------------------------------------- entity
EO, ES, EA, EP, RK = ("vw_entity_overview", "vw_entity_sla_monthly", "vw_entity_asset_distribution",
                      "vw_entity_project_performance", "vw_rack_inventory")
_agg("entity_tickets", "M36", EO, lambda c: F.sum("total_tickets").cast("bigint"))
_agg("entity_avg_resolution_hrs", "M37", EO, lambda c: F.avg("avg_resolution_hours"))
_agg("entity_sla_within", "M38a", ES, lambda c: F.sum("within_sla").cast("bigint"))
_agg("entity_sla_breached", "M39", ES, lambda c: F.sum("breached_sla").cast("bigint"))
_post("entity_sla_compliance", "M38",
      lambda c: divide(T("entity_sla_within"), T("entity_sla_within") + T("entity_sla_breached")),
      ["entity_sla_within", "entity_sla_breached"])
_agg("entity_asset_value", "M40", EA, lambda c: F.sum("total_value_brl"))
_agg("entity_asset_count", "M41a", EA, lambda c: F.sum("total_assets").cast("bigint"))
_table("entity_asset_count_all", "M41b", EA,
       lambda df, by, c: df.agg(F.sum("total_assets").cast("bigint").alias("entity_asset_count_all")),
       unfiltered=True)
_post("entity_asset_share", "M41", lambda c: divide(T("entity_asset_count"), T("entity_asset_count_all")),
      ["entity_asset_count", "entity_asset_count_all"])
_table("top_entity_by_tickets", "M42", EO,
       lambda df, by, c: arg_max(df, by, T("entity_name"), T("total_tickets"), "top_entity_by_tickets"))


def _worst_sla(df, by, ctx):
    per = df.groupBy(*by, "entity_name").agg(
        divide(F.sum("within_sla"), F.sum("within_sla") + F.sum("breached_sla"), alt=1.0).alias("_r"))
    return arg_max(per, by, T("entity_name"), T("_r"), "worst_sla_entity", descending=False)


_table("worst_sla_entity", "M43", ES, _worst_sla)
_post("entity_sla_icon", "M44", lambda c: icon(T("entity_sla_compliance")), ["entity_sla_compliance"])
_agg("entity_active_projects", "M46", EP, lambda c: count_if(T("completed_tasks") < T("total_tasks")))
_agg("entity_completed_tasks", "M47a", EP, lambda c: F.sum("completed_tasks").cast("bigint"))
_agg("entity_total_tasks", "M47b", EP, lambda c: F.sum("total_tasks").cast("bigint"))
_post("entity_task_completion", "M47", lambda c: divide(T("entity_completed_tasks"), T("entity_total_tasks")),
      ["entity_completed_tasks", "entity_total_tasks"])
_agg("rack_items", "M48", RK, lambda c: F.count(F.lit(1)))
_agg("rack_linked_incidents", "M49", RK, lambda c: F.sum("incident_count").cast("bigint"))
_agg("rack_assets_with_incidents", "M50", RK, lambda c: count_if(T("incident_count") > 0))
_agg("rack_utilisation", "M51", RK, lambda c: count_if(T("asset_name").isNotNull()))
_table("hottest_rack", "M52", RK,
       lambda df, by, c: arg_max(df, by, None, F.sum("incident_count"), "hottest_rack", pre_group=["rack_name"]))

# ---------------------------------------------------------------- CMDB / ITIL
DA, AI, AF, SC, SL, KB, SS, PR, CH, PJ, PT = (
    "vw_dim_asset", "vw_fact_asset_incidents", "vw_fact_asset_financials", "vw_fact_supplier_contracts",
    "vw_fact_software_licenses", "vw_fact_kb_usage", "vw_fact_satisfaction_summary", "vw_fact_problems",
    "vw_fact_changes", "vw_fact_projects", "vw_fact_project_tasks")
_agg("total_assets", "M53", DA, lambda c: F.count_distinct("asset_key"))
_agg("assets_with_incidents", "M54", AI, lambda c: F.count_distinct("asset_key"))
_post("assets_with_incidents_pct", "M55", lambda c: divide(T("assets_with_incidents"), T("total_assets")),
      ["assets_with_incidents", "total_assets"])
_agg("total_asset_incidents", "M56", AI, lambda c: F.sum("total_tickets").cast("bigint"))


def _most_incident_prone(df, by, ctx):
    names = ctx.model.mart(DA, needs=()).select(T("asset_key").alias("_k"), T("asset_name").alias("_n"))
    j = df.join(names, T("asset_key") == T("_k"), "left")
    return arg_max(j, by, T("_n"), T("total_tickets"), "most_incident_prone_asset")


_table("most_incident_prone_asset", "M57", AI, _most_incident_prone)
_agg("server_count", "M58", DA,
     lambda c: count_if((T("asset_itemtype") == "Computer") & (F.substring("asset_name", 1, 3) == "SRV")))
_agg("desktop_count", "M59", DA,
     lambda c: count_if((T("asset_itemtype") == "Computer") & (F.substring("asset_name", 1, 2) == "WS")))
_agg("network_equipment_count", "M60", DA, lambda c: count_if(T("asset_itemtype") == "NetworkEquipment"))
_agg("total_asset_value", "M61", AF, lambda c: F.sum("purchase_value"))
_agg("avg_asset_value", "M62", AF, lambda c: F.avg("purchase_value"))
_agg("entity_asset_financial_value", "M63", AF, lambda c: F.sum("purchase_value"))
_agg("total_contract_value", "M64", SC, lambda c: F.sum("cost"), optional_col="cost")
_agg("active_contracts", "M65", SC, lambda c: count_if(T("end_date") >= c.today))
_agg("expiring_contracts_30d", "M66", SC, lambda c: count_if(T("end_date").between(c.today, F.date_add(c.today, 30))))
_agg("total_softwares", "M67", SL, lambda c: F.count_distinct("software_id"))
_agg("total_installations", "M68", SL, lambda c: F.sum("installations_count").cast("bigint"))
_agg("total_licenses", "M69a", SL, lambda c: F.sum("licenses_qty").cast("bigint"))
_post("license_utilization", "M69", lambda c: divide(T("total_installations"), T("total_licenses")),
      ["total_installations", "total_licenses"])
_agg("over_licensed_softwares", "M70", SL, lambda c: count_if(T("installations_count") > T("licenses_qty")))
_agg("expiring_licenses_30d", "M71", SL,
     lambda c: count_if((T("license_expiry") <= F.date_add(c.today, 30)) & (T("license_expiry") >= c.today)))
_agg("kb_articles", "M72", KB, lambda c: F.count(F.lit(1)))
_agg("kb_articles_viewed", "M73", KB, lambda c: count_if(T("view_count") > 0))
_post("kb_adoption_rate", "M74", lambda c: divide(T("kb_articles_viewed"), T("kb_articles")),
      ["kb_articles_viewed", "kb_articles"])
_agg("kb_views", "M75", KB, lambda c: F.sum("view_count").cast("bigint"))
_agg("avg_satisfaction_score", "M76", SS, lambda c: F.avg("avg_satisfaction"))
_agg("total_ratings", "M77", SS, lambda c: F.sum("responses").cast("bigint"))
_post("satisfaction_response_rate", "M78", lambda c: divide(T("total_ratings"), T("closed_tickets")),
      ["total_ratings", "closed_tickets"])
_agg("negative_ratings", "M79", SS,
     lambda c: F.sum(F.when(T("avg_satisfaction") < 3, T("responses"))).cast("bigint"))
_post("negative_rating_rate", "M80", lambda c: divide(T("negative_ratings"), T("total_ratings")),
      ["negative_ratings", "total_ratings"])
_agg("open_problems", "M81", PR, lambda c: count_if(T("status_code") != D.CLOSED_CODE))
_agg("problems_with_tickets", "M82", PR, lambda c: count_if(T("linked_tickets") > 0))
_agg("avg_tickets_per_problem", "M83", PR, lambda c: F.avg("linked_tickets"))
_agg("changes_in_progress", "M84", CH, lambda c: count_if(~T("status_code").isin(*D.RESOLVED_CODES)))
_agg("emergency_changes", "M85", CH, lambda c: count_if(T("change_type") == "Emergency"), optional_col="change_type")
_agg("active_projects", "M86", PJ, lambda c: count_if(T("state_category") != D.PROJECT_FINISHED))
_agg("project_tasks_done", "M87a", PT, lambda c: count_if(T("pct_done") == 100))
_agg("project_tasks", "M87b", PT, lambda c: F.count(F.lit(1)))
_post("project_task_completion", "M87", lambda c: divide(T("project_tasks_done"), T("project_tasks")),
      ["project_tasks_done", "project_tasks"])
_agg("overdue_projects", "M88", PJ,
     lambda c: count_if((T("planned_end") < c.now) & (T("state_category") != D.PROJECT_FINISHED)))

MEASURES: dict[str, Measure] = {m.name: m for m in M}

# Time-intelligence measures (M10, M28-M32, M45): name -> (base measure,
# shape, value of a month without rows).  They need ``year_month`` among the
# keys and are computed on the dense month spine of the other keys.
TIME_INTELLIGENCE = {
    "sla_compliance_mom": ("sla_compliance_rate", "change", None),
    "tickets_prev_month": ("tickets_created", "previous", 0),
    "tickets_mom_change": ("tickets_created", "change", 0),
    "tickets_mom_pct": ("tickets_created", "change_pct", 0),
    "tickets_avg_3m": ("tickets_created", "average_3", 0),
    "tickets_yoy_pct": ("tickets_created", "yoy_pct", 0),
    "entity_sla_mom": ("entity_sla_compliance", "change", None),
}


# ---------------------------------------------------------------- evaluation
def _closure(names: Iterable[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in MEASURES[n].deps:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def _time_keys(df: DataFrame, by: list, date_col: str | None) -> DataFrame:
    need = [k for k in by if k in TIME_KEYS and k not in df.columns]
    if not need:
        return df
    if date_col is None:
        raise ValueError(f"time key {need} needs a date role")
    d = T(date_col)
    df = df.where(d.isNotNull())
    for k in need:
        if k == "date":
            df = df.withColumn("date", F.to_date(d))
        elif k == "year_month":
            df = df.withColumn("year_month", F.date_format(d, "yyyy-MM"))
        else:
            df = df.withColumn("year", F.year(d))
    return df


def _over_months(model: Model, names: list, by: list, filters, ignore, exact_percentile: bool, roles: list) -> DataFrame:
    """Time-intelligence measures beside plain ones: the base measures are
    evaluated once per month and key, then compared along the spine.  Months
    are those from the first to the last of the result; plain measures are
    NULL in a month without rows, counts that are compared are 0."""
    if "year_month" not in by:
        raise ValueError("time-intelligence measures need year_month among the keys")
    keys = [k for k in by if k != "year_month"]
    shifted = [n for n in names if n in TIME_INTELLIGENCE]
    plain = [n for n in names if n not in TIME_INTELLIGENCE]
    bases = dict.fromkeys(TIME_INTELLIGENCE[n][0] for n in shifted)
    per = evaluate(model, [*plain, *[b for b in bases if b not in plain]], by, filters, ignore, exact_percentile, roles)
    by, keys = [k.rsplit(".", 1)[-1] for k in by], [k.rsplit(".", 1)[-1] for k in keys]
    for b in bases:
        empty = next(TIME_INTELLIGENCE[n][2] for n in shifted if TIME_INTELLIGENCE[n][0] == b)
        per = per.withColumn(f"_{b}", T(b) if empty is None else F.coalesce(T(b), F.lit(empty)))
    zero = {f"_{TIME_INTELLIGENCE[n][0]}": TIME_INTELLIGENCE[n][2] for n in shifted if TIME_INTELLIGENCE[n][2] is not None}
    values = [*plain, *[f"_{b}" for b in bases]]
    s = TI.on_spine(per.where(T("year_month").isNotNull()).select(*by, *values), values, by=keys, fill=zero)

    def shape(n: str):
        base, kind, _ = TIME_INTELLIGENCE[n]
        base = f"_{base}"
        if kind == "average_3":
            return TI.moving_avg(base, 3, by=keys)
        before = TI.shift_period(base, 12 if kind == "yoy_pct" else 1, by=keys)
        return {"previous": before, "change": TI.delta(T(base), before)}.get(kind, TI.pct_change(T(base), before))

    return s.select(*by, *[shape(n).alias(n) if n in TIME_INTELLIGENCE else T(n) for n in names])


def evaluate(model: Model, names: Iterable[str], by: Iterable[str] = (), filters: dict | None = None,
             ignore: Iterable[str] = (), exact_percentile: bool = True, roles: Iterable[str] = ()) -> DataFrame:
    """Evaluate ``names`` grouped by ``by`` under ``filters``; ``ignore``
    lists measures evaluated without filters (ALL).  Keys of ``by`` are columns
    of the marts, time keys, or ``dimension.column`` reached along the
    relationships; ``roles`` switches inactive relationships on."""
    names, by, ignore, roles = list(names), list(by), set(ignore), list(roles)
    if any(n in TIME_INTELLIGENCE for n in names):
        return _over_months(model, names, by, filters, ignore, exact_percentile, roles)
    dimensions, by = [k for k in by if "." in k], [k.rsplit(".", 1)[-1] for k in by]
    if len(set(by)) < len(by):
        raise ValueError(f"two keys of one name in {by}")
    ctx = Ctx(model, filters or {}, exact_percentile)
    todo = _closure(names)
    groups: dict[tuple, list[Measure]] = {}
    parts: list[DataFrame] = []
    timed = any(k in TIME_KEYS for k in by)
    for n in todo:
        m = MEASURES[n]
        if m.kind == "agg":
            # the date role only matters when the grouping has time keys;
            # otherwise all measures of a mart share ONE aggregation pass
            role = m.date_col if timed else None
            groups.setdefault((m.mart, role, n in ignore), []).append(m)
    ctx_cols = set(by) | {k for k in ctx.filters if "." not in k}
    links = lambda mart: linked_columns(mart, [*dimensions, *ctx.filters], roles) | {
        k.split(".", 1)[1] for k in [*dimensions, *ctx.filters] if k.split(".", 1)[0] == mart and "." in k}
    def rows(mart: str, date_col: str | None, unfiltered: bool, ms: list[Measure]) -> DataFrame:
        df = model.mart(mart, needs=(ctx_cols | links(mart)).union(*[m.needs for m in ms]))
        if not unfiltered:
            df = apply_filters(model, mart, df, ctx.filters, roles)
        return _time_keys(with_dimensions(model, mart, df, dimensions, roles), by, date_col)

    for (mart, date_col, unfiltered), ms in groups.items():
        shared = [m for m in ms if m.share and exact_percentile]
        plain = [m for m in ms if m not in shared]
        if plain:
            df = rows(mart, date_col, unfiltered, plain)
            missing = {m.name for m in plain if m.optional_col and m.optional_col not in df.columns}
            parts.append(df.groupBy(*by).agg(*[F.lit(None).cast("bigint").alias(m.name) if m.name in missing else m.expr(ctx).alias(m.name) for m in plain]))
        for col in dict.fromkeys(m.share[0] for m in shared):                       # rows of their own: only the joins these need
            own = [m for m in shared if m.share[0] == col]
            found = exact_percentiles(rows(mart, date_col, unfiltered, own), by, col, {m.name: m.share[1] for m in own})
            parts.append(found if by else found.agg(*[F.max(m.name).alias(m.name) for m in own]))
    for n in todo:
        m = MEASURES[n]
        if m.kind != "table":
            continue
        df = model.mart(m.mart, needs=ctx_cols | links(m.mart) | set(m.needs))
        if not (m.unfiltered or n in ignore):
            df = apply_filters(model, m.mart, df, ctx.filters, roles)
        if m.unfiltered:
            res = m.table(df, [], ctx)
            parts.append(res)               # one row, broadcast to every group below
            continue
        parts.append(m.table(_time_keys(with_dimensions(model, m.mart, df, dimensions, roles), by, m.date_col), by, ctx))
    out = None
    for p in parts:
        if out is None:
            out = p
        elif not by or not set(by) <= set(p.columns):
            out = out.crossJoin(F.broadcast(p))
        else:
            # null-safe keys: a NULL group of one part is the NULL group of the other
            other = p.select(*[F.col(c).alias(f"_r_{c}") if c in by else F.col(c) for c in p.columns])
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by])
            out = out.join(other, same, "full_outer").select(
                *[F.coalesce(c, f"_r_{c}").alias(c) for c in by],
                *[c for c in out.columns if c not in by], *[c for c in p.columns if c not in by])
    for n in todo:
        m = MEASURES[n]
        if m.kind == "post":
            out = out.withColumn(n, m.post(ctx))
    return out.select(*by, *names)
