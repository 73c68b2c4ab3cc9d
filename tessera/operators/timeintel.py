"""Time intelligence (W1-W6) on a dense calendar spine.

Always aggregate to the period first (months, days), then window over the
small per-period series: the windows below never see raw fact rows, so a
global (unpartitioned) window over ~100s of periods is harmless even when
the facts are billions of rows.  With slice keys (``by``) the windows are
partitioned by them.

A dense spine matters: ``lag(1)`` must mean "previous calendar month", not
"previous month that had data".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

T = F.col


def month_spine(df: DataFrame, month_col: str = "year_month", by: list | tuple = ()) -> DataFrame:
    """All months between the global min and max of ``month_col`` ('yyyy-MM'),
    crossed with the distinct slices of ``by``."""
    lo_hi = df.agg(F.min(month_col).alias("_lo"), F.max(month_col).alias("_hi"))
    first = lambda c: F.to_date(F.concat(T(c), F.lit("-01")))
    months = lo_hi.select(F.explode(F.sequence(first("_lo"), first("_hi"), F.expr("INTERVAL 1 MONTH"))).alias("_m"))
    months = months.select(F.date_format("_m", "yyyy-MM").alias(month_col))
    if by:
        months = months.crossJoin(df.select(*by).distinct())
    return months


def on_spine(df: DataFrame, values: list[str], month_col: str = "year_month", by: list | tuple = (),
             fill: dict | None = None) -> DataFrame:
    """Left-join the series onto the dense spine; ``fill`` gives per-column
    defaults for empty periods (counts -> 0, ratios stay NULL).  A NULL slice
    is a slice of its own."""
    spine = month_spine(df, month_col, by)
    series = df.select(*[T(c).alias(f"_k_{c}") for c in (month_col, *by)], *values)
    same = T(month_col) == T(f"_k_{month_col}")
    for c in by:
        same = same & T(c).eqNullSafe(T(f"_k_{c}"))
    out = spine.join(series, same, "left").select(month_col, *by, *values)
    return out.fillna(fill) if fill else out


def _w(by, month_col):
    return Window.partitionBy(*by).orderBy(month_col)


def shift_period(value: str, months: int, by=(), month_col: str = "year_month") -> Column:
    """The value ``months`` periods earlier on the spine."""
    return F.lag(T(value), months).over(_w(by, month_col))


def moving_avg(value: str, n: int, by=(), month_col: str = "year_month") -> Column:
    """Trailing average over the last ``n`` periods (fewer at the start)."""
    return F.avg(T(value)).over(_w(by, month_col).rowsBetween(-(n - 1), 0))


def moving_std(value: str, n: int, by=(), month_col: str = "year_month") -> Column:
    """Population std-dev over the same trailing frame."""
    return F.stddev_pop(T(value)).over(_w(by, month_col).rowsBetween(-(n - 1), 0))


def delta(cur: Column, prev: Column) -> Column:
    """DAX subtraction, a missing previous value counts as 0."""
    return cur - F.coalesce(prev, F.lit(0))


def pct_change(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev, NULL when prev is 0 or missing."""
    return (cur - F.coalesce(prev, F.lit(0))).cast("double") / F.nullif(prev.cast("double"), F.lit(0.0))


def linear_projection(daily: DataFrame, value: str, date_col: str = "date", horizon_days: int = 30,
                      by: list | tuple = ()) -> DataFrame:
    """Least-squares line over the daily series, projected ``horizon_days``
    past the last day.  One aggregate per slice (regr_slope/intercept), then a
    ``sequence`` explode of the horizon - no per-row Python."""
    x = F.datediff(T(date_col), F.lit("1970-01-01").cast("date")).cast("double")
    fit = daily.groupBy(*by).agg(F.regr_slope(T(value).cast("double"), x).alias("_slope"),
                                 F.regr_intercept(T(value).cast("double"), x).alias("_icpt"),
                                 F.max(date_col).alias("_last"))
    days = fit.select(*by, "_slope", "_icpt",
                      F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon_days))).alias(date_col))
    xd = F.datediff(T(date_col), F.lit("1970-01-01").cast("date")).cast("double")
    return days.select(*by, date_col, (T("_icpt") + T("_slope") * xd).alias("projected_" + value))
