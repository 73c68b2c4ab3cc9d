"""Exact percentiles without a buffer of all values.

``percentile`` keeps a group's distinct values and their counts in one
aggregation buffer, so one task holds them all.  Here the value histogram is
an ordinary grouped count.  Its values fall into intervals of a hundredth part
(``interval``: some thousands from the least double to the greatest); the
intervals' counts are run up, which tells in which interval each rank lies, and
only the values of these are run up one by one.  A task sees a group's interval
counts or the distinct values of one interval; a hot group is spread like any
other.  The histogram is read twice and shuffled once (the exchange is reused).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

T = F.col
STEPS = 64                                                                          # intervals of a doubling


def interval(value: Column) -> Column:
    """The number of a value's interval, in the order of values: equal steps of the logarithm either side of zero."""
    return (F.signum(value) * F.floor(F.log2(F.abs(value) + 1) * STEPS)).cast("int")


def exact_percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float], place: Column | None = None) -> DataFrame:
    """One row for each group of ``by`` that has values: a column for each name of ``shares``, interpolated linearly
    between ranks as ``percentile`` does.  NULL values do not count; NULL keys are groups; no rows: no groups.

    ``place`` may give another integer column that rises with the value, where values lie close together far from zero.
    """
    group = F.struct(*[T(c) for c in by]) if by else F.struct(F.lit(0).alias("_all"))
    spot = (interval(T(value).cast("double")) if place is None else place).alias("_at")
    hist = df.where(T(value).isNotNull()).groupBy(group.alias("_g"), spot, T(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_g")
    run = (hist.groupBy("_g", "_at").agg(F.sum("_n").alias("_in")).withColumn("_through", F.sum("_in").over(whole.orderBy("_at")))
           .withColumn("_total", F.sum("_in").over(whole)))
    places = {n: (T("_total") - 1) * F.lit(float(p)) for n, p in shares.items()}
    ranks = F.array_distinct(F.array(*[f(p).cast("bigint") for p in places.values() for f in (F.floor, F.ceil)]))
    sought = run.select("_g", "_at", (T("_through") - T("_in")).alias("_before"), "_through", "_total", F.explode(ranks).alias("_rank")).where(
        (T("_rank") >= T("_before")) & (T("_rank") < T("_through"))).drop("_through")
    values = hist.join(sought, ["_g", "_at"]).withColumn(
        "_upto", T("_before") + F.sum("_n").over(Window.partitionBy("_g", "_at", "_rank").orderBy("_v")))
    found = values.where((T("_rank") < T("_upto")) & (T("_rank") >= T("_upto") - T("_n")))

    def at(p: Column) -> Column:
        low, high = (F.max(F.when(T("_rank") == f(p), T("_v"))) for f in (F.floor, F.ceil))
        above = F.max(p - F.floor(p))
        return F.when(above == 0, low).otherwise((1 - above) * low + above * high)

    out = found.groupBy("_g").agg(*[at(p).alias(n) for n, p in places.items()])
    return out.select(*[T(f"_g.{c}").alias(c) for c in by], *shares)
