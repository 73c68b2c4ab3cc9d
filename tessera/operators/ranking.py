"""Ranking, top-k and share-of-total without single-partition windows.

A window ``rank() OVER (ORDER BY v DESC)`` with no PARTITION BY moves every
row to one task.  ``rank_desc`` instead builds the histogram of distinct
values (usually tiny: counts and minutes take few distinct values), ranks
the histogram, and joins the rank back on the value:
rank(v) = 1 + number of rows with a larger value (SQL RANK semantics).
``with_global`` attaches one-row global aggregates (mean, max, total) by a
broadcast cross join - the one-row bound is structural.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

T = F.col


def rank_desc(df: DataFrame, value: str, out: str = "rank", by: list | tuple = ()) -> DataFrame:
    hist = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*by).orderBy(T(value).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.select(*by, value, (F.coalesce(F.sum("_cnt").over(w), F.lit(0)) + 1).alias(out))
    return df.join(ranked, [*by, value], "left")


def reuse(df: DataFrame) -> DataFrame:
    """Materialise a small, expensive intermediate that feeds several
    branches (rank join-back, global stats).  Column pruning makes the
    branches' plans differ, so Spark would recompute it per branch; a
    reliable checkpoint in the session's shared checkpoint folder computes
    it once and survives executor loss."""
    from tessera.session import cut_lineage
    return cut_lineage(df)


def with_global(df: DataFrame, **aggs: Column) -> DataFrame:
    """Attach one-row aggregates over ``df`` to every row (broadcast)."""
    one = df.agg(*[c.alias(n) for n, c in aggs.items()])
    return df.crossJoin(F.broadcast(one))


def top_k(df: DataFrame, k: int, order: list) -> DataFrame:
    """Top-k report rows (the limit is the feature).  ``orderBy().limit()``
    plans as TakeOrderedAndProject: a per-partition top-k and a k-row merge,
    no full sort."""
    return df.orderBy(*order).limit(k)
