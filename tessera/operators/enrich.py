"""Look-ups and 1:1 joins whose keys are checked on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Of rows that repeat a key the least by the other columns; rows without a key are gone.  Grouped by the key, so a
    join on it needs no further exchange."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.where(F.col(key).isNotNull()).select(key).distinct()
    least = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_least"))
    return least.select(key, *[F.col(f"_least.{c}").alias(c) for c in rest])


def join_one_to_one(left: DataFrame, right: DataFrame, key: str, prefix: str = "r_") -> DataFrame:
    """Every left row with the columns of its right row, and what the key's two sides hold.

    Both sides meet in one exchange on the key, where they are counted and joined: ``left_rows`` and ``right_rows`` of
    the key, and ``match``: ok, left_only, right_only, left_repeats, right_repeats or both_repeat.  Of right rows that
    repeat a key the least by their columns is joined, so left rows keep their number; a key that only the right side
    has gives one row.  Rows without a key match nothing.  Right columns carry ``prefix``.
    """
    lefts, rights = [c for c in left.columns if c != key], [c for c in right.columns if c != key]
    l_type, r_type = (left.select(F.struct(*lefts)).schema[0].dataType, right.select(F.struct(*rights)).schema[0].dataType)
    # a null key is a key of its own for each row, so that no group gathers them
    alone = lambda df, side: F.when(F.col(key).isNull(), F.xxhash64(F.lit(side), *df.columns))
    both = (left.select(key, alone(left, 0).alias("_alone"), F.struct(*lefts).alias("_l"), F.lit(None).cast(r_type).alias("_r"), F.lit(0).alias("_side"))
            .unionByName(right.select(key, alone(right, 1).alias("_alone"), F.lit(None).cast(l_type).alias("_l"), F.struct(*rights).alias("_r"), F.lit(1).alias("_side"))))
    group = Window.partitionBy(key, "_alone")
    n = both.withColumn("left_rows", F.sum(1 - F.col("_side")).over(group)).withColumn("right_rows", F.sum("_side").over(group))
    n = n.withColumn("_least", F.min("_r").over(group)).withColumn("_nth", F.row_number().over(group.orderBy("_side", "_r")))
    kept = n.where((F.col("_side") == 0) | ((F.col("left_rows") == 0) & (F.col("_nth") == 1)))
    match = (F.when(F.col("right_rows") == 0, "left_only").when(F.col("left_rows") == 0, "right_only")
             .when((F.col("left_rows") > 1) & (F.col("right_rows") > 1), "both_repeat").when(F.col("left_rows") > 1, "left_repeats")
             .when(F.col("right_rows") > 1, "right_repeats").otherwise("ok"))
    return kept.select(key, *[F.col(f"_l.{c}").alias(c) for c in lefts], *[F.col(f"_least.{c}").alias(prefix + c) for c in rights],
                       F.col("left_rows").cast("bigint").alias("left_rows"), F.col("right_rows").cast("bigint").alias("right_rows"), match.alias("match"))
