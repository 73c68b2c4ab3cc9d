"""Mixing sources to target weights by hash thresholds (operator 12).

Every source gets a target, a share of all words by its weight that never tops a multiple of its own words.  A source
takes each document as many whole times as the target holds the source, and once more the documents whose hash lies
below the source's threshold.  The threshold comes from nested histograms: words by source and the first bits of the
hash; only the bucket in which the budget ends is split again by the next bits, until one hash is left.  Nothing is
sorted but the at most 2 ** LEVEL_BITS sums of a source.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, scratch, shuffle_width, table

WEIGHTS, MOST = (5, 2, 1), 3
HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    """Number of runs other than ASCII white space; null counts as empty.  No array of words is made."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]++", "x")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of an MD5 over id and text: rows alike in both share it."""
    name = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def in_order(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` with place, the number from 0 by code point with null last: ranges, and a count of the ranges before."""
    ranged = scratch(keys.repartitionByRange(shuffle_width(keys.sparkSession), F.col(key).asc_nulls_last())
                     .withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)     # a row per range, whatever the keys
    counts = ranged.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("range").orderBy(F.col(key).asc_nulls_last())
    return ranged.join(counts, "range").withColumn("place", F.col("before") + F.row_number().over(own) - 1).drop("range", "before")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, size) to (source, source_size, target): all words shared by weight, none above ``most`` times its source.

    What is above goes to the other sources by weight until nothing is; a round sends one row to the driver.
    """
    every = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    given = F.array(*[F.lit(int(w)) for w in weights])
    found = scratch(in_order(every, "source").withColumn(
        "weight", F.element_at(given, (F.col("place") % len(weights) + 1).cast("int")).cast("long")), "sources")
    whole = lambda c: c.cast("decimal(19,0)")
    total, weight = found.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left = total
    while True:
        above = whole(F.col("weight")) * whole(F.lit(left)) > whole(F.col("source_size") * most) * whole(F.lit(weight))
        full, rest = found.agg(F.coalesce(F.sum(F.when(above, F.col("source_size") * most)), F.lit(0)),
                               F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if (total - full, rest) == (left, weight):
            break
        left, weight = total - full, rest
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(max(weight, 1)))
    return found.select("source", "source_size", F.when(above, (F.col("source_size") * most).cast("double")).otherwise(share).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, hash, size) and (source, rest) to (source, below): hashes under ``below`` hold about ``rest`` words.

    The hash at which the budget ends is taken if that comes nearer to it.  One pass over all rows, and one over the
    rows of the boundary buckets for each further level.
    """
    inside, edges = rows, budgets.select(F.col("source").alias("of"), "rest")
    ended = None
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        place = F.shiftright("hash", HASH_BITS - LEVEL_BITS * level)
        sums = inside.groupBy("source", place.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("least"), F.max("hash").alias("last"))
        run = sums.withColumn("through", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")))
        over = run.join(edges, F.col("source").eqNullSafe(F.col("of"))).where(F.col("through") > F.col("rest"))
        first = over.groupBy("source").agg(F.min(F.struct("bucket", "words", "least", "last", (F.col("rest") - (F.col("through") - F.col("words")))
                                                          .alias("rest"))).alias("e")).select(F.col("source").alias("of"), "e.*")
        first = scratch(first, f"edges{level}")
        single = first.where(F.col("least") == F.col("last")).select(
            "of", (F.col("least") + F.when(F.col("words") - F.col("rest") < F.col("rest"), 1).otherwise(0)).alias("below"))
        ended = single if ended is None else ended.unionByName(single)
        edges = first.where(F.col("least") < F.col("last")).select("of", "bucket", "rest")
        if edges.isEmpty():
            break
        inside = scratch(inside.join(edges, F.col("source").eqNullSafe(F.col("of")) & (place == F.col("bucket")), "left_semi"), f"boundary{level}")
        edges = edges.select("of", "rest")
    return budgets.join(ended, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", F.coalesce("below", F.lit(1 << HASH_BITS)).alias("below"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(id, source, text) to (id, source, size, source_size, target, times, taken): how often the mix takes each document.

    Sources by code point, null last, weigh ``weights`` in turn.  ``times`` is at most ``most``; a source's taken words
    miss its target by half of one document at most.  The choice hangs on id and text alone, so reruns agree and rows
    alike in both share their fate.  Null and empty texts have size 0; a source of no words has target 0; no words at
    all: every target is 0.  Null ids are ids like others.  An empty table gives no rows.
    """
    rows = scratch(docs.select("id", "source", word_count(F.col("text")).alias("size"), row_hash(F.col("id"), F.col("text")).alias("hash")), "sizes")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = scratch(targets(rows, weights, most).withColumn("whole", whole), "targets")
    limits = thresholds(rows.select("source", "hash", "size"), plan.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest")))
    known = plan.join(limits.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumnRenamed("source", "of")
    times = F.col("whole") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    return rows.join(known, F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "source", "size", "source_size", "target", times.alias("times"), (F.col("size") * times).alias("taken"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: doc_id, size, source_size, target, taken, source.

    Null ids, texts and sources, repeated rows and empty tables as in ``mix``; a very long text is read once and costs
    its own length.
    """
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "source", "text"), id="doc_id", source="source", text="text")
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
      FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER k AS place, sum(source_size) OVER () - 3 * (sum(source_size) OVER k - source_size) AS spare,
             sum(w) OVER () - sum(w) OVER k + w AS weights
      FROM s WINDOW k AS (ORDER BY source_size * (10 // w), source NULLS LAST ROWS UNBOUNDED PRECEDING)),
e AS (SELECT spare, weights FROM o WHERE w * spare <= 3 * source_size * weights ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN w * e.spare > 3 * source_size * e.weights THEN CAST(3 * source_size AS DOUBLE)
             ELSE CAST(w * e.spare AS DOUBLE) / CAST(e.weights AS DOUBLE) END AS target FROM o, e),
u AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM t),
g AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
c AS (SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h) AS through FROM g),
p AS (SELECT c.source, c.h, through <= target - times * source_size
             OR (through - words <= target - times * source_size
                 AND through - (target - times * source_size) < (target - times * source_size) - (through - words)) AS more
      FROM c JOIN u ON c.source IS NOT DISTINCT FROM u.source)
SELECT d.doc_id, d.size, u.source_size, u.target, CAST(d.size * (u.times + CASE WHEN p.more THEN 1 ELSE 0 END) AS BIGINT) AS taken, d.source
FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.h = p.h
"""
