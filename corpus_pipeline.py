"""Corpus pipeline: language ID, near duplicates, benchmark decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.  Rows with a null id or text are handled as the
operators define; an empty table passes through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, langid, ngram_join, secrets
from tessera.llm.common import columns, scratch, table
from tessera.session import ensure_checkpoint_dir

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
#: Language ID rejects texts without a letter and those whose best language is no further above chance, which depends on
#: the number of languages, than this part of the way to certainty.  One language alone rejects nothing else.
OVER_CHANCE = 2 / 15
#: keys of documents to be dropped that are sent to every task (some 64 MB); more of them are joined
SENT_ROWS = 1_000_000


#: bytes of text in a block of the token stage: its workers live beside what the stages before have left on an executor
TOKEN_BLOCK_BYTES = 4 << 20
#: bytes of rows that Spark and a Python worker hold of a batch at a time
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches between Spark and its Python workers stay small, unless the session asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    told = spark.conf.get(key).lower().rstrip("b")
    if not told.isdigit() or int(told) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def _body(docs: DataFrame) -> DataFrame:
    return columns(docs, id="doc_id", text="text")


def least_language(n: int) -> float:
    """The least pooled probability that is kept with ``n`` languages: 0.35 with four."""
    return 1 / n + OVER_CHANCE * (1 - 1 / n) if n > 1 else 0.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; ``lang`` becomes the predicted one where it was null.

    The model is fitted on this stage's own input.  Where no language can be learned, nothing can be rejected for a
    low score; texts without a letter still go.
    """
    small_batches(spark)
    text = columns(docs, id="doc_id", text="text", lang="lang")
    model = langid.fit(langid.training_rows(text))
    found = langid.predict(docs.select(*DOCUMENTS), model)
    keep = F.col("lang_pred") != langid.NONE if model is not None else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    least = 0.0 if model is None else least_language(len(model.langs))
    return found.where(keep & (F.col("score") >= least)).withColumn(
        "lang", F.coalesce("lang", F.when(F.col("lang_pred") != langid.NONE, F.col("lang_pred")))).select(*DOCUMENTS)


def without(docs: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``docs`` but for the keys in ``gone``, whose size is counted: up to ``SENT_ROWS`` they are sent to the documents,
    beyond that both sides meet by key."""
    return docs.join(F.broadcast(gone) if gone.count() <= SENT_ROWS else gone, keys, "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group linked by 5-word shingles at a similarity of 0.8 the row with the smallest id.

    A row is known by its id and its text's digest: rows that share an id with a linked row, but are not linked
    themselves, stay.  Of a group's rows that share the smallest id the first by text, then by the other columns,
    stays.  Documents without words and rows without an id are groups of their own.
    """
    small_batches(spark)
    groups = ngram_join.ngram_join(_body(docs), size=5, percent=80, digests=True)
    linked = scratch(groups.where((F.col("links") > 0) & F.col("id").isNotNull()).groupBy(F.col("id").alias("doc_id"), "digest")
                     .agg(F.min("root").alias("root"), F.min("component").alias("component"), F.count("*").alias("rows")), "fate")
    alike = (linked.where(F.col("component") == F.col("doc_id")).groupBy("root").agg(F.sum("rows").alias("heads"))
             .where(F.col("heads") > 1).select("root", "heads"))
    fate = scratch(linked.join(alike, "root", "left").select(
        "doc_id", "digest", "root", (F.col("component") == F.col("doc_id")).alias("head"), F.col("heads").isNotNull().alias("more")), "fates")
    gone = fate.where("not head or more")
    told = docs.select(*DOCUMENTS, F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("digest"))
    alone = without(told, gone.select("doc_id", "digest"), ["doc_id", "digest"]).select(*DOCUMENTS)
    several = gone.where("head and more").select("doc_id", "digest", "root")        # heads that share an id: few, if any
    if several.isEmpty():
        return alone
    first = told.join(several, ["doc_id", "digest"]).groupBy("root").agg(F.min(F.struct(*DOCUMENTS)).alias("r"))
    return alone.unionByName(first.select("r.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which 5 % of the words or more stand in passages of the benchmark.

    Rows that share an id go together; rows without an id cannot be named and stay.
    """
    small_batches(spark)
    items = columns(table(spark, sf_dir, "benchmark", "item_id", "text"), item="item_id", text="text")
    found = decontaminate.digest(decontaminate.find_benchmark(_body(docs), items.withColumn("item", F.col("item").cast("string"))))
    gone = scratch(found.where("contaminated").select("doc_id").distinct(), "contaminated")
    return without(docs.select(*DOCUMENTS), gone, ["doc_id"]).select(*DOCUMENTS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays, with its length in characters anew."""
    scanner = secrets.fit(_body(docs))
    clean = secrets.redacted(scanner.scan(docs.select(*DOCUMENTS)))
    return clean.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*DOCUMENTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit integers) and whether they decode to as many pieces."""
    small_batches(spark)
    done = bpe.encode_decode(_body(docs), block_bytes=TOKEN_BLOCK_BYTES)
    pieces = F.when(F.octet_length("ids") == 0, F.lit(0)).otherwise(F.size(F.split("decoded", " ")))
    return done.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       (pieces == F.octet_length("ids") / 4).alias("round_trip"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secret_scan), ("tokens", tokens)]

#: The stages hold trained models and components of links: SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-llm/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{base}/{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
