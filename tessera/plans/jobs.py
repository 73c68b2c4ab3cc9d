"""Catalogue jobs S2-S4: deploy marts in dependency order, verify row
counts, profile the sources.

``deploy`` mirrors the published deploy script: whole set or one group
(``only``), plan-only (``dry_run``: analysis and planning, no action), and a
per-mart ok/error tally that continues after a failure.  The report is a
small DataFrame built from the per-mart outcomes (metadata, not data).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.catalog import MARTS
from tessera.sources.contracts import CONTRACT_TABLES
from tessera.sources.io import PARTITION_COLUMNS, write_mart
from tessera.sources.snapshots import Snapshots


def deploy(src, as_of: datetime, out_path: str | None = None, only: str | None = None,
           dry_run: bool = False, store: Snapshots | None = None) -> DataFrame:
    """With ``store`` the marts are written as one new version: readers see all
    of them change at once, and a mart that fails stays as it was before."""
    spark = src["tickets"].sparkSession
    draft = store.begin() if store is not None and not dry_run else None
    rows = []
    for name, builder, group in MARTS:
        if only and group != only and name != only:
            continue
        try:
            df = builder(src, as_of)
            if draft is not None:
                draft.replace(name, df, PARTITION_COLUMNS.get(name))
            elif dry_run or out_path is None:
                df.schema  # resolve + analyse the plan, no job
                if not dry_run:
                    df.createOrReplaceTempView(name)
            else:
                write_mart(df, out_path, name)
            rows.append((name, group, "ok", None))
        except Exception as e:  # noqa: BLE001 - tally and continue, as published
            rows.append((name, group, "error", str(e)[:500]))
    if draft is not None and any(r[2] == "ok" for r in rows):
        draft.commit(as_of=as_of.isoformat())
    return spark.createDataFrame(rows, "mart string, group string, status string, error string")


def register_views(src, as_of: datetime, only: str | None = None) -> list[str]:
    """S5 live mode: every mart as a temporary view, so ``spark.sql`` can
    query it by its published name (plans stay lazy, always fresh)."""
    names = []
    for name, builder, group in MARTS:
        if only and group != only and name != only:
            continue
        builder(src, as_of).createOrReplaceTempView(name)
        names.append(name)
    return names


def verify(src, as_of: datetime) -> DataFrame:
    """S3: row count of every mart, one row per mart (one count job each,
    combined by union; each count is a partial+final aggregate).  A source that
    derives its tickets makes them once for all marts."""
    src = src.tickets_once() if hasattr(src, "tickets_once") else src
    out = None
    for name, builder, _ in MARTS:
        c = builder(src, as_of).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("mart"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def profile_tables(src, as_of: datetime | None = None) -> DataFrame:
    """Per source contract - column count and row count."""
    out = None
    for name in CONTRACT_TABLES:
        df = src[name]
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.lit(len(df.columns)).alias("columns"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def profile_by_entity(src, as_of: datetime | None = None) -> DataFrame:
    """Rows of every contract that has an entity by entity, its share of the
    contract, and whether the entity exists.  Contracts are stacked and counted
    in one aggregate; totals come from the counts."""
    stacked = None
    for name in CONTRACT_TABLES:
        df = src[name]
        if name != "entities" and "entities_id" in df.columns:
            one = df.select(F.lit(name).alias("table"), F.col("entities_id").cast("bigint").alias("entity_id"))
            stacked = one if stacked is None else stacked.unionByName(one)
    counts = stacked.groupBy("table", "entity_id").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy(F.col("table").alias("_table")).agg(F.sum("rows").alias("_total"))
    e = src["entities"].select(F.col("id").alias("_eid"), F.col("name").alias("entity_name"))
    j = counts.join(totals, F.col("table") == F.col("_table")).join(e, F.col("entity_id") == F.col("_eid"), "left")
    return j.select("table", "entity_id", "entity_name", "rows", F.round(100.0 * F.col("rows") / F.col("_total"), 4).alias("pct_of_table"),
                    F.col("_eid").isNull().cast("int").alias("orphan"))


QUERIES = {
    "deploy_verify": verify,
    "profile_by_entity": profile_by_entity,
    "profile_tables": profile_tables,
}
