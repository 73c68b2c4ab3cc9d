"""Streaming equals batch (T1), late rows are dropped, incremental refresh
(S6), deploy/verify jobs (S2/S3) and the refresh error budget."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from tessera.plans.jobs import deploy
from tessera.plans.marts_entity import build_vw_entity_sla_monthly
from tessera.plans.marts_finance import build_vw_fact_satisfaction_summary
from tessera.plans.marts_tickets import build_vw_sla_monthly, build_vw_tech_productivity, build_vw_volume_trend
from tessera.sources.adapter import AS_OF
from tessera.streaming import refresh as R
from tessera.streaming import volume as V
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _write_event_files(spark, root, parts):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for i, (lo, hi) in enumerate(parts):
        (ev.where((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1)
           .write.parquet(os.path.join(root, f"part{i:02d}")))
    return ev


def test_stream_equals_batch_for_closed_windows(spark):
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    src_dir = os.path.join(root, "in")
    bounds = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01"]
    ev = _write_event_files(spark, src_dir, list(zip(bounds, bounds[1:])))
    # file source reads one folder level: move parts under one directory glob
    q = V.start_stream(spark, os.path.join(src_dir, "part*"), "memory", os.path.join(root, "ckpt"),
                       watermark="1 hour", query_name="ev_volume_test")
    q.awaitTermination()
    got = spark.table("ev_volume_test")
    max_ts = ev.agg(F.max("ts")).collect()[0][0]
    batch = V.volume(ev).where(F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 1 HOUR"))
    assert got.count() > 0
    assert _rows(got.where(F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 1 HOUR"))) == _rows(batch)


def test_late_rows_are_dropped(spark):
    """Files are consumed oldest-first, one per micro-batch: recent files
    move the watermark, the old file that arrives after it is dropped."""
    root = tempfile.mkdtemp(prefix="tessera-late-")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # late rows are filtered against the watermark of the previous batch,
    # so the old file comes two micro-batches after the watermark moved
    ev.where(F.col("ts").between("2024-01-20", "2024-01-25")).coalesce(1).write.parquet(os.path.join(root, "in", "a"))
    time.sleep(1.1)
    ev.where(F.col("ts") > "2024-01-25").coalesce(1).write.parquet(os.path.join(root, "in", "b"))
    time.sleep(1.1)
    ev.where(F.col("ts") < "2024-01-05").coalesce(1).write.parquet(os.path.join(root, "in", "c"))
    q = V.start_stream(spark, os.path.join(root, "in", "*"), "memory", os.path.join(root, "ckpt"),
                       watermark="1 hour", query_name="late_test", max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.table("late_test")
    assert got.where(F.col("window_start") >= "2024-01-20").count() > 0
    assert got.where(F.col("window_start") < "2024-01-05").count() == 0


def test_incremental_refresh_matches_full_rebuild(spark, driver_src):
    root = tempfile.mkdtemp(prefix="tessera-refresh-")
    new_dir, out, ckpt = (os.path.join(root, d) for d in ("new", "out", "ckpt"))
    tickets = driver_src["tickets"]
    batch = tickets.where(F.date_format("date", "yyyy-MM").isin("1996-03", "1999-11"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tickets.schema.fields)
    batch.write.parquet(new_dir)
    R.refresh_once(spark, new_dir, schema, driver_src, out, ckpt, AS_OF)
    months = ("1996-03", "1999-11")
    got = spark.read.parquet(os.path.join(out, "vw_volume_trend"))
    full = build_vw_volume_trend(driver_src, AS_OF).where(F.col("year_month").isin(*months))
    cols = ["year_month", "tickets_created", "tickets_resolved", "avg_resolution_min"]
    assert _rows(got.select(*cols)) == _rows(full.select(*cols))
    got = spark.read.parquet(os.path.join(out, "vw_sla_monthly"))
    full = build_vw_sla_monthly(driver_src, AS_OF).where(F.col("year_month").isin(*months))
    cols = ["year_month", "group_name", "priority_label", "total_tickets", "within_sla", "sla_compliance_pct"]
    assert got.count() > 0 and _rows(got.select(*cols)) == _rows(full.select(*cols))
    for name, builder in (("vw_tech_productivity", build_vw_tech_productivity),
                          ("vw_entity_sla_monthly", build_vw_entity_sla_monthly)):
        got = spark.read.parquet(os.path.join(out, name))
        full = builder(driver_src, AS_OF).where(F.col("year_month").isin(*months))
        assert got.count() > 0 and _rows(got.select(*full.columns)) == _rows(full)
    got = spark.read.parquet(os.path.join(out, "vw_fact_satisfaction_summary"))
    full = build_vw_fact_satisfaction_summary(driver_src, AS_OF)
    kept = full.join(got.select("year_month").distinct(), "year_month", "left_semi")
    assert got.count() > 0 and _rows(got.select(*full.columns)) == _rows(kept.select(*full.columns))


def test_refresh_lists_files_anew(spark, driver_src):
    root = tempfile.mkdtemp(prefix="tessera-refresh-")
    new_dir, out, ckpt, store = (os.path.join(root, d) for d in ("new", "out", "ckpt", "store"))
    tickets = driver_src["tickets"].where(F.date_format("date", "yyyy-MM") == "1999-11")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tickets.schema.fields)
    tickets.where("id % 2 = 0").write.parquet(store)

    class Fresh(dict):
        def __missing__(self, name):
            return spark.read.parquet(store) if name == "tickets" else driver_src[name]

    def total():
        return spark.read.parquet(os.path.join(out, "vw_volume_trend")).agg(F.sum("tickets_created")).first()[0]

    spark.read.parquet(store).write.parquet(os.path.join(new_dir))
    R.refresh_once(spark, new_dir, schema, Fresh, out, ckpt, AS_OF)
    live = tickets.where("is_deleted = 0")
    assert total() == live.where("id % 2 = 0").count()
    late = tickets.where("id % 2 = 1")
    late.write.mode("append").parquet(store)
    late.write.mode("append").parquet(new_dir)
    R.refresh_once(spark, new_dir, schema, Fresh, out, ckpt, AS_OF)
    assert total() == live.count()


def test_refresh_loop_error_budget():
    calls = []

    def boom():
        calls.append(1)
        raise RuntimeError("down")

    tally = R.refresh_loop(boom, interval_s=0, max_failures=5, max_cycles=20, sleep=lambda s: None)
    assert tally["stopped_on_failures"] and tally["failed"] == 5 and len(calls) == 5


def test_deploy_dry_run_all_ok(driver_src):
    rep = {r.mart: r.status for r in deploy(driver_src, AS_OF, dry_run=True).collect()}
    assert len(rep) == 34 and set(rep.values()) == {"ok"}
    only = deploy(driver_src, AS_OF, dry_run=True, only="entity").collect()
    assert len(only) == 6


def test_live_views_answer_sql(spark, driver_src):
    from tessera.plans.jobs import register_views
    names = register_views(driver_src, AS_OF, only="star")
    assert "vw_sla_monthly" in names
    n = spark.sql("SELECT sum(total_tickets) AS n FROM vw_sla_monthly").collect()[0].n
    assert n == driver_src["tickets"].where("is_deleted = 0").count()


def test_materialised_sources_roundtrip(spark, driver_src):
    from tessera.sources.io import load_sources, write_sources
    root = tempfile.mkdtemp(prefix="tessera-src-")
    tables = ["tickets", "groups_tickets", "groups"]
    write_sources(driver_src, root, tables)
    loaded = load_sources(spark, root)
    got = _rows(build_vw_volume_trend(loaded, AS_OF))
    assert got == _rows(build_vw_volume_trend(driver_src, AS_OF))
