"""Percentiles by search, the stacked quality report and the table of light rules against plain computations."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.percentile import exact_percentiles, interval
from tessera.plans import pages, quality
from tessera.plans.model import Model
from tessera.plans.measures import evaluate
from tessera.sources.adapter import AS_OF
from tests.test_scope_and_snapshots import Altered


def test_percentiles_equal_plain_ones(spark):
    rng = np.random.default_rng(0)
    rows = [("hot", int(v)) for v in rng.integers(-10 ** 6, 10 ** 9, 3000)] + [("one", 5)] + [("same", 7)] * 50 + [(None, int(v)) for v in rng.integers(0, 9, 40)]
    rows += [("wide", v) for v in (-2 ** 50, -1, 0, 1, 2 ** 50)] + [("empty", None), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, v bigint").repartition(7)
    shares = {"a": 0.0, "b": 0.5, "c": 0.9, "d": 1.0, "e": 0.123}
    want = df.where("v is not null").groupBy("k").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in shares.items()])
    got = exact_percentiles(df, ["k"], "v", shares)
    close = lambda a, b: a[0] == b[0] and np.allclose(a[1:], b[1:], rtol=1e-12)
    pairs = zip(sorted(map(tuple, got.collect()), key=repr), sorted(map(tuple, want.collect()), key=repr), strict=True)
    assert all(close(a, b) for a, b in pairs)
    assert exact_percentiles(df, [], "v", {"m": 0.5}).first()[0] == df.agg(F.percentile("v", F.lit(0.5))).first()[0]
    assert exact_percentiles(df.limit(0), [], "v", {"m": 0.5}).count() == 0
    near = spark.range(1000).select((F.lit(1.7e9) + F.col("id") / 1000).alias("x"))
    assert exact_percentiles(near, [], "x", {"m": 0.25}, place=F.floor("x").cast("int")).first()[0] == pytest.approx(near.agg(F.percentile("x", F.lit(0.25))).first()[0])


def test_intervals_rise_with_values(spark):
    v = sorted([0.0, -0.0, 1e-9, -1e-9, 1.0, -1.0, 1e300, -1e300, *np.random.default_rng(1).normal(size=200).tolist()])
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(v)], "k int, x double").orderBy("k").select(interval(F.col("x"))).collect()]
    assert got == sorted(got)


def test_no_task_holds_all_values(spark, driver_src):
    m = Model(driver_src, AS_OF)
    plan = evaluate(m, ["median_resolution_min", "p90_resolution_min"], by=["entity_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan


def test_quality_report_counts_every_kind_of_break(spark, driver_src):
    s = driver_src
    broken = Altered(
        s, computers=s["computers"].withColumn("entities_id", F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") % 4 == 1, 999_999).otherwise(F.col("entities_id"))),
        items_racks=s["items_racks"].withColumn("racks_id", F.lit(10 ** 9).cast("bigint")), phones=s["phones"].drop("entities_id"),
        tickets_users=s["tickets_users"].where("type != 1"), tickets=s["tickets"].withColumn("entities_id", F.lit(0).cast("bigint")))
    got = {(r["rule"], r["table"]): (r["severity"], r["violations"]) for r in quality.integrity_report(broken).collect()}
    n = broken["computers"].where("id % 4 in (0, 1)").count()
    assert n and got["Q1_entity_orphan", "computers"] == ("error", n) and got["Q1_entity_orphan", "phones"] == ("skip", None)
    tickets = s["tickets"].count()
    assert got["Q2_ticket_without_requester", "tickets"] == got["Q2_ticket_entity_zero_or_unknown", "tickets"] == ("error", tickets)
    assert got["Q3_rack_slot_unknown_rack", "items_racks"] == ("error", s["items_racks"].count())
    empty = quality.integrity_report(Altered(s, **{t: s[t].limit(0) for t in (*quality.ENTITY_TABLES, "entities", "items_racks", "tickets_users",
                                                                           "items_softwareversions", "items_operatingsystems")}))
    assert {r["violations"] for r in empty.where("severity = 'error'").collect()} == {0}
    assert empty.where("severity = 'warning'").first()["violations"] == quality.EXPECTED_ENTITIES


def test_quality_report_shuffles_little(spark, driver_src):
    df = quality.integrity_report(driver_src)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 12


def test_light_rules_are_data(spark):
    v = [("sla_pct", 90.0), ("sla_pct", 89.9), ("sla_pct", 79.99), ("mttr_hours", 24.0), ("mttr_hours", 24.5), ("mttr_hours", 48.1), ("license_use_pct", 100.0),
         ("license_use_pct", 100.1), ("license_use_pct", 30.0), ("license_use_pct", 29.0), ("tickets_per_mean", 2.0), ("tickets_per_mean", 2.01), ("sla_pct", None), ("unknown", 1.0)]
    df = spark.createDataFrame(v, "indicator string, value double")
    got = {(r["indicator"], r["value"]): r["color"] for r in pages.colored(df, pages.light_rules(spark)).collect()}
    assert [got[k] for k in v] == ["green", "yellow", "red", "green", "yellow", "red", "green", "yellow", "yellow", "red", "yellow", "red", None, None]
    own = pages.colored(df, pages.light_rules(spark, [("sla_pct", None, 100.0, "red")]))
    assert {r["color"] for r in own.where("indicator = 'sla_pct' and value is not null").collect()} == {"red"}
