"""Refresh with retraction and versioned tables: moved, deleted and replayed changes equal a full build; a version is whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.plans import backfill, jobs
from tessera.plans.marts_entity import build_vw_entity_sla_monthly
from tessera.plans.marts_finance import build_vw_fact_satisfaction_summary
from tessera.plans.marts_tickets import build_vw_sla_monthly, build_vw_tech_productivity, build_vw_volume_trend
from tessera.sources.adapter import AS_OF
from tessera.sources.snapshots import Conflict, Snapshots
from tessera.streaming import incremental as I

BUILDERS = {"vw_volume_trend": build_vw_volume_trend, "vw_sla_monthly": build_vw_sla_monthly, "vw_tech_productivity": build_vw_tech_productivity,
            "vw_entity_sla_monthly": build_vw_entity_sla_monthly, "vw_fact_satisfaction_summary": build_vw_fact_satisfaction_summary}
DIMS = ("groups", "users", "groups_users", "entities")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def small(spark, driver_src, tmp_path_factory):
    """Tickets of four months with their links, and the dimensions, as files."""
    at = str(tmp_path_factory.mktemp("small"))
    t = driver_src["tickets"].where(F.date_format("date", "yyyy-MM").isin("1996-03", "1996-04", "1997-01", "1999-11"))
    t.write.parquet(f"{at}/tickets")
    ids = spark.read.parquet(f"{at}/tickets").select(F.col("id").alias("tickets_id"))
    for name in I.OWNERS:
        if name != "tickets":
            driver_src[name].join(ids, "tickets_id", "left_semi").select(*driver_src[name].columns).write.parquet(f"{at}/{name}")
    for name in DIMS:
        driver_src[name].write.parquet(f"{at}/{name}")
    return {name: spark.read.parquet(f"{at}/{name}") for name in (*I.OWNERS, *DIMS)}


class Overlaid(dict):
    """The stored ticket tables with the dimensions beside them."""

    def __init__(self, pin, small):
        super().__init__({**{k: small[k] for k in DIMS}, **{k: I.current(pin[k]) for k in I.OWNERS}})


def assert_equal_to_full_build(pin, small, names=tuple(BUILDERS)):
    src = Overlaid(pin, small)
    for name in names:
        want = BUILDERS[name](src, AS_OF)
        assert rows(pin[name].select(*want.columns)) == rows(want), name


def test_moves_deletions_and_replays(spark, small, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    lo, hi = small["tickets"].agg(F.min("id"), F.max("id")).first()
    names = ("vw_volume_trend", "vw_entity_sla_monthly", "vw_fact_satisfaction_summary")
    pin = I.start(store, small, max(1, (hi - lo) // 8), names)
    # every third ticket of a month goes to another month, another entity and another group; a whole month is deleted
    moved = small["tickets"].where("date_format(date, 'yyyy-MM') = '1996-03' and id % 3 = 0").withColumn(
        "date", F.col("date") + F.expr("INTERVAL 61 DAYS")).withColumn("entities_id", F.col("entities_id") + 1)
    links = moved.select(F.col("id").alias("tickets_id")).withColumn("groups_id", F.lit(1).cast("bigint")).withColumn("type", F.lit(2))
    gone = small["tickets"].where("date_format(date, 'yyyy-MM') = '1999-11'")
    batch = {"tickets": I.changes_of(moved, 5).unionByName(I.changes_of(gone, 5, gone=True)), "groups_tickets": I.changes_of(links, 5)}
    after = I.apply(store, batch, small, ("s", 0))
    assert_equal_to_full_build(after, small, names)
    assert "year_month=1999-11" in pin.tables["vw_volume_trend"]["parts"] and "year_month=1999-11" not in after.tables["vw_volume_trend"]["parts"]
    assert after["vw_volume_trend"].where("year_month = '1996-05'").count() == 1
    assert pin["vw_volume_trend"].where("year_month = '1999-11'").count() == 1                       # a pinned version stays as it was
    # a replayed batch is passed over; the same changes under a new number, and older ones, change nothing
    assert I.apply(store, batch, small, ("s", 0)).number == after.number
    again = I.apply(store, batch, small, ("s", 1))
    late = I.apply(store, {"tickets": I.changes_of(small["tickets"], 1)}, small, ("s", 2))
    for name in names:
        assert rows(again[name]) == rows(after[name]) == rows(late[name])


def test_a_batch_opens_its_own_partitions_only(spark, small, tmp_path, monkeypatch):
    store = Snapshots(spark, str(tmp_path / "store"))
    lo, hi = small["tickets"].agg(F.min("id"), F.max("id")).first()
    pin = I.start(store, small, max(1, (hi - lo) // 8), ("vw_sla_monthly",))
    one = small["tickets"].where("date_format(date, 'yyyy-MM') = '1996-03' and is_deleted = 0").orderBy("id").limit(1)
    seen = []
    frame = Snapshots._frame
    monkeypatch.setattr(Snapshots, "_frame", lambda self, name, table, parts: seen.append((name, len(parts), len(table["parts"]))) or frame(self, name, table, parts))
    after = I.apply(store, {"tickets": I.changes_of(one.withColumn("priority", F.col("priority") + 1), 9)}, small)
    assert all(n <= 1 for name, n, _ in seen if name in I.OWNERS or name.startswith(("counters", "vw_")))
    kept = [k for k in pin.tables["tickets"]["parts"] if after.tables["tickets"]["parts"].get(k) == pin.tables["tickets"]["parts"][k]]
    assert len(kept) == len(pin.tables["tickets"]["parts"]) - 1
    assert {k for k, v in after.tables["counters_sla"]["parts"].items() if v != pin.tables["counters_sla"]["parts"].get(k)} == {"year_month=1996-03"}
    assert after.tables["groups_tickets"] == pin.tables["groups_tickets"]                            # a table without changes is not written
    assert_equal_to_full_build(after, small, ("vw_sla_monthly",))


def test_a_batch_reads_its_changes_once(spark, small, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    I.start(store, small, 10_000_000, ("vw_volume_trend",))
    some = I.changes_of(small["tickets"].where("id % 50 = 1").withColumn("type", 3 - F.col("type")), 9)
    n, read = some.count(), spark.sparkContext.accumulator(0)
    told = spark.createDataFrame(some.rdd.map(lambda r: read.add(1) or r), some.schema)
    after = I.apply(store, {"tickets": told}, small)
    assert n > 0 and read.value == n and not [k for k in after.tables if k.startswith("change_")]
    assert_equal_to_full_build(after, small, ("vw_volume_trend",))


def test_followed_files_and_a_failed_batch(spark, small, tmp_path, monkeypatch):
    store, feed, mark = Snapshots(spark, str(tmp_path / "store")), str(tmp_path / "feed"), str(tmp_path / "mark")
    I.start(store, {**small, "tickets": small["tickets"].where("id % 2 = 0")}, 10_000, ("vw_volume_trend", "vw_sla_monthly", "vw_tech_productivity"))
    for name in I.OWNERS:
        I.changes_of(small[name].limit(0), 1).write.parquet(f"{feed}/{name}")
    I.changes_of(small["tickets"].where("id % 2 = 1"), 1).write.mode("append").parquet(f"{feed}/tickets")
    real = I.MARTS["vw_sla_monthly"]

    def broken(c, dims):
        raise RuntimeError("no mart today")

    monkeypatch.setitem(I.MARTS, "vw_sla_monthly", (real[0], broken))
    before = store.pin().number
    with pytest.raises(Exception, match="no mart today"):
        I.follow(spark, feed, store, small, mark)
    assert store.pin().number == before                                                              # the version before, whole
    monkeypatch.setitem(I.MARTS, "vw_sla_monthly", real)
    I.follow(spark, feed, store, lambda: small, mark)
    pin = store.pin()
    assert pin.number == before + 1
    assert_equal_to_full_build(pin, small, ("vw_volume_trend", "vw_sla_monthly", "vw_tech_productivity"))
    assert rows(pin["vw_volume_trend"].select(*build_vw_volume_trend(small, AS_OF).columns)) == rows(build_vw_volume_trend(small, AS_OF))
    # new names reach all months without a ticket read
    renamed = {**small, "groups": small["groups"].withColumn("name", F.concat(F.col("name"), F.lit("!")))}
    want = build_vw_sla_monthly({**renamed, **{k: I.current(pin[k]) for k in I.OWNERS}}, AS_OF)
    assert rows(I.dimensions_changed(store, renamed)["vw_sla_monthly"].select(*want.columns)) == rows(want)


def test_versions_conflict_pins_and_cleaning(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "v"))
    assert store.pin().number == 0 and "t" not in store.pin()
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    draft = store.begin()
    draft.replace("t", df, "k")
    draft.replace("u", df.limit(0))
    first = draft.commit(note="x")
    assert first["u"].schema == df.schema and first["u"].count() == 0 and first["t"].columns == ["id", "k"]
    a, b = store.begin(), store.begin()
    a.replace("t", df.where("id = 2").withColumn("id", F.lit(9)), "k", [None, "b"])
    with pytest.raises(ValueError):
        b.replace("t", df, "k", ["a"])
    second = a.commit()
    assert rows(store.pin()["t"]) == rows(second["t"]) == [(1, "a"), (9, None)] and len(rows(first["t"])) == 3
    assert second.notes == {"note": "x"} and second.read("t", ["a"]).count() == 1 and second.read("t", ["none"]).count() == 0
    b.replace("t", df)
    with pytest.raises(Conflict):
        b.commit()
    assert store.clean(keep=2) == []
    assert len(store.clean(keep=1, least_age_s=0)) == 6                                               # two of version 1, three of the refused write, one of the lost draft
    assert rows(store.pin()["t"]) == [(1, "a"), (9, None)] and store.numbers() == [2]
    with pytest.raises(LookupError):
        store.pin(1)


def test_deploy_and_backfill_as_versions(spark, driver_src, tmp_path, monkeypatch):
    store = Snapshots(spark, str(tmp_path / "marts"))
    assert {r.status for r in jobs.deploy(driver_src, AS_OF, only="vw_dim_group", store=store).collect()} == {"ok"}
    good = store.pin()
    monkeypatch.setattr(jobs, "MARTS", [("vw_dim_group", lambda s, a: s["groups"].select("no_such_column"), "star"),
                                        ("vw_dim_sla", dict((n, b) for n, b, _ in jobs.MARTS)["vw_dim_sla"], "star")])
    tally = {r.mart: r.status for r in jobs.deploy(driver_src, AS_OF, store=store).collect()}
    assert tally == {"vw_dim_group": "error", "vw_dim_sla": "ok"}
    now = store.pin()
    assert now.tables["vw_dim_group"] == good.tables["vw_dim_group"] and now["vw_dim_sla"].count() > 0
    tables = Snapshots(spark, str(tmp_path / "tables"))
    draft = tables.begin()
    user = driver_src["users"].where("entities_id not in (0, 1, 2, 3)").first()
    draft.replace("tickets", driver_src["tickets"].limit(50).withColumn("entities_id", F.lit(2).cast("bigint")))
    draft.replace("users", driver_src["users"])
    tickets = draft.read("tickets").select(F.col("id").alias("tickets_id"))
    draft.replace("tickets_users", tickets.withColumn("users_id", F.lit(user["id"])).withColumn("type", F.lit(1)))
    old = draft.commit()
    new = backfill.apply_backfill(tables, "ticket_entity")
    assert {r[0] for r in new["tickets"].select("entities_id").collect()} == {user["entities_id"]} and new.notes["backfills"] == ["ticket_entity"]
    assert {r[0] for r in old["tickets"].select("entities_id").collect()} == {2} and new["tickets"].columns == old["tickets"].columns
    assert rows(new["tickets"].drop("entities_id")) == rows(old["tickets"].drop("entities_id"))


def test_typed_contracts_name_what_differs(spark, driver_src, tmp_path):
    from tessera.sources import schemas
    from tessera.sources.contracts import CONTRACT_TABLES
    from tessera.sources.io import load_sources, write_sources
    assert set(schemas.COLUMNS) == set(CONTRACT_TABLES)
    assert [d for t in CONTRACT_TABLES for d in schemas.differences(t, driver_src[t].schema)] == []
    at = str(tmp_path / "contracts")
    write_sources(driver_src, at, ["groups", "tickets", "slas"])
    src = load_sources(spark, at)
    assert "groups" in src and "users" not in src and "no_such" not in src and src.check() == []
    assert [f.name for f in src["groups"].schema.fields] == schemas.COLUMNS["groups"].split()
    n = src["groups"].count()
    driver_src["groups"].limit(1).write.mode("append").parquet(f"{at}/groups")
    assert src["groups"].count() == n + 1                                                            # listed anew
    driver_src["slas"].withColumn("type", F.col("type").cast("string")).drop("number_time").write.mode("overwrite").parquet(f"{at}/slas")
    with pytest.raises(schemas.ContractError, match="slas.type is string, declared int; slas.number_time is missing|slas.number_time is missing.*slas.type is string"):
        src["slas"]
    assert len(src.check()) == 2
    with pytest.raises(KeyError):
        src["no_such"]
    driver_src["tickets"].withColumn("reopen_count", F.lit(1)).write.mode("overwrite").parquet(f"{at}/tickets")
    assert "reopen_count" in src["tickets"].columns
