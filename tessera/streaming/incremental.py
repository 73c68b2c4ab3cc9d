"""Refresh of month-keyed marts from changes alone, with retraction.

Two kinds of state live in one versioned store (``sources.snapshots``):

* the ticket tables themselves, in partitions of neighbouring ticket ids (``span``), so the changes of a period, which
  fall on recent tickets, touch few of them and no index from ticket to month is needed;
* for every mart a table of mergeable counters by month and key: counts, sums of whole minutes, histograms of scores and
  minutes, and a count per key where distinct keys are asked for.

A batch of changes reads its own rows and the partitions of their tickets.  What those tickets gave before is taken off
the counters and what they give now is added, so a ticket that moves to another month, changes its group or goes away
leaves its old month; a counter row without tickets is dropped and a month without rows loses its partition.  The marts
of the touched months are then made from the counters.  Tables, counters, marts and the batch's number become one
version: a batch that fails leaves the version before, a batch that comes again is passed over, and a change that is
older than what is stored changes nothing.

A table's rows of one ticket change together: the rows of the highest ``_seq`` replace those before, and a row with
``_deleted`` stands for none.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera import domains as D
from tessera.functions.labels import code_label
from tessera.functions.ratios import pct
from tessera.functions.time import diff_units, year_month
from tessera.operators.links import first_group_name, first_link, full_name
from tessera.operators.sla import resolved, sla_breached, sla_met
from tessera.sources.snapshots import Draft, Pin, Snapshots

T = F.col

#: the table of changes and its column that names the ticket
OWNERS = {"tickets": "id", "groups_tickets": "tickets_id", "tickets_users": "tickets_id", "ticketsatisfactions": "tickets_id"}
SPAN_TICKETS = 100_000
SEQ, GONE, SPAN = "_seq", "_deleted", "_span"


# ------------------------------------------------------- what a ticket gives

def _n(pred: Column) -> Column:
    return F.when(pred, 1).otherwise(0).cast("bigint")


def _minutes() -> Column:
    return F.when(T("solvedate").isNotNull(), diff_units("MINUTE", T("date"), T("solvedate"))).cast("bigint")


def _live(src) -> DataFrame:
    return src["tickets"].where(T("is_deleted") == 0).withColumn("year_month", year_month(T("date"))).withColumn("minutes", _minutes())


def _with_link(t: DataFrame, links: DataFrame, actor: str, out: str, how: str) -> DataFrame:
    first = first_link(links, "tickets_id", actor, 2, out=out)
    return t.join(first, T("id") == T("tickets_id"), how).drop("tickets_id")


def _timed() -> dict[str, Column]:
    return {"minutes_sum": F.coalesce(T("minutes"), F.lit(0)).cast("bigint"), "minutes_n": _n(T("minutes").isNotNull())}


def _met() -> dict[str, Column]:
    return {"sla_resolved": _n(T("time_to_resolve").isNotNull() & resolved()), "met": _n(F.coalesce(sla_met(), F.lit(False))),
            "breached": _n(F.coalesce(sla_breached(), F.lit(False)))}


def _volume(src) -> DataFrame:
    c = {"resolved": _n(resolved()), "closed": _n(T("status") == D.CLOSED_CODE), "open": _n(T("status").isin(*D.OPEN_CODES)),
         "incidents": _n(T("type") == 1), "requests": _n(T("type") == 2), **_timed()}
    return _live(src).select("year_month", F.lit(1).cast("bigint").alias("n"), *[v.alias(k) for k, v in c.items()])


def _sla(src) -> DataFrame:
    c = {"resolved": _n(resolved()), **_met(), **_timed()}
    return _with_link(_live(src), src["groups_tickets"], "groups_id", "group_id", "left").select(
        "year_month", "group_id", "priority", F.lit(1).cast("bigint").alias("n"), *[v.alias(k) for k, v in c.items()])


def _productivity(src) -> DataFrame:
    c = {"resolved": _n(resolved()), "closed": _n(T("status") == D.CLOSED_CODE), **_met(), **_timed()}
    return _with_link(_live(src), src["tickets_users"], "users_id", "technician_id", "inner").select(
        "year_month", "technician_id", F.lit(1).cast("bigint").alias("n"), *[v.alias(k) for k, v in c.items()])


def _entity_sla(src) -> DataFrame:
    due, solved = T("time_to_resolve"), T("solvedate")
    has, done = due.isNotNull(), due.isNotNull() & solved.isNotNull()
    c = {"with_sla": has, "within": done & (solved <= due), "late": done & (solved > due), "solved": done,
         "pending": has & solved.isNull() & ~T("status").isin(*D.RESOLVED_CODES)}
    return _live(src).select("year_month", T("entities_id").alias("entity_id"), "type", F.lit(1).cast("bigint").alias("n"),
                             *[_n(F.coalesce(v, F.lit(False))).alias(k) for k, v in c.items()])


def _satisfaction(src) -> DataFrame:
    known = src["tickets"].select(T("id").alias("_tid"))
    groups = src["groups_tickets"].where(T("type") == 2).select(T("tickets_id").alias("_gt"), T("groups_id").alias("group_id"))
    return (src["ticketsatisfactions"].where(T("date_answered").isNotNull()).join(known, T("tickets_id") == T("_tid"))
            .join(groups, T("_tid") == T("_gt"), "left")
            .select(year_month(T("date_answered")).alias("year_month"), "group_id", T("satisfaction_scaled_to_5").alias("score"),
                    F.lit(1).cast("bigint").alias("n"), _n(T("id").isNotNull()).alias("answers")))


def _resolution(src) -> DataFrame:
    return _live(src).where(T("minutes").isNotNull()).select("year_month", "minutes", F.lit(1).cast("bigint").alias("n"))


#: counters: name -> (keys besides the month, rows of what each ticket gives); ``n`` counts tickets (or answers)
COUNTERS: dict[str, tuple[tuple[str, ...], Callable]] = {
    "counters_volume": ((), _volume),
    "counters_sla": (("group_id", "priority"), _sla),
    "counters_productivity": (("technician_id",), _productivity),
    "counters_entity_sla": (("entity_id", "type"), _entity_sla),
    "counters_satisfaction": (("group_id", "score"), _satisfaction),
    "counters_resolution": (("minutes",), _resolution),
}


# ------------------------------------------------------- marts from counters

def _month_parts() -> list[Column]:
    return ["year_month", F.substring("year_month", 1, 4).cast("int").alias("yr"), F.substring("year_month", 6, 2).cast("int").alias("mon")]


def _sums(*names: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in names]


def _mean(digits: int = 1) -> Column:
    return F.round(T("minutes_sum") / F.when(T("minutes_n") > 0, T("minutes_n")), digits).alias("avg_resolution_min")


def volume_trend(c: Mapping, dims) -> DataFrame:
    return c["counters_volume"].select(
        *_month_parts(), T("n").alias("tickets_created"), T("resolved").alias("tickets_resolved"), T("closed").alias("tickets_closed"),
        T("open").alias("tickets_open"), "incidents", "requests", _mean())


def sla_monthly(c: Mapping, dims) -> DataFrame:
    g = dims["groups"].select(T("id").alias("_gid"), T("name").alias("_group"))
    agg = (c["counters_sla"].join(g, T("group_id") == T("_gid"), "left").groupBy("year_month", "_group", "priority")
           .agg(*_sums("n", "resolved", "sla_resolved", "met", "breached", "minutes_sum", "minutes_n")))
    return agg.select(
        *_month_parts(), F.coalesce("_group", F.lit(D.NO_GROUP)).alias("group_name"),
        code_label(T("priority"), D.PRIORITY_LABELS_COMPACT, D.PRIORITY_COMPACT_UNKNOWN).alias("priority_label"),
        T("n").alias("total_tickets"), T("resolved").alias("resolved_tickets"), T("sla_resolved").alias("tickets_with_sla_resolved"),
        T("met").alias("within_sla"), T("breached").alias("breached_sla"), pct(T("met"), T("sla_resolved"), 2).alias("sla_compliance_pct"), _mean())


def tech_productivity(c: Mapping, dims) -> DataFrame:
    u = dims["users"].select(T("id").alias("_uid"), "firstname", "realname")
    g = first_group_name(dims["groups_users"], dims["groups"], "_team").withColumnRenamed("users_id", "_gu")
    j = c["counters_productivity"].join(u, T("technician_id") == T("_uid")).join(g, T("_uid") == T("_gu"), "left")
    return j.select(
        *_month_parts(), full_name(T("firstname"), T("realname")).alias("technician_name"), "technician_id",
        F.coalesce("_team", F.lit(D.NO_GROUP)).alias("team_group"), T("n").alias("tickets_assigned"), T("resolved").alias("tickets_resolved"),
        T("closed").alias("tickets_closed"), _mean(), pct(T("met"), T("sla_resolved"), 2).alias("sla_compliance_pct"))


def entity_sla_monthly(c: Mapping, dims) -> DataFrame:
    agg = c["counters_entity_sla"].groupBy("entity_id", "year_month").agg(
        *_sums("n", "with_sla", "within", "late", "pending", "solved"), F.max_by("type", F.struct(T("n"), -T("type"))).alias("predominant_type"))
    e = dims["entities"].select(T("id").alias("_eid"), T("name").alias("entity_name"))
    return agg.join(e, T("entity_id") == T("_eid")).select(
        "entity_id", "entity_name", "year_month", T("n").alias("total_tickets"), T("with_sla").alias("tickets_with_sla"),
        T("within").alias("within_sla"), T("late").alias("breached_sla"), T("pending").alias("pending_with_sla"),
        pct(T("within"), T("solved"), 1).alias("sla_compliance_pct"), "predominant_type")


def satisfaction_summary(c: Mapping, dims) -> DataFrame:
    g = dims["groups"].select(T("id").alias("_gid"), T("name").alias("tech_group"))
    said = F.when(T("score").isNotNull(), T("n"))
    among = lambda pred: F.coalesce(F.sum(F.when(pred, T("n"))), F.lit(0)).cast("bigint")
    agg = c["counters_satisfaction"].join(g, T("group_id") == T("_gid"), "left").groupBy("year_month", "tech_group").agg(
        F.sum("answers").alias("responses"), F.round(F.sum(T("score") * T("n")) / F.sum(said), 2).alias("avg_satisfaction"),
        among(T("score") >= 4).alias("promoters"), among(T("score") == 3).alias("neutrals"), among(T("score") <= 2).alias("detractors"))
    return agg.select("year_month", F.substring("year_month", 1, 4).cast("int").alias("year"), F.substring("year_month", 6, 2).cast("int").alias("month"),
                      "tech_group", "responses", "avg_satisfaction", "promoters", "neutrals", "detractors")


def resolution_monthly(c: Mapping, dims) -> DataFrame:
    """Median and 90th percentile of resolution minutes by month, exact (linear between ranks), and active technicians:
    non-additive figures from the histogram of minutes and the technicians' counts."""
    run = Window.partitionBy("year_month").orderBy("minutes")
    whole = Window.partitionBy("year_month")
    h = c["counters_resolution"].withColumn("through", F.sum("n").over(run)).withColumn("total", F.sum("n").over(whole))

    def at(p: float, name: str) -> list[Column]:
        place = (T("total") - 1) * p
        value = lambda rank: F.min(F.when(T("through") > rank, T("minutes")))
        return [value(F.floor(place)).alias(f"{name}_low"), value(F.ceil(place)).alias(f"{name}_high"), F.first(place - F.floor(place)).alias(f"{name}_part")]

    def between(name: str) -> Column:
        return F.round(T(f"{name}_low") + (T(f"{name}_high") - T(f"{name}_low")) * T(f"{name}_part"), 4).alias(f"{name}_resolution_min")

    picked = h.groupBy("year_month").agg(F.max("total").alias("resolved_tickets"), *at(0.5, "median"), *at(0.9, "p90"))
    active = c["counters_productivity"].groupBy(T("year_month").alias("_ym")).agg(F.count("technician_id").alias("active_technicians"))
    return picked.join(active, T("year_month").eqNullSafe(T("_ym")), "left").select(
        "year_month", "resolved_tickets", between("median"), between("p90"), F.coalesce("active_technicians", F.lit(0)).cast("bigint").alias("active_technicians"))


#: marts: name -> (counters they read, how they are made of them)
MARTS: dict[str, tuple[tuple[str, ...], Callable]] = {
    "vw_volume_trend": (("counters_volume",), volume_trend),
    "vw_sla_monthly": (("counters_sla",), sla_monthly),
    "vw_tech_productivity": (("counters_productivity",), tech_productivity),
    "vw_entity_sla_monthly": (("counters_entity_sla",), entity_sla_monthly),
    "vw_fact_satisfaction_summary": (("counters_satisfaction",), satisfaction_summary),
    "resolution_monthly": (("counters_resolution", "counters_productivity"), resolution_monthly),
}


# --------------------------------------------------------------------- batches

def _latest(draft: Draft, old: DataFrame, new: DataFrame, owner: str) -> DataFrame:
    """Of each ticket the rows of the highest sequence number; at the same number the stored ones.

    A ticket has one row in ``tickets``; links that a batch holds twice under one number are two links.  A ticket lies in
    one span, so the rows are dealt once, by span, for both the comparison and the write.
    """
    if owner == "id":
        new = new.dropDuplicates([owner, SEQ])
    both = draft.dealt(old.withColumn("_stored", F.lit(1)).unionByName(new.withColumn("_stored", F.lit(0))), SPAN)
    rank = F.struct(SEQ, "_stored")
    top = both.withColumn("_top", F.max(rank).over(Window.partitionBy(SPAN, owner)))
    return top.where(rank == T("_top")).drop("_top", "_stored")


def current(rows: DataFrame) -> DataFrame:
    """A stored ticket table without its bookkeeping."""
    return rows.where(~T(GONE)).drop(SEQ, GONE, SPAN)


def _read_by(marts) -> list[str]:
    return [name for name in COUNTERS if any(name in MARTS[m][0] for m in marts)]


def _given(src, sign: int, names) -> dict[str, DataFrame]:
    out = {}
    for name in names:
        keys, rows = COUNTERS[name]
        df = rows(src)
        counts = [c for c in df.columns if c not in ("year_month", *keys)]
        out[name] = df.select("year_month", *keys, *[(T(c) * sign).alias(c) for c in counts])
    return out


def _merged(name: str, rows: DataFrame) -> DataFrame:
    keys = ("year_month", *COUNTERS[name][0])
    counts = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


def _write_marts(draft: Draft, marts, months: dict[str, list] | None, dims) -> None:
    for name in marts:
        reads, make = MARTS[name]
        touched = None if months is None else sorted({m for r in reads for m in months[r]}, key=str)
        if touched == []:
            continue
        counters = {r: draft.read(r, touched) for r in reads}
        draft.replace(name, make(counters, dims), "year_month", touched)


def start(store: Snapshots, sources, span: int = SPAN_TICKETS, marts=tuple(MARTS)) -> Pin:
    """The first version: the ticket tables as they are (sequence number -1), the chosen marts and the counters these read."""
    draft = store.begin()
    for name, owner in OWNERS.items():
        rows = sources[name].withColumn(SEQ, F.lit(-1).cast("bigint")).withColumn(GONE, F.lit(False)).withColumn(
            SPAN, F.floor(T(owner) / span).cast("bigint"))
        draft.replace(name, rows, SPAN)
    now = {name: current(draft.read(name)) for name in OWNERS}
    for name, rows in _given(now, 1, _read_by(marts)).items():
        draft.replace(name, _merged(name, rows), "year_month")
    _write_marts(draft, marts, None, sources)
    return draft.commit(span=span, batches={}, marts=list(marts))


def apply(store: Snapshots, changes: Mapping[str, DataFrame], dims, batch: tuple[str, int] | None = None) -> Pin:
    """One batch of changes (table name -> its rows with ``_seq`` and ``_deleted``) to the next version.

    ``dims`` supplies groups, users, groups_users and entities.  ``batch`` names a stream and its batch: one that was
    committed before is passed over.  Reads the partitions of the changed tickets and of the touched months only.  The
    changes themselves, whatever they are made of, are read once: every later step reads what was written of them.
    """
    pin = store.pin()
    done = pin.notes["batches"]
    if batch and done.get(batch[0], -1) >= batch[1]:
        return pin
    draft, span = store.begin(pin), pin.notes["span"]
    changes = {name: draft.replace(f"change_{name}", df) for name, df in changes.items()}
    ids = None
    for name, df in changes.items():
        own = df.select(T(OWNERS[name]).alias("_ticket")).where(T("_ticket").isNotNull())
        ids = own if ids is None else ids.unionByName(own)
    ids = draft.replace("change_ids", ids.distinct().withColumn(SPAN, F.floor(T("_ticket") / span).cast("bigint")))
    spans = [r[0] for r in ids.select(SPAN).distinct().collect()]                   # partitions to open, not tickets
    if not spans:
        return pin

    def of_batch(name: str, rows: DataFrame) -> DataFrame:
        return current(rows).join(ids.select("_ticket"), T(OWNERS[name]) == T("_ticket"), "left_semi")

    before = {name: of_batch(name, pin.read(name, spans)) for name in OWNERS}
    for name, df in changes.items():
        old = pin.read(name, spans)
        new = df.where(T(OWNERS[name]).isNotNull()).withColumn(SPAN, F.floor(T(OWNERS[name]) / span).cast("bigint")).select(*old.columns)
        draft.replace(name, _latest(draft, old, new, OWNERS[name]), SPAN, spans, dealt=True)
    after = {name: of_batch(name, draft.read(name, spans)) for name in OWNERS}
    names = _read_by(pin.notes["marts"])
    taken, added = _given(before, -1, names), _given(after, 1, names)
    months = {}
    for name in names:
        delta = _merged(name, taken[name].unionByName(added[name]))
        counts = [c for c in delta.columns if c not in ("year_month", *COUNTERS[name][0])]
        delta = draft.replace(f"delta_{name}", delta.where(F.greatest(*[F.abs(c) for c in counts], F.lit(0)) > 0), "year_month")
        months[name] = draft.values(f"delta_{name}")
        if months[name]:
            whole = _merged(name, pin.read(name, months[name]).unionByName(delta))
            draft.replace(name, whole.where("n != 0"), "year_month", months[name])
        draft.drop(f"delta_{name}")
    for name in ("ids", *changes):
        draft.drop(f"change_{name}")
    _write_marts(draft, pin.notes["marts"], months, dims)
    return draft.commit(batches={**done, batch[0]: batch[1]} if batch else done)


def dimensions_changed(store: Snapshots, dims) -> Pin:
    """All marts anew from the counters, after names or teams changed; no ticket is read."""
    pin = store.pin()
    draft = store.begin(pin)
    _write_marts(draft, pin.notes["marts"], None, dims)
    return draft.commit()


def follow(spark: SparkSession, folder: str, store: Snapshots, dims, checkpoint: str) -> None:
    """Drains the files of changes under ``folder`` (``<table>/*.parquet``) once; ``dims`` is a source mapping or a
    function that opens one for each batch.  One stream over all tables, so that a batch is one version."""
    pin = store.pin()
    stream = None
    for name in OWNERS:
        schema = pin.read(name, []).drop(SPAN).schema
        rows = spark.readStream.schema(schema).parquet(f"{folder}/{name}").select(F.struct("*").alias(name))
        rows = rows.select(*[T(k) if k == name else F.lit(None).cast(pin.read(k, []).drop(SPAN).select(F.struct("*")).schema[0].dataType).alias(k) for k in OWNERS])
        stream = rows if stream is None else stream.unionByName(rows)

    def per_batch(batch: DataFrame, number: int) -> None:
        some = batch.agg(*[F.count(k).alias(k) for k in OWNERS]).first()
        changes = {k: batch.where(T(k).isNotNull()).select(f"{k}.*") for k in OWNERS if some[k]}
        if changes:
            apply(store, changes, dims() if callable(dims) else dims, (checkpoint, number))

    (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()).awaitTermination()


def changes_of(rows: DataFrame, seq: int, gone: bool = False) -> DataFrame:
    """Contract rows as changes with one sequence number."""
    return rows.withColumn(SEQ, F.lit(seq).cast("bigint")).withColumn(GONE, F.lit(gone))


def refreshed(src, as_of: datetime | None = None, marts=tuple(MARTS)) -> Pin:
    """The ticket tables as a start that is wrong in many ways, set right by two batches of changes; the last version.

    At the start every eleventh ticket lies six weeks early, every thirteenth is missing, tickets of a seventh have no
    group, and each fifth ticket has a double that was never there.  The first batch mends dates and adds the missing
    tickets with their links, the second brings the groups and removes the doubles.
    """
    from tessera.session import ensure_checkpoint_dir, written
    src = {**{k: written(src[k], k) for k in OWNERS}, **{k: src[k] for k in ("groups", "users", "groups_users", "entities")}}
    spark = src["tickets"].sparkSession
    name = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    store = Snapshots(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-refresh/{name}")
    t, links = src["tickets"], {k: src[k] for k in OWNERS if k != "tickets"}
    last = t.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).first()[0]
    doubles = t.where("id % 5 = 0").withColumn("id", T("id") + F.lit(last))
    early = F.when(T("id") % 11 == 0, T("date") - F.expr("INTERVAL 42 DAYS")).otherwise(T("date"))
    wrong = {"tickets": t.where("id % 13 != 0").withColumn("date", early).unionByName(doubles)}
    wrong |= {k: d.where("tickets_id % 13 != 0") for k, d in links.items()}
    wrong["groups_tickets"] = wrong["groups_tickets"].where("tickets_id % 7 != 0")
    other = {k: src[k] for k in ("groups", "users", "groups_users", "entities")}
    start(store, {**wrong, **other}, max(1, last // 16), marts)
    first = {"tickets": changes_of(t.where("id % 11 = 0 or id % 13 = 0"), 1)} | {k: changes_of(d.where("tickets_id % 13 = 0"), 1) for k, d in links.items()}
    apply(store, first, other, ("changes", 0))
    second = {"tickets": changes_of(doubles, 2, gone=True), "groups_tickets": changes_of(links["groups_tickets"].where("tickets_id % 7 = 0"), 2)}
    return apply(store, second, other, ("changes", 1))


def _mart_after(name: str) -> Callable:
    def run(src, as_of: datetime | None = None) -> DataFrame:
        return refreshed(src, as_of, (name,))[name]
    return run


QUERIES = {
    "refresh_sla_monthly": _mart_after("vw_sla_monthly"),
    "refresh_resolution_monthly": _mart_after("resolution_monthly"),
}
