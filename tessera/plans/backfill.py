"""Backfill jobs B1-B4: entity re-assignment as *new versions* of a table.

The published scripts UPDATE rows in place.  Here every job returns the
re-assigned table (old and new entity side by side) so it can be written
as a new snapshot; nothing is mutated.  "LIMIT 1" picks of the scripts are
made deterministic (lowest user / supplier id).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir
from tessera.sources.snapshots import Pin, Snapshots

T = F.col

# FIXED VALUES: placeholder entities that never receive records
PLACEHOLDER_ENTITIES = (0, 1, 2, 3)


def ticket_entity_follows_requester(src, as_of: datetime | None = None) -> DataFrame:
    """B1: a ticket moves to its requester's entity when that entity is real."""
    u = src["users"].select(T("id").alias("_uid"), T("entities_id").alias("_uent"))
    req = (src["tickets_users"].where(T("type") == 1)
           .join(u, T("users_id") == T("_uid"))
           .where(~T("_uent").isin(*PLACEHOLDER_ENTITIES))
           .groupBy(T("tickets_id").alias("_tid")).agg(F.min_by("_uent", "_uid").alias("_new")))
    t = src["tickets"].select("id", T("entities_id").alias("entities_id_before"))
    j = t.join(req, T("id") == T("_tid"), "left")
    new = F.coalesce(T("_new"), T("entities_id_before"))
    return j.select(T("id").alias("ticket_id"), "entities_id_before", new.alias("entities_id"),
                    (~new.eqNullSafe(T("entities_id_before"))).cast("int").alias("changed"))


def derived_follow_computer(src, as_of: datetime | None = None) -> DataFrame:
    """B2: OS rows, software installs and financial records of a computer
    take the computer's entity (one join per table on the computer id).

    Every row of the three tables comes back, so the result is a snapshot:
    rows of other kinds or of unknown computers keep the entity they have
    (NULL where the table has none)."""
    c = src["computers"].select(T("id").alias("_cid"), T("entities_id").alias("entities_id"))
    parts = []
    for table, key in (("items_operatingsystems", "items_id"), ("items_softwareversions", "id"),
                       ("infocoms", "id")):
        d = src[table]
        own = T("entities_id") if "entities_id" in d.columns else F.lit(None)
        d = d.select(F.lit(table).alias("source_table"), T(key).cast("bigint").alias("row_id"), "itemtype", "items_id",
                     own.cast("bigint").alias("entities_id_before"))
        parts.append(d.join(c, (T("items_id") == T("_cid")) & (T("itemtype") == "Computer"), "left").select(
            "source_table", "row_id", "itemtype", "items_id", "entities_id_before",
            F.coalesce("entities_id", "entities_id_before").alias("entities_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def phones_peripherals_follow_user(src, as_of: datetime | None = None, head_office: int | None = None) -> DataFrame:
    """phones/peripherals with a user take the user's (real) entity;
    those without a user that sit on a placeholder go to ``head_office``, a
    real entity the caller names (none named: they stay)."""
    if head_office in PLACEHOLDER_ENTITIES:
        raise ValueError("the head office cannot be a placeholder entity")
    u = src["users"].select(T("id").alias("_uid"), T("entities_id").alias("_uent"))
    parts = []
    for kind, table in (("Phone", "phones"), ("Peripheral", "peripherals")):
        a = src[table].join(u, (T("users_id") == T("_uid")) & (T("users_id") > 0), "left")
        no_user = T("users_id").isNull() | (T("users_id") == 0)
        new = (F.when(T("_uent").isNotNull() & ~T("_uent").isin(*PLACEHOLDER_ENTITIES), T("_uent"))
               .when(no_user & T("entities_id").isin(*PLACEHOLDER_ENTITIES[1:]), F.lit(head_office) if head_office is not None else T("entities_id"))
               .otherwise(T("entities_id")))
        parts.append(a.select(F.lit(kind).alias("kind"), T("id").alias("asset_id"),
                              T("entities_id").alias("entities_id_before"), new.cast("bigint").alias("entities_id")))
    return parts[0].unionByName(parts[1])


def contracts_follow_supplier(src, as_of: datetime | None = None) -> DataFrame:
    """A contract takes the entity of its first (lowest id) supplier; a
    link to an unknown supplier leaves it where it is."""
    first = src["contracts_suppliers"].groupBy(T("contracts_id").alias("_ct")).agg(F.min("suppliers_id").alias("_sid"))
    s = src["suppliers"].select(T("id").alias("_s"), T("entities_id").alias("_sent"))
    c = src["contracts"].select("id", T("entities_id").alias("entities_id_before"))
    j = c.join(first, T("id") == T("_ct"), "left").join(s, T("_sid") == T("_s"), "left")
    return j.select(T("id").alias("contract_id"), "entities_id_before",
                    F.coalesce("_sent", "entities_id_before").alias("entities_id"))


def _moved(table: DataFrame, report: DataFrame, key: str) -> DataFrame:
    """``table`` with the entities of a report; columns keep their order, every row stays."""
    new = report.select(T(key).alias("_key"), T("entities_id").alias("_new"))
    j = table.join(new, T("id") == T("_key"), "left")
    return j.select(*[F.coalesce("_new", c).cast(table.schema[c].dataType).alias(c) if c == "entities_id" else T(c) for c in table.columns])


def _with_computer(table: DataFrame, computers: DataFrame) -> DataFrame:
    """Rows of a computer take its entity; the column is added (NULL for other rows) where the table has none."""
    c = computers.select(T("id").alias("_cid"), T("entities_id").alias("_new"))
    own = T("entities_id") if "entities_id" in table.columns else F.lit(None)
    j = table.join(c, (T("items_id") == T("_cid")) & (T("itemtype") == "Computer"), "left")
    return j.select(*[x for x in table.columns if x != "entities_id"], F.coalesce("_new", own.cast("bigint")).alias("entities_id"))


#: tables that a job changes, made from a source mapping
JOBS = {
    "ticket_entity": lambda src, **kw: {"tickets": _moved(src["tickets"], ticket_entity_follows_requester(src), "ticket_id")},
    "derived_entity": lambda src, **kw: {t: _with_computer(src[t], src["computers"]) for t in ("items_operatingsystems", "items_softwareversions", "infocoms")},
    "phone_peripheral_entity": lambda src, **kw: {
        t: _moved(src[t], phones_peripherals_follow_user(src, **kw).where(T("kind") == k), "asset_id") for k, t in (("Phone", "phones"), ("Peripheral", "peripherals"))},
    "contract_entity": lambda src, **kw: {"contracts": _moved(src["contracts"], contracts_follow_supplier(src), "contract_id")},
}


def apply_backfill(store: Snapshots, job: str, **options) -> Pin:
    """B1-B4 as a new version of the tables they change: readers of the version before keep it, a failed job leaves it."""
    pin = store.pin()
    draft = store.begin(pin)
    for name, table in JOBS[job](pin, **options).items():
        draft.replace(name, table)
    return draft.commit(backfills=[*pin.notes.get("backfills", []), job])


def snapshot_derived_entity(src, as_of: datetime | None = None) -> DataFrame:
    """B2 through versions: rows by table and entity in the version before (still readable) and in the one after."""
    spark = src["computers"].sparkSession
    name = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    store = Snapshots(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-backfill/{name}")
    tables = ("items_operatingsystems", "items_softwareversions", "infocoms")
    draft = store.begin()
    for t in (*tables, "computers"):
        draft.replace(t, src[t])
    old = draft.commit()
    new = apply_backfill(store, "derived_entity")

    def counts(pin: Pin, out: str) -> DataFrame:
        one = lambda t: pin[t].select(F.lit(t).alias("source_table"), (T("entities_id") if "entities_id" in pin[t].columns else F.lit(None))
                                      .cast("bigint").alias("entities_id"))
        return one(tables[0]).unionByName(one(tables[1])).unionByName(one(tables[2])).groupBy("source_table", "entities_id").agg(F.count("*").alias(out))

    both = counts(old, "rows_before").unionByName(counts(new, "rows_after"), allowMissingColumns=True)
    return both.groupBy("source_table", "entities_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("rows_before", "rows_after")])


QUERIES = {
    "snapshot_derived_entity": snapshot_derived_entity,
    "backfill_ticket_entity": ticket_entity_follows_requester,
    "backfill_derived_entity": derived_follow_computer,
    "backfill_phone_peripheral_entity": phones_peripherals_follow_user,
    "backfill_contract_entity": contracts_follow_supplier,
}
