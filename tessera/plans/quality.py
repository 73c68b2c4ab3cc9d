"""Data-quality jobs Q1-Q6: referential checks in one report.

All rules share one aggregate over stacked references (see
``integrity_report``).  Rules whose table lacks the checked column are
reported as ``skip`` instead of failing the run, as the published checker does.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

T = F.col

# FIXED VALUES: tables checked for a valid entity (users with id <= 2 exempt)
ENTITY_TABLES = ("users", "tickets", "computers", "networkequipments", "racks", "monitors", "printers", "phones",
                 "peripherals", "problems", "changes", "projects", "softwares", "suppliers")
SYSTEM_USER_MAX_ID = 2
EXPECTED_ENTITIES = 5

# FIXED VALUES: resource labels of the volume matrix
VOLUME_TABLES = (("Usuários", "users"), ("Tickets", "tickets"), ("Computadores", "computers"),
                 ("Redes", "networkequipments"), ("Monitores", "monitors"), ("Impressoras", "printers"),
                 ("Telefones", "phones"), ("Periféricos", "peripherals"), ("Problemas", "problems"),
                 ("Mudanças", "changes"), ("Projetos", "projects"), ("Fornecedores", "suppliers"),
                 ("Softwares", "softwares"), ("Racks", "racks"))


def _skip(spark, rule: str, table: str) -> DataFrame:
    return spark.createDataFrame([(rule, table, "skip", None)],
                                 "rule string, table string, severity string, violations bigint")


def entity_orphans(src, table: str) -> DataFrame | None:
    """Q1 rows of ``table`` whose entities_id has no entity."""
    df = src[table]
    if "entities_id" not in df.columns:
        return None
    if table == "users":
        df = df.where(T("id") > SYSTEM_USER_MAX_ID)
    ents = src["entities"].select(T("id").alias("_eid"))
    return df.join(ents, df["entities_id"] == T("_eid"), "left_anti")


def references(src) -> tuple[list[tuple[str, str, str, DataFrame]], list[str]]:
    """Every rule as (rule, table, kind of thing referred to, one column ``ref`` of references), and the tables without
    the checked column."""
    rules, skipped = [], []
    for table in ENTITY_TABLES:
        df = src[table]
        if "entities_id" not in df.columns:
            skipped.append(table)
            continue
        if table == "users":
            df = df.where(T("id") > SYSTEM_USER_MAX_ID)
        rules.append(("Q1_entity_orphan", table, "entity", df.select(T("entities_id").alias("ref"))))
    rules.append(("Q2_ticket_without_requester", "tickets", "asked ticket", src["tickets"].select(T("id").alias("ref"))))
    rules.append(("Q2_ticket_entity_zero_or_unknown", "tickets", "entity but zero", src["tickets"].select(T("entities_id").alias("ref"))))
    slots = src["items_racks"]
    rules.append(("Q3_rack_slot_unknown_rack", "items_racks", "rack", slots.select(T("racks_id").alias("ref"))))
    for kind, table in (("Computer", "computers"), ("NetworkEquipment", "networkequipments")):
        rules.append((f"Q3_rack_slot_unknown_{table}", "items_racks", kind, slots.where(T("itemtype") == kind).select(T("items_id").alias("ref"))))
    for table in ("items_softwareversions", "items_operatingsystems"):
        rules.append(("Q4_unknown_computer", table, "Computer", src[table].where(T("itemtype") == "Computer").select(T("items_id").alias("ref"))))
    return rules, skipped


def known_things(src) -> dict[str, DataFrame]:
    """Kind of thing -> one column ``ref`` of those that exist."""
    return {
        "entity": src["entities"].select(T("id").alias("ref")),
        "entity but zero": src["entities"].where("id != 0").select(T("id").alias("ref")),
        "asked ticket": src["tickets_users"].where("type = 1").select(T("tickets_id").alias("ref")),
        "rack": src["racks"].select(T("id").alias("ref")),
        "Computer": src["computers"].select(T("id").alias("ref")),
        "NetworkEquipment": src["networkequipments"].select(T("id").alias("ref")),
    }


def integrity_report(src, as_of: datetime | None = None) -> DataFrame:
    """Q1-Q5: one row per rule (rule, table, severity, violations).

    References of all rules and the things they refer to are stacked and meet
    in ONE aggregate by (kind, key): counts of each rule beside whether the
    thing exists.  Partial counts come first, so a key that a third of all rows
    name is one row of each task.  A second aggregate of one row adds up the
    references to what does not exist.
    """
    rules, skipped = references(src)
    stacked = None
    for i, (_, _, kind, df) in enumerate(rules):
        one = df.select(F.lit(kind).alias("kind"), T("ref").cast("bigint").alias("ref"), F.lit(i).alias("rule"))
        stacked = one if stacked is None else stacked.unionByName(one)
    for kind, df in known_things(src).items():
        stacked = stacked.unionByName(df.select(F.lit(kind).alias("kind"), T("ref").cast("bigint").alias("ref"), F.lit(-1).alias("rule")))
    keys = stacked.groupBy("kind", "ref").agg(
        F.count(F.when(T("rule") == -1, 1)).alias("known"), *[F.count(F.when(T("rule") == i, 1)).alias(f"_{i}") for i in range(len(rules))])
    gone = (T("known") == 0) | T("ref").isNull()
    sums = keys.agg(*[F.sum(F.when(gone, T(f"_{i}")).otherwise(0)).alias(f"_{i}") for i in range(len(rules))],
                    F.coalesce(F.sum(F.when(T("kind") == "entity", T("known"))), F.lit(0)).alias("entities"))
    rows = [f"'{r}', '{t}', 'error', coalesce(_{i}, 0L)" for i, (r, t, _, _) in enumerate(rules)]
    rows.append(f"'Q5_expected_entities', 'entities', if(entities = {EXPECTED_ENTITIES}, 'ok', 'warning'), abs(entities - {EXPECTED_ENTITIES})")
    out = sums.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (rule, table, severity, violations)")
    for table in skipped:
        out = out.unionByName(_skip(src["tickets"].sparkSession, "Q1_entity_orphan", table))
    return out


def integrity_status(src, as_of: datetime | None = None) -> DataFrame:
    """Q5: overall verdict - errors (error rules with violations), warnings,
    status PASS when there are no errors."""
    rep = integrity_report(src)
    agg = rep.agg(F.sum(F.when((T("severity") == "error") & (T("violations") > 0), 1).otherwise(0)).cast("bigint").alias("errors"),
                  F.sum(F.when(T("severity") == "warning", 1).otherwise(0)).cast("bigint").alias("warnings"))
    return agg.withColumn("status", F.when(T("errors") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))


def volume_matrix(src, as_of: datetime | None = None) -> DataFrame:
    """Q6: records per resource x entity (long form) with an orphan flag."""
    stacked = None
    for label, table in VOLUME_TABLES:
        df = src[table]
        if "entities_id" not in df.columns:
            continue
        if table == "users":
            df = df.where(T("id") > SYSTEM_USER_MAX_ID)
        one = df.select(F.lit(label).alias("resource"), T("entities_id").alias("entity_id"))
        stacked = one if stacked is None else stacked.unionByName(one)
    parts = stacked.groupBy("resource", "entity_id").agg(F.count(F.lit(1)).alias("records"))
    ents = src["entities"].select(T("id").alias("_eid"), T("name").alias("entity_name"))
    j = parts.join(ents, T("entity_id") == T("_eid"), "left")
    return j.select("resource", "entity_id", "entity_name", "records",
                    T("_eid").isNull().cast("int").alias("orphan"))


QUERIES = {
    "quality_integrity_report": integrity_report,
    "quality_integrity_status": integrity_status,
    "quality_volume_matrix": volume_matrix,
}
