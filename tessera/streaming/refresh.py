"""Incremental mart refresh from a stream of new ticket files.

Each micro-batch only names the *months* it touches; those months of the
month-keyed marts (volume trend, SLA by month/group/priority, productivity, SLA
by entity, satisfaction by answer month) are recomputed from the full source (so non-additive results such as averages and
compliance ratios stay exact) and written with dynamic partition overwrite.  The
query runs with ``trigger(availableNow=True)``: one call drains what has
arrived and stops, which is how the periodic refresh loop (default 60 s,
stop after 5 consecutive failures) drives it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.time import year_month
from tessera.plans.marts_entity import build_vw_entity_sla_monthly
from tessera.plans.marts_finance import build_vw_fact_satisfaction_summary
from tessera.plans.marts_tickets import build_vw_sla_monthly, build_vw_tech_productivity, build_vw_volume_trend

T = F.col
DEFAULT_INTERVAL_S = 60
MAX_CONSECUTIVE_FAILURES = 5


# marts keyed by creation month that the refresh rebuilds: name -> builder (all carry year_month)
MONTHLY_MARTS = {"vw_volume_trend": build_vw_volume_trend, "vw_sla_monthly": build_vw_sla_monthly,
                 "vw_tech_productivity": build_vw_tech_productivity,
                 "vw_entity_sla_monthly": build_vw_entity_sla_monthly}


def refresh_months(full_src, months: DataFrame, out_path: str, as_of: datetime,
                   marts: dict | None = None) -> None:
    """Recompute the month-keyed marts for ``months`` only and overwrite just
    those partitions (``<out_path>/<mart>/year_month=...``).  Tickets are
    restricted to the touched months by a semi-join on the month list (small:
    distinct months of one micro-batch)."""
    tickets = full_src["tickets"]
    touched = tickets.join(F.broadcast(months), year_month(T("date")) == T("_ym"), "left_semi")
    src = _Override(full_src, tickets=touched)
    for name, builder in (marts or MONTHLY_MARTS).items():
        _overwrite_months(builder(src, as_of), f"{out_path}/{name}")


def refresh_answer_months(full_src, batch: DataFrame, out_path: str, as_of: datetime) -> None:
    """Recompute the satisfaction summary for the months in which tickets of
    ``batch`` were answered; it is keyed by answer month, so answers of other
    tickets in those months are read too."""
    sat = full_src["ticketsatisfactions"]
    months = (sat.join(batch.select(T("id").alias("_tid")).distinct(), T("tickets_id") == T("_tid"), "left_semi")
              .select(year_month(T("date_answered")).alias("_ym")).distinct())
    src = _Override(full_src, ticketsatisfactions=sat.join(months, year_month(T("date_answered")) == T("_ym"), "left_semi"))
    _overwrite_months(build_vw_fact_satisfaction_summary(src, as_of), f"{out_path}/vw_fact_satisfaction_summary")


def _overwrite_months(mart: DataFrame, path: str) -> None:
    (mart.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year_month").parquet(path))


class _Override:
    """Source mapping with some contracts replaced."""

    def __init__(self, base, **over):
        self.base, self.over = base, over

    def __getitem__(self, name):
        return self.over.get(name, self.base[name])


def refresh_once(spark: SparkSession, new_tickets_dir: str, schema: str, full_src, out_path: str,
                 checkpoint: str, as_of: datetime) -> None:
    """Drain the new files once.  ``full_src`` is a source mapping, or a
    function that opens one: it is then called per batch, so that files which
    arrived since are listed."""
    stream = spark.readStream.schema(schema).parquet(new_tickets_dir)

    def per_batch(batch: DataFrame, _epoch: int) -> None:
        months = batch.select(year_month(T("date")).alias("_ym")).distinct()
        src = full_src() if callable(full_src) else full_src
        refresh_months(src, months, out_path, as_of)
        refresh_answer_months(src, batch, out_path, as_of)

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def refresh_loop(run_once: Callable[[], None], interval_s: float = DEFAULT_INTERVAL_S,
                 max_failures: int = MAX_CONSECUTIVE_FAILURES, max_cycles: int | None = None,
                 sleep: Callable[[float], None] = time.sleep) -> dict:
    """Repeat ``run_once`` every ``interval_s``; stop after ``max_failures``
    consecutive failures (or ``max_cycles``).  Returns a small tally."""
    ok = failed = consecutive = cycles = 0
    while max_cycles is None or cycles < max_cycles:
        cycles += 1
        try:
            run_once()
            ok += 1
            consecutive = 0
        except Exception:  # noqa: BLE001 - error budget, as published
            failed += 1
            consecutive += 1
            if consecutive >= max_failures:
                break
        sleep(interval_s)
    return {"cycles": cycles, "ok": ok, "failed": failed, "stopped_on_failures": consecutive >= max_failures}
