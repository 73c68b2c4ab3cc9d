"""C4: SLA predicates on the ticket contract columns.

Column arguments default to the contract names (status, solvedate,
time_to_resolve); defaults are resolved lazily because Column objects need
an active session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import domains as D


def _c(c, name):
    return F.col(name) if c is None else c


def resolved(status: Column | None = None) -> Column:
    return _c(status, "status").isin(*D.RESOLVED_CODES)


def sla_met(status=None, solved=None, due=None) -> Column:
    status, solved, due = _c(status, "status"), _c(solved, "solvedate"), _c(due, "time_to_resolve")
    return due.isNotNull() & resolved(status) & (solved <= due)


def sla_breached(status=None, solved=None, due=None) -> Column:
    status, solved, due = _c(status, "status"), _c(solved, "solvedate"), _c(due, "time_to_resolve")
    return due.isNotNull() & resolved(status) & (solved > due)


def sla_flag(status=None, solved=None, due=None) -> Column:
    """1 met, 0 breached, NULL no SLA / not resolved."""
    status, solved, due = _c(status, "status"), _c(solved, "solvedate"), _c(due, "time_to_resolve")
    return (F.when(due.isNull(), F.lit(None))
            .when(resolved(status) & (solved <= due), F.lit(1))
            .when(resolved(status) & (solved > due), F.lit(0)))


def sla_status(now: Column, status=None, solved=None, due=None, fallback: str = D.SLA_NONE) -> Column:
    """Textual SLA state; ``fallback`` differs per mart."""
    status, solved, due = _c(status, "status"), _c(solved, "solvedate"), _c(due, "time_to_resolve")
    open_ = ~status.isin(*D.RESOLVED_CODES)
    return (F.when(due.isNull(), F.lit(D.SLA_NONE))
            .when(resolved(status) & (solved <= due), F.lit(D.SLA_MET))
            .when(resolved(status) & (solved > due), F.lit(D.SLA_BREACHED))
            .when(open_ & (now > due), F.lit(D.SLA_BREACHED_OPEN))
            .when(open_ & (now <= due), F.lit(D.SLA_AT_RISK))
            .otherwise(F.lit(fallback)))


def count_when(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)`` as bigint."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
