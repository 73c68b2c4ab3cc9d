"""Code -> label CASE expressions built from the domain tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_label(code: Column, labels: dict, other: str | None = None) -> Column:
    """``CASE code WHEN k THEN v ... ELSE other END`` (other=None -> NULL)."""
    expr = None
    for k, v in labels.items():
        expr = F.when(code == F.lit(k), F.lit(v)) if expr is None else expr.when(code == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(other)) if other is not None else expr


def in_codes(code: Column, codes) -> Column:
    """0/1 flag ``CASE WHEN code IN (...) THEN 1 ELSE 0 END`` (NULL -> 0)."""
    return F.when(code.isin(*codes), F.lit(1)).otherwise(F.lit(0))
