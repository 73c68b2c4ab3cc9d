"""Safe division (ANSI mode raises on /0, so always guard with NULLIF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column, scale: float = 1.0, alt=None) -> Column:
    """``scale * num / NULLIF(den, 0)`` as double; ``alt`` replaces NULL (DAX DIVIDE)."""
    r = F.lit(float(scale)) * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return F.coalesce(r, F.lit(alt)) if alt is not None else r


def pct(num: Column, den: Column, digits: int) -> Column:
    """``ROUND(100.0 * num / NULLIF(den, 0), digits)`` as double."""
    return F.round(safe_ratio(num, den, 100.0), digits)
