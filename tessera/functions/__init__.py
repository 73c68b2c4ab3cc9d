"""Column-level helpers (all JVM-side built-in expressions, no UDFs)."""

from tessera.functions.labels import code_label, in_codes
from tessera.functions.ratios import pct, safe_ratio
from tessera.functions.time import (
    add_days, add_minutes, add_months_ts, diff_units, ntz, weekday_sun1, year_month,
)

__all__ = [
    "code_label", "in_codes", "pct", "safe_ratio", "add_days", "add_minutes",
    "add_months_ts", "diff_units", "ntz", "weekday_sun1", "year_month",
]
