"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsgrid.functions.text import as_col, bind


def parse_number(c, lo: float, hi: float) -> Column:
    """First signed number once thousands commas are removed, null outside [lo, hi]."""
    n = F.regexp_extract(F.replace(as_col(c), F.lit(","), F.lit("")), r"-?\d+(?:\.\d+)?", 0).try_cast("double")
    return bind(n, lambda n: F.when(n.between(lo, hi), n))


def clamp_int(c, lo: int = 0, hi: int = 100, default=0) -> Column:
    """Round half to even, default when not a number, then bound to [lo, hi]."""
    n = as_col(c).try_cast("double")
    value = F.when(F.isnan(n) | n.isNull(), as_col(default) if isinstance(default, (str, Column)) else F.lit(default)).otherwise(
        F.bround(n, 0)
    )
    return F.least(F.greatest(value, F.lit(lo)), F.lit(hi)).cast("int")


def pct_change(value, base) -> Column:
    """(value / base − 1) · 100, null when the base is zero, null or NaN."""
    value, base = as_col(value), as_col(base)
    return F.when(~F.isnan(base) & (base != 0), (F.try_divide(value, base) - 1) * 100)
