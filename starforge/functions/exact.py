"""Exact integer arithmetic for rounded ratios.

SQL ROUND(numeric) rounds half away from zero on the exact value. Doing the
division in integers keeps Spark, DuckDB and the definition bit-identical
(floating point division followed by ``round`` is not).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_D0 = "decimal(38,0)"


def idiv(a: Column, b: Column) -> Column:
    """Floor division of non-negative integers, exact (no double round trip)."""
    a = a.cast(_D0)
    b = b.cast(_D0)
    return ((a - F.pmod(a, b)) / b).cast(_D0)  # the division is exact: a - a mod b is a multiple of b


def round_ratio(num: Column, den: Column, scale: int) -> Column:
    """num / den rounded half away from zero to ``scale`` digits, as decimal(38-?, scale).

    NULL when ``den`` is 0 or NULL. Operands are integers (counts, cents) of any
    size up to 38 digits.
    """
    # decimal(38,0) rather than long: sums over very large tables stay exact
    n = num.cast(_D0)
    d = den.cast(_D0)
    q = idiv(F.abs(n) * F.lit(2 * 10 ** scale) + F.abs(d), F.lit(2) * F.abs(d))
    signed = F.when(F.signum(n) * F.signum(d) < 0, -q).otherwise(q)
    out = scaled(signed, scale)
    return F.when(d == 0, F.lit(None).cast(out_type(scale))).otherwise(out)


def out_type(scale: int) -> str:
    return f"decimal({18 + scale},{scale})"


def scaled(unscaled: Column, scale: int) -> Column:
    """Integer ``unscaled`` times 10^-scale as an exact decimal."""
    if scale == 0:
        return unscaled.cast(out_type(0))
    step = F.lit(f"0.{'0' * (scale - 1)}1").cast(f"decimal({scale + 1},{scale})")
    return (unscaled.cast(_D0) * step).cast(out_type(scale))


def cents(amount: Column) -> Column:
    """decimal(p,2) money as integer cents."""
    return (amount * 100).cast("long")
