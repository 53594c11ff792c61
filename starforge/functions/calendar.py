"""Calendar column expressions (date key, parts, day names, holidays, Ramadan).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values of the reference calendar (must stay as written) ----
# Turkish day names, Monday first.
DAY_NAMES = ["Pazartesi", "Sali", "Carsamba", "Persembe", "Cuma", "Cumartesi", "Pazar"]
# Fixed public holidays as (month, day).
FIXED_HOLIDAYS = [(1, 1), (4, 23), (5, 1), (5, 19), (7, 15), (8, 30), (10, 29)]
# Ramadan periods, inclusive (start, end).
RAMADAN_RANGES = [
    (dt.date(2022, 4, 2), dt.date(2022, 5, 1)),
    (dt.date(2023, 3, 23), dt.date(2023, 4, 20)),
    (dt.date(2024, 3, 11), dt.date(2024, 4, 9)),
    (dt.date(2025, 3, 1), dt.date(2025, 3, 29)),
    (dt.date(2026, 2, 18), dt.date(2026, 3, 19)),
]
# Religious holidays as (year, month, first day, number of days).
RELIGIOUS_HOLIDAYS = [
    (2022, 5, 2, 3), (2023, 4, 21, 3), (2024, 4, 10, 3),
    (2025, 3, 30, 3), (2026, 3, 20, 3),
    (2022, 7, 9, 4), (2023, 6, 28, 4), (2024, 6, 16, 4),
    (2025, 6, 6, 4), (2026, 5, 27, 4),
]
# Default span of the calendar dimension and of the holiday years.
DEFAULT_SPINE = (dt.date(2021, 1, 1), dt.date(2028, 12, 31))
DEFAULT_HOLIDAY_YEARS = (2022, 2026)
# ----------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """yyyymmdd as int, computed arithmetically (no string round trip)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def quarter(d) -> Column:
    return F.quarter(_c(d)).cast("int")


def day_of_week(d) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_c(d)) + 1).cast("int")


def day_name(d) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.weekday(_c(d)) + 1)


def is_weekend(d) -> Column:
    return F.weekday(_c(d)) >= 5


def is_holiday(d, holidays=FIXED_HOLIDAYS) -> Column:
    d = _c(d)
    md = F.month(d) * 100 + F.dayofmonth(d)
    return md.isin([m * 100 + day for m, day in holidays])


def is_ramadan(d, ranges=RAMADAN_RANGES) -> Column:
    """Inclusive membership in any of the ranges (OR of BETWEEN, no join)."""
    d = _c(d)
    cond = F.lit(False)
    for lo, hi in ranges:
        cond = cond | d.between(F.lit(lo), F.lit(hi))
    return cond
