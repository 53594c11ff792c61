"""Business rules as Column expressions (the per-row transforms of the reference).

Each function returns a built-in Spark expression; no Python UDF is involved.
"today" is always the explicit ``as_of`` date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from starforge.functions.exact import idiv, scaled

# ---- fixed values of the reference rules (must stay as written) ----
# Age bands: inclusive (low, high, label); anything else is UNKNOWN.
AGE_GROUPS = [(18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45"),
              (46, 55, "46-55"), (56, 200, "56+")]
# Income brackets: inclusive (low, high, label); the gaps between them are UNKNOWN.
INCOME_BRACKETS = [(0, 20000, "Dusuk"), (20001, 50000, "Orta-Alt"), (50001, 100000, "Orta"),
                   (100001, 200000, "Orta-Ust"), (200001, 9999999, "Yuksek")]
UNKNOWN = "Bilinmiyor"
DEFAULT_BIRTH_YEAR = 1980
CHURN_STATUS = "terk"
PAID_STATUSES = ["odendi", "kismi", "gecikmeli"]
MEMBER_STATUSES = ["aktif", "gecikmeli", "pasif", "terk"]
PAYMENT_STATUSES = ["odendi", "gecikmeli", "kismi", "odenmedi"]
PLAN_TYPES = ["konut", "arsa", "ticari", "arac", "isyeri"]
DERIVED_UNPAID, DERIVED_LATE, DERIVED_ON_TIME = "odenmedi", "gecikmeli", "zamaninda"
# Income tiers and lateness surcharge used to weight payment outcomes.
INCOME_TIER_BOUNDS = [(100000, "high"), (50000, "mid")]
INCOME_TIER_LOW = "low"
LATE_SURCHARGE = [(30000, 15), (50000, 8)]
# Seasonal and holiday risk boosts.
SEASONAL_MONTHS = [1, 7]
SEASONAL_BOOST = 5
HOLIDAY_BOOST = 10
# ----------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def _bands(value: Column, bands) -> Column:
    out = None
    for lo, hi, label in bands:
        cond = (value >= lo) & (value <= hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(UNKNOWN)


def age_group(birth_year, as_of) -> Column:
    """Year difference only; NULL and 0 birth years count as 1980."""
    by = F.coalesce(F.nullif(_c(birth_year), F.lit(0)), F.lit(DEFAULT_BIRTH_YEAR))
    age = F.year(_lit_date(as_of)) - by
    return _bands(age, AGE_GROUPS)


def income_bracket(income) -> Column:
    """R2: NULL counts as 0; the gaps between brackets stay UNKNOWN."""
    v = F.coalesce(_c(income), F.lit(0))
    return _bands(v, INCOME_BRACKETS)


def days_late(due, paid) -> Column:
    """max(0, paid - due) in days, 0 when either date is missing."""
    return F.greatest(F.lit(0), F.coalesce(F.datediff(_c(paid), _c(due)), F.lit(0))).cast("int")


def derived_payment_status(paid, late) -> Column:
    """Unpaid / late / on time."""
    return (F.when(_c(paid).isNull(), DERIVED_UNPAID)
            .when(_c(late) > 0, DERIVED_LATE)
            .otherwise(DERIVED_ON_TIME))


def monthly_installment(target, duration) -> Column:
    """Target / duration rounded half-up to cents; 0 when duration is 0 or NULL."""
    d = _c(duration).cast("long")
    c = (_c(target) * 100).cast("long")
    q = idiv(F.abs(c) * 2 + F.abs(d), F.abs(d) * 2)
    signed = F.when(F.signum(c) * F.signum(d) < 0, -q).otherwise(q)
    return F.when(F.coalesce(d, F.lit(0)) == 0, F.lit(0).cast("decimal(12,2)")) \
        .otherwise(scaled(signed, 2).cast("decimal(12,2)"))


def churn_date(status, as_of) -> Column:
    return F.when(_c(status) == CHURN_STATUS, _lit_date(as_of)).cast("date")


def add_months(d, n) -> Column:
    return F.add_months(_c(d), _c(n))


def months_elapsed(start, end) -> Column:
    """Calendar months from start to end, +1 for a started month, at least 1.

    Equal to years*12 + months + (days > 0) of a relative delta; NULL input -> 1.
    """
    s, e = _c(start), _c(end)
    mm = (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))
    bump = F.when(F.add_months(s, mm) < e, 1).otherwise(0)
    return F.coalesce(F.greatest(F.lit(1), mm + bump), F.lit(1)).cast("int")


def capped_ratio(paid_count, months) -> Column:
    """min(round(paid / months, 4), 1) as decimal(5,4), half-up on the exact ratio."""
    p = _c(paid_count).cast("long")
    m = _c(months).cast("long")
    # least() skips NULLs, so a missing input must stay NULL explicitly
    q = F.when(p.isNotNull() & m.isNotNull(),
               F.least(F.lit(10000).cast("long"), idiv(p * 20000 + m, m * 2)))
    return scaled(q, 4).cast("decimal(5,4)")


def age_years(birth, as_of) -> Column:
    """Full years between birth and as_of (field-wise, like AGE())."""
    a, b = _lit_date(as_of), _c(birth)
    before = (F.month(a) * 100 + F.dayofmonth(a)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(a) - F.year(b) - F.when(before, 1).otherwise(0)).cast("int")


def pseudonymise(value) -> Column:
    """SHA-256 hex of the UTF-8 text."""
    return F.sha2(_c(value).cast("string"), 256)


def format_business_id(prefix: str, width: int, n) -> Column:
    """Zero-padded id such as M00042; longer numbers are not truncated."""
    v = _c(n).cast("long")
    return F.when(v.isNotNull(), F.format_string(f"{prefix}%0{width}d", v))


def income_tier(income) -> Column:
    """Value tier that picks the draw weights."""
    v = _c(income)
    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for lo, label in INCOME_TIER_BOUNDS:
        out = out.when(v >= lo, label)
    return out.otherwise(INCOME_TIER_LOW)


def late_surcharge(income) -> Column:
    """Lateness surcharge by income (15 / 8 / 0)."""
    v = _c(income)
    out = F.when(v.isNull(), F.lit(None).cast("int"))
    for hi, extra in LATE_SURCHARGE:
        out = out.when(v < hi, extra)
    return out.otherwise(0).cast("int")


def seasonal_boost(d) -> Column:
    """R18 first half: +5 in January and July."""
    return F.when(F.month(_c(d)).isin(SEASONAL_MONTHS), SEASONAL_BOOST).otherwise(0).cast("int")
