"""Randomised checks of the column rules against plain-Python statements of the
same rules (many inputs per Spark job)."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from starforge.functions import rules

AS_OF = dt.date(2024, 7, 15)
RND = random.Random(11)


def _py_bands(v, bands):
    for lo, hi, label in bands:
        if lo <= v <= hi:
            return label
    return rules.UNKNOWN


def test_income_bracket_random(spark):
    vals = [None, Decimal("0")] + [Decimal(RND.randint(-100000, 1100000000)) / 100 for _ in range(3000)]
    vals += [Decimal(b) + d for b in (20000, 50000, 100000, 200000, 9999999)
             for d in (Decimal("-0.01"), 0, Decimal("0.01"), Decimal("0.5"), 1)]
    df = spark.createDataFrame([(v,) for v in vals], "v decimal(12,2)")
    got = [r[0] for r in df.select(rules.income_bracket("v")).collect()]
    assert got == [_py_bands(v if v else 0, rules.INCOME_BRACKETS) for v in vals]


def test_age_group_random(spark):
    vals = [None, 0] + [RND.randint(1800, 2030) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    got = [r[0] for r in df.select(rules.age_group("v", AS_OF)).collect()]
    assert got == [_py_bands(AS_OF.year - (v or 1980), rules.AGE_GROUPS) for v in vals]


def test_capped_ratio_random(spark):
    pairs = [(RND.randint(0, 500), RND.randint(1, 240)) for _ in range(3000)]
    df = spark.createDataFrame(pairs, "p long, m int")
    got = [r[0] for r in df.select(rules.capped_ratio("p", "m")).collect()]
    q = Decimal("0.0001")
    want = [min((Decimal(p) / Decimal(m)).quantize(q, ROUND_HALF_UP), Decimal("1.0000"))
            for p, m in pairs]
    assert got == want


def test_monthly_installment_random(spark):
    rows = [(Decimal(RND.randint(0, 10 ** 12)) / 100, RND.choice([0, None] + list(range(1, 241))))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "t decimal(15,2), d int")
    got = [r[0] for r in df.select(rules.monthly_installment("t", "d")).collect()]
    want = [(t / d).quantize(Decimal("0.01"), ROUND_HALF_UP) if d else Decimal("0.00")
            for t, d in rows]
    assert got == want


def test_days_late_and_status_random(spark):
    base = dt.date(2020, 1, 1)
    rows = []
    for _ in range(2000):
        due = None if RND.random() < 0.05 else base + dt.timedelta(RND.randint(0, 900))
        paid = None if RND.random() < 0.2 else base + dt.timedelta(RND.randint(0, 900))
        rows.append((due, paid))
    df = spark.createDataFrame(rows, "due date, paid date")
    late = rules.days_late("due", "paid")
    got = [tuple(r) for r in df.select(late, rules.derived_payment_status("paid", late)).collect()]

    def py(due, paid):
        dl = max(0, (paid - due).days) if (paid and due) else 0
        st = "odenmedi" if paid is None else ("gecikmeli" if dl > 0 else "zamaninda")
        return dl, st
    assert got == [py(d, p) for d, p in rows]


def test_age_years_random(spark):
    base = dt.date(1950, 1, 1)
    births = [base + dt.timedelta(RND.randint(0, 27000)) for _ in range(2000)] + [dt.date(2004, 2, 29)]
    as_of = dt.date(2022, 2, 28)
    df = spark.createDataFrame([(b,) for b in births], "b date")
    got = [r[0] for r in df.select(rules.age_years("b", as_of)).collect()]
    want = [as_of.year - b.year - ((as_of.month, as_of.day) < (b.month, b.day)) for b in births]
    assert got == want
