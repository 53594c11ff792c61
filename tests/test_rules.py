"""Hand-made rows for the edges of every scalar rule."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starforge.functions import calendar as cal
from starforge.functions import rules

AS_OF = dt.date(2022, 6, 1)
D = dt.date


def one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_age_group_edges(spark):
    y = AS_OF.year
    rows = [(None,), (0,), (y - 17,), (y - 18,), (y - 25,), (y - 26,), (y - 55,), (y - 56,),
            (y - 200,), (y - 201,)]
    got = one(spark, rows, "by int", rules.age_group("by", AS_OF))
    # NULL and 0 count as 1980 -> 42 years -> 36-45
    assert got == ["36-45", "36-45", "Bilinmiyor", "18-25", "18-25", "26-35", "46-55", "56+",
                   "56+", "Bilinmiyor"]


def test_income_bracket_gaps(spark):
    vals = [None, "0", "-1", "20000", "20000.50", "20001", "50000", "50001", "200000.5",
            "9999999", "10000000"]
    rows = [(None if v is None else Decimal(v),) for v in vals]
    got = one(spark, rows, "v decimal(12,2)", rules.income_bracket("v"))
    assert got == ["Dusuk", "Dusuk", "Bilinmiyor", "Dusuk", "Bilinmiyor", "Orta-Alt", "Orta-Alt",
                   "Orta", "Bilinmiyor", "Yuksek", "Bilinmiyor"]


def test_days_late_and_status(spark):
    rows = [(D(2022, 1, 10), D(2022, 1, 5)),   # early
            (D(2022, 1, 10), D(2022, 1, 10)),  # on the day
            (D(2022, 1, 10), D(2022, 1, 13)),  # late
            (D(2022, 1, 10), None),            # unpaid
            (None, D(2022, 1, 13))]            # no due date, paid
    df = spark.createDataFrame(rows, "due date, paid date")
    late = rules.days_late("due", "paid")
    got = df.select(late.alias("l"), rules.derived_payment_status("paid", late).alias("s")).collect()
    assert [(r.l, r.s) for r in got] == [(0, "zamaninda"), (0, "zamaninda"), (3, "gecikmeli"),
                                         (0, "odenmedi"), (0, "zamaninda")]


def test_monthly_installment(spark):
    rows = [(Decimal("3000000"), 48), (Decimal("5000000"), 120), (Decimal("1500000"), 60),
            (Decimal("8000000"), 48), (Decimal("10000000"), 240), (Decimal("100"), 0),
            (Decimal("100"), None), (Decimal("100"), 1), (Decimal("0.05"), 2)]
    got = one(spark, rows, "t decimal(15,2), d int", rules.monthly_installment("t", "d"))
    assert got == [Decimal("62500.00"), Decimal("41666.67"), Decimal("25000.00"),
                   Decimal("166666.67"), Decimal("41666.67"), Decimal("0.00"), Decimal("0.00"),
                   Decimal("100.00"), Decimal("0.03")]  # 0.025 -> half up


def _relativedelta_months(s, e):
    """Reference semantics: years*12 + months + (days > 0), at least 1."""
    if s is None or e is None:
        return 1
    sign = 1 if e >= s else -1
    m = (e.year - s.year) * 12 + (e.month - s.month)

    def add(d, k):
        y, mo = divmod(d.month - 1 + k, 12)
        y += d.year
        mo += 1
        import calendar
        return dt.date(y, mo, min(d.day, calendar.monthrange(y, mo)[1]))
    if sign > 0:
        while add(s, m) > e:
            m -= 1
        days = (e - add(s, m)).days
    else:
        while add(s, m) < e:
            m += 1
        days = (e - add(s, m)).days
    return max(1, m + (1 if days > 0 else 0))


def test_months_elapsed_edges(spark):
    rows = [(D(2020, 1, 31), D(2020, 2, 29)), (D(2020, 2, 29), D(2020, 3, 31)),
            (D(2021, 5, 5), D(2021, 5, 5)), (D(2021, 5, 5), D(2021, 3, 1)),
            (None, D(2021, 3, 1)), (D(2020, 1, 31), D(2020, 3, 1)), (D(2019, 12, 15), D(2021, 1, 14))]
    got = one(spark, rows, "s date, e date", rules.months_elapsed("s", "e"))
    assert got == [_relativedelta_months(s, e) for s, e in rows]


def test_months_elapsed_random_pairs(spark):
    import random
    rnd = random.Random(7)
    base = D(2018, 1, 1)
    rows = [(base + dt.timedelta(rnd.randint(0, 1500)), base + dt.timedelta(rnd.randint(0, 2500)))
            for _ in range(3000)]
    got = one(spark, rows, "s date, e date", rules.months_elapsed("s", "e"))
    assert got == [_relativedelta_months(s, e) for s, e in rows]


def test_capped_ratio_half_up_and_cap(spark):
    rows = [(1, 3), (2, 3), (1, 8), (5, 4), (0, 1), (1, 16), (None, 3), (3, None)]
    got = one(spark, rows, "p long, m int", rules.capped_ratio("p", "m"))
    assert got == [Decimal("0.3333"), Decimal("0.6667"), Decimal("0.1250"), Decimal("1.0000"),
                   Decimal("0.0000"), Decimal("0.0625"), None, None]


def test_age_years_leap_birthday(spark):
    got = one(spark, [(D(2004, 2, 29),), (D(2004, 2, 28),)], "b date",
              rules.age_years("b", D(2022, 2, 28)))
    assert got == [17, 18]


def test_pseudonymise_and_format(spark):
    import hashlib
    got = one(spark, [("12345678901",)], "v string", rules.pseudonymise("v"))
    assert got == [hashlib.sha256(b"12345678901").hexdigest()]
    got = one(spark, [(7,), (123456,), (None,)], "n long", rules.format_business_id("M", 5, "n"))
    assert got == ["M00007", "M123456", None]  # longer numbers are not truncated


def test_income_tier_and_surcharge(spark):
    rows = [(Decimal(v),) for v in ("10000", "30000", "49999.99", "50000", "99999", "100000")]
    df = spark.createDataFrame(rows + [(None,)], "v decimal(12,2)")
    got = df.select(rules.income_tier("v"), rules.late_surcharge("v")).collect()
    assert [tuple(r) for r in got] == [("low", 15), ("low", 8), ("low", 8), ("mid", 0),
                                       ("mid", 0), ("high", 0), (None, None)]


def test_calendar_parts(spark):
    days = [D(2024, 1, 1), D(2024, 4, 23), D(2024, 3, 16), D(2024, 3, 17), D(2023, 3, 22),
            D(2023, 3, 23), D(2023, 4, 20), D(2023, 4, 21)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(cal.date_key("d"), cal.quarter("d"), cal.day_of_week("d"), cal.day_name("d"),
                    cal.is_weekend("d"), cal.is_holiday("d"), cal.is_ramadan("d")).collect()
    assert [tuple(r) for r in got] == [
        (20240101, 1, 1, "Pazartesi", False, True, False),
        (20240423, 2, 2, "Sali", False, True, False),
        (20240316, 1, 6, "Cumartesi", True, False, True),
        (20240317, 1, 7, "Pazar", True, False, True),
        (20230322, 1, 3, "Carsamba", False, False, False),
        (20230323, 1, 4, "Persembe", False, False, True),
        (20230420, 2, 4, "Persembe", False, False, True),
        (20230421, 2, 5, "Cuma", False, False, False),
    ]


def test_seasonal_boost(spark):
    got = one(spark, [(D(2022, 1, 3),), (D(2022, 7, 9),), (D(2022, 2, 1),)], "d date",
              rules.seasonal_boost("d"))
    assert got == [5, 5, 0]


def test_rules_stay_in_codegen(spark):
    """No Python UDF anywhere in a rule expression."""
    df = spark.createDataFrame([(1990, Decimal("1"), D(2020, 1, 1), D(2020, 2, 1))],
                               "by int, inc decimal(12,2), s date, e date")
    out = df.select(rules.age_group("by", AS_OF), rules.income_bracket("inc"),
                    rules.months_elapsed("s", "e"), rules.capped_ratio(F.lit(3), F.lit(7)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_installment_schedule_edges(spark):
    from starforge.operators.schedule import installment_schedule
    df = spark.createDataFrame(
        [("a", D(2020, 1, 31), 3), ("b", D(2020, 1, 31), 0), ("c", D(2020, 1, 31), None),
         ("d", D(2022, 1, 1), 5), ("e", D(2021, 12, 31), 3), ("f", D(2021, 12, 15), 240),
         ("g", D(2022, 3, 1), 12), ("h", None, 12), ("i", D(2021, 6, 30), 1)],
        "k string, s date, n int")
    got = sorted((r.k, r.installment_no, r.due_date)
                 for r in installment_schedule(df, "k", "s", "n", D(2022, 1, 15)).collect())
    assert got == [("a", 1, D(2020, 1, 31)), ("a", 2, D(2020, 2, 29)), ("a", 3, D(2020, 3, 31)),
                   ("d", 1, D(2022, 1, 1)), ("e", 1, D(2021, 12, 31)),
                   ("f", 1, D(2021, 12, 15)), ("f", 2, D(2022, 1, 15)), ("i", 1, D(2021, 6, 30))]


def test_long_keys_keep_their_digits(spark):
    from starforge.sources.adapter import member_id_of, plan_id_of
    df = spark.createDataFrame([(1234567, 123456789), (123456, 12345678), (None, None)], "p long, m long")
    got = [tuple(r) for r in df.select(plan_id_of(df["p"]), member_id_of(df["m"])).collect()]
    assert got == [("P1234567", "M123456789"), ("P123456", "M12345678"), (None, None)]


def test_plan_keys_keep_the_place_of_nulls(spark):
    from starforge.operators.dims import dim_plan
    df = spark.createDataFrame([("P1", None, "konut", 12, None), ("P1", "konut", None, 12, None)],
                               "plan_id string, plan_name string, plan_type string, duration_months int, target_amount decimal(15,2)")
    assert dim_plan(df).select("plan_key").distinct().count() == 2


def test_full_refresh_keeps_every_clean_row(spark):
    import datetime as dt
    from starforge.operators.dims import MEMBER_SOURCE_COLUMNS, dim_member_full
    row = lambda member, tc: (member, "n", tc, "c", "d", 1980, None, dt.date(2020, 1, 1), "aktif")
    types = dict(zip(MEMBER_SOURCE_COLUMNS, ["string"] * 5 + ["int", "decimal(12,2)", "date", "string"]))
    df = spark.createDataFrame([row("M1", "a"), row("M1", "b"), row(None, "c"), row(None, "d")], ", ".join(f"{k} {v}" for k, v in types.items()))
    out = dim_member_full(df, dt.date(2024, 1, 1))
    assert out.count() == 4 and out.select("member_key").distinct().count() == 4


def test_run_ids_sort_by_number():
    from starforge.sources.snapshots import run_order
    assert run_order("d9") < run_order("d9-000000001") < run_order("d10") and run_order("2026-09-30") < run_order("2026-12-02")
