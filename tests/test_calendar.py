"""Calendar dimension, holiday set and proximity against direct definitions."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import calendar as cal
from starforge.operators import calendar

D = dt.date


def _holidays_direct(first=2022, last=2026):
    out = {D(y, m, d) for y in range(first, last + 1) for m, d in cal.FIXED_HOLIDAYS}
    for y, m, d, n in cal.RELIGIOUS_HOLIDAYS:
        out |= {D(y, m, d) + dt.timedelta(i) for i in range(n)}
    return out


def test_default_spine_has_2922_days(spark):
    dd = calendar.dim_date(spark)
    assert dd.count() == 2922
    r = dd.agg(F.min("full_date"), F.max("full_date"), F.countDistinct("date_key")).first()
    assert tuple(r) == (D(2021, 1, 1), D(2028, 12, 31), 2922)
    row = dd.where("full_date = date'2024-03-11'").first()
    assert (row.date_key, row.quarter, row.day_of_week, row.day_name, row.is_ramadan) == (
        20240311, 1, 1, "Pazartesi", True)


def test_dim_date_matches_python_calendar(spark):
    rows = calendar.dim_date(spark, D(2023, 1, 1), D(2023, 12, 31)).collect()
    assert len(rows) == 365
    for r in rows:
        d = r.full_date
        assert r.date_key == int(d.strftime("%Y%m%d"))
        assert r.quarter == (d.month - 1) // 3 + 1
        assert r.day_name == cal.DAY_NAMES[d.weekday()]
        assert r.is_weekend == (d.weekday() >= 5)
        assert r.is_holiday == ((d.month, d.day) in set(cal.FIXED_HOLIDAYS))
        assert r.is_ramadan == any(lo <= d <= hi for lo, hi in cal.RAMADAN_RANGES)


def test_holiday_set_default_years(spark):
    got = {r.holiday for r in calendar.holiday_calendar(spark).collect()}
    assert got == _holidays_direct()


def test_holiday_set_for_data_years(spark):
    years = spark.createDataFrame([(1999,), (2023,), (2023,)], "year int")
    got = {r.holiday for r in calendar.holiday_calendar(spark, years).collect()}
    want = {D(y, m, d) for y in (1999, 2023) for m, d in cal.FIXED_HOLIDAYS}
    want |= {h for h in _holidays_direct() if h.year == 2023}
    assert got == want


def test_near_holiday_edges(spark):
    hol = spark.createDataFrame([(D(2024, 5, 19),)], "holiday date")
    days = [D(2024, 5, 19), D(2024, 5, 12), D(2024, 5, 11), D(2024, 5, 20), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date")
    got = {r.i: r.near_holiday for r in calendar.flag_near_holiday(df, "d", hol, 7).collect()}
    # the holiday itself and 7 days before count; 8 before and 1 after do not
    assert got == {0: True, 1: True, 2: False, 3: False, 4: False}


def test_near_holiday_matches_direct_scan(spark):
    hol = calendar.holiday_calendar(spark)
    hs = _holidays_direct()
    start = D(2022, 1, 1)
    days = [start + dt.timedelta(i) for i in range(0, 5 * 365, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.near_holiday for r in calendar.flag_near_holiday(df, "d", hol, 7).collect()}
    for d in days:
        assert got[d] == any(0 <= (h - d).days <= 7 for h in hs), d


def test_near_holiday_has_no_nested_loop(spark):
    hol = calendar.holiday_calendar(spark)
    df = spark.range(1000).select(F.date_add(F.lit(D(2022, 1, 1)), F.col("id").cast("int")).alias("d"))
    plan = calendar.flag_near_holiday(df, "d", hol, 7)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_dim_date_covering_span(spark):
    a = spark.createDataFrame([(D(2020, 2, 27), None), (D(2020, 3, 1), D(2020, 2, 25))], "x date, y date")
    b = spark.createDataFrame([(D(2020, 3, 2),)], "z date")
    dd = calendar.dim_date_covering((a, ["x", "y"]), (b, "z"))
    r = dd.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert tuple(r) == (D(2020, 2, 25), D(2020, 3, 2), 7)
