"""Fact loads: joins, first-wins, the paid-before-draw running count against brute force."""

import datetime as dt
import random
from decimal import Decimal

from starforge import schemas
from starforge.operators import dims, facts, scd2

D = dt.date


def _members(spark, ids):
    rows = [(m, m, f"h{m}", "c", "d", 1980, D(1980, 1, 1), Decimal("1.00"), D(2020, 1, 15), "aktif",
             None, None) for m in ids]
    return spark.createDataFrame(rows, schemas.STAGING_MEMBERS)


def _plans(spark):
    return spark.createDataFrame([("P1", "plan", "konut", 12, Decimal("1200.00"), None)],
                                 schemas.STAGING_PLANS)


def _payments(spark, rows):
    full = [(pid, "S1", m, plan, 1, due, paid, Decimal("10.00"), Decimal("10.00"), st)
            for pid, m, plan, due, paid, st in rows]
    return spark.createDataFrame(full, schemas.STAGING_PAYMENTS)


def _lottery(spark, rows):
    return spark.createDataFrame([(lid, m, "P1", None, d, 1, False) for lid, m, d in rows],
                                 schemas.STAGING_LOTTERY)


def test_paid_before_edges(spark):
    dm = dims.dim_member_full(_members(spark, ["A", "B"]), D(2021, 1, 1))
    dp = dims.dim_plan(_plans(spark))
    pays = _payments(spark, [
        ("p1", "A", "P1", D(2020, 2, 1), D(2020, 2, 1), "odendi"),
        ("p2", "A", "P1", D(2020, 3, 1), D(2020, 3, 1), "gecikmeli"),    # due on draw date: counts
        ("p3", "A", "P1", D(2020, 3, 1), None, "odenmedi"),              # unpaid: never counts
        ("p4", "A", "P9", D(2020, 1, 20), D(2020, 1, 20), "kismi"),      # other plan: counts
        ("p5", "A", "P1", None, None, "odendi"),                         # no due date: ignored
        ("p6", "A", "P1", D(2020, 3, 2), D(2020, 3, 2), "odendi"),       # after the draw
    ])
    lot = _lottery(spark, [("L1", "A", D(2020, 3, 1)), ("L2", "B", D(2020, 3, 1)),
                           ("L3", "A", None), ("L4", "A", D(2020, 3, 1))])
    got = {r.lottery_id: (r.paid_before_lottery, r.months_elapsed, r.cumulative_paid_ratio)
           for r in facts.fact_lottery(lot, pays, dm, dp).collect()}
    # signup 2020-01-15 -> draw 2020-03-01: 1 full month + part -> 2 months
    assert got["L1"] == (3, 2, Decimal("1.0000"))
    assert got["L4"] == got["L1"]
    assert got["L2"] == (0, 2, Decimal("0.0000"))
    assert got["L3"] == (0, 1, Decimal("0.0000"))  # NULL draw date: 0 paid, 1 month


def test_paid_before_matches_brute_force_with_hot_member(spark):
    rnd = random.Random(3)
    ids = ["HOT"] + [f"M{i}" for i in range(20)]
    st = ["odendi", "kismi", "gecikmeli", "odenmedi"]
    base = D(2019, 1, 1)
    pay_rows = []
    for i in range(6000):
        m = "HOT" if i % 3 == 0 else rnd.choice(ids)  # a third of all rows on one member
        due = base + dt.timedelta(rnd.randint(0, 700))
        pay_rows.append((f"p{i}", m, "P1", due, due, rnd.choice(st)))
    lot_rows = []
    for i in range(1500):
        m = "HOT" if i % 3 == 0 else rnd.choice(ids)
        lot_rows.append((f"L{i}", m, base + dt.timedelta(rnd.randint(0, 800))))
    pays, lot = _payments(spark, pay_rows), _lottery(spark, lot_rows)
    dm = dims.dim_member_full(_members(spark, ids), D(2021, 1, 1))
    dp = dims.dim_plan(_plans(spark))
    got = {r.lottery_id: r.paid_before_lottery for r in facts.fact_lottery(lot, pays, dm, dp).collect()}
    paid = [(m, due) for _, m, _, due, _, s in pay_rows if s in ("odendi", "kismi", "gecikmeli")]
    for lid, m, d in lot_rows:
        assert got[lid] == sum(1 for pm, pd in paid if pm == m and pd <= d), lid


def test_fact_payments_first_wins_after_joins(spark):
    dm = dims.dim_member_full(_members(spark, ["A"]), D(2021, 1, 1))
    dp = dims.dim_plan(_plans(spark))
    pays = _payments(spark, [
        ("X", "ZZ", "P1", D(2020, 1, 1), D(2020, 1, 1), "odendi"),   # unknown member: cannot win
        ("X", "A", "P1", D(2020, 1, 5), D(2020, 1, 9), "odendi"),
        ("X", "A", "P1", D(2020, 1, 5), None, "odenmedi"),           # NULL paid first on a tie
        ("Y", "A", "P1", D(2020, 2, 1), D(2020, 2, 3), "gecikmeli"),
        (None, "A", "P1", D(2020, 2, 1), D(2020, 2, 3), "odendi"),   # NULL id dropped
    ])
    got = {r.payment_id: (r.date_key, r.days_late, r.payment_status)
           for r in facts.fact_payments(pays, dm, dp).collect()}
    assert got == {"X": (20200105, 0, "odenmedi"), "Y": (20200203, 2, "gecikmeli")}


def test_fact_joins_fan_out_on_plan_variants(spark):
    """A plan_id with two DISTINCT variants yields two dim rows: the fact fans out
    before insert-ignore, which then keeps one row per payment."""
    plans = spark.createDataFrame([("P1", "a", "konut", 12, Decimal("1200.00"), None),
                                   ("P1", "b", "konut", 12, Decimal("1200.00"), None)],
                                  schemas.STAGING_PLANS)
    dm = dims.dim_member_full(_members(spark, ["A"]), D(2021, 1, 1))
    dp = dims.dim_plan(plans)
    pays = _payments(spark, [("X", "A", "P1", D(2020, 1, 5), D(2020, 1, 9), "odendi")])
    assert facts.payment_rows(pays, dm, dp).count() == 2
    assert facts.fact_payments(pays, dm, dp).count() == 1


def test_dim_plan_distinct_and_installment(spark):
    plans = spark.createDataFrame([("P1", "a", "konut", 48, Decimal("3000000.00"), None),
                                   ("P1", "a", "konut", 48, Decimal("3000000.00"), Decimal("1.00")),
                                   ("P2", "b", "arac", 0, Decimal("10.00"), None)],
                                  schemas.STAGING_PLANS)
    got = {r.plan_id: r.monthly_installment for r in dims.dim_plan(plans).collect()}
    assert got == {"P1": Decimal("62500.00"), "P2": Decimal("0.00")}


def test_current_members_only(spark):
    m1 = _members(spark, ["A"])
    d1 = scd2.scd2_apply(scd2.empty_dim_member(spark), m1, D(2021, 1, 1))
    m2 = m1.withColumn("status", m1.status.substr(1, 0))  # '' -> status change
    d2 = scd2.scd2_apply(d1, m2, D(2021, 1, 2))
    assert d2.count() == 2
    pays = _payments(spark, [("X", "A", "P1", D(2020, 1, 5), D(2020, 1, 9), "odendi")])
    fp = facts.fact_payments(pays, d2, dims.dim_plan(_plans(spark)))
    assert fp.count() == 1  # joins the current version only, no fan-out


def test_dimensions_are_broadcast_only_under_the_threshold(spark):
    dm = dims.dim_member_full(_members(spark, [f"M{i}" for i in range(10)]), D(2021, 1, 1))
    pays = _payments(spark, [("X", "M1", "P1", D(2020, 1, 5), D(2020, 1, 9), "odendi")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plain = facts.payment_rows(pays, dm, dims.dim_plan(_plans(spark)))
        assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_rows_held_against_parents_once_give_fact_and_rejects(spark):
    """One pass over the parents, with two variants of a plan, no day, and NULL ids."""
    from pyspark.sql import functions as F

    from starforge.operators import foreign_keys
    rows = spark.createDataFrame(
        [("a", "m1", "p1", 20200101), ("b", "m9", "p1", 20200101), ("c", "m1", "p9", 20200101), ("d", "m1", "p2", 19000101),
         ("e", "m1", "p2", None), ("f", None, "p1", 20200101), ("a", "m1", "p1", 20200101), (None, "m1", "p9", 20200101)],
        "payment_id string, member_id string, plan_id string, day int")
    rows = rows.select("payment_id", "member_id", "plan_id", F.to_date(F.col("day").cast("string"), "yyyyMMdd").alias("due_date"))
    dm = spark.createDataFrame([("m1", 1, True), ("m9", 2, False), (None, 3, True)], "member_id string, member_key long, is_current boolean")
    dp = spark.createDataFrame([("p1", 10), ("p2", 20), ("p2", 21), (None, 30)], "plan_id string, plan_key long")
    dd = spark.createDataFrame([(20200101,)], "date_key int")
    held = foreign_keys.held_against(rows, F.col("due_date"), dm, dp, dd)
    want = foreign_keys.rejected_rows(rows, F.col("due_date"), dm, dp, dd)
    got = foreign_keys.rejected(held, rows.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 5
    taken = foreign_keys.taken(held)
    assert sorted((r.payment_id, r.plan_key) for r in taken.collect()) == [("a", 10), ("a", 10), ("e", 20), ("e", 21)]
    assert held.where(foreign_keys.joined()).count() == 6  # as the inner joins count them, whatever the day
