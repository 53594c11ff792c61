"""DQ rules, constraint checks and fault injection: each injected fault raises the
matching rule's count by the number of rows it touched."""

import datetime as dt
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from starforge.operators import dims, inject, profile, quality
from starforge.sources.adapter import AS_OF, staging_from_driver

SF = "/root/testdata/sf0.001"


def _report(spark, st):
    rep = quality.dq_report(st, dims.dim_member_full(st.members, AS_OF), AS_OF)
    return {r.rule: r for r in rep.collect()}


def test_report_has_every_rule_and_verdicts(spark):
    st = staging_from_driver(spark, SF)
    rep = _report(spark, st)
    assert list(rep) and set(rep) == set(quality.REPORT_ORDER)
    for r in rep.values():
        assert r.status == ("PASS" if r.n <= r.threshold else "FAIL")
        assert r.detail == ("Temiz" if r.n == 0 else f"{r.n} sorunlu satır")
    # the standalone rules agree with the single-pass report
    for name in ("Invalid plan_type", "Underage members", "NULL payment fields"):
        assert quality.row_rule(st, name, AS_OF).first().n == rep[name].n


class _St:
    def __init__(self, st, **over):
        for k in ("members", "plans", "subscriptions", "payments", "lottery"):
            setattr(self, k, over.get(k, getattr(st, k)))


def test_injected_nulls_raise_q1(spark):
    st = staging_from_driver(spark, SF)
    before = _report(spark, st)["NULL zorunlu alan (members)"].n
    dirty = inject.inject_nulls(st.members, "member_id", "tc_hash", 0.2, 42)
    q1 = quality.ROW_RULES[0].predicate(AS_OF)
    touched = st.members.where(~q1 & inject.in_sample("member_id", 0.2, 42, "n")).count()
    assert touched > 0
    after = _report(spark, _St(st, members=dirty))["NULL zorunlu alan (members)"].n
    assert after == before + touched


def test_injected_duplicates_raise_q2(spark):
    st = staging_from_driver(spark, SF)
    before = _report(spark, st)["Duplicate member_id"].n
    dirty = inject.inject_duplicates(st.members, "member_id", 0.1, 42)
    dup_keys = st.members.where(inject.in_sample("member_id", 0.1, 42, "d"))
    already = st.members.groupBy("member_id").count().where("count > 1").select("member_id")
    fresh = dup_keys.select("member_id").distinct().join(already, "member_id", "left_anti").count()
    assert fresh > 0
    assert _report(spark, _St(st, members=dirty))["Duplicate member_id"].n == before + fresh


def test_injected_negative_amounts_seen_by_profile_not_by_q8(spark):
    st = staging_from_driver(spark, SF)
    dirty = inject.inject_negative(st.payments, "payment_id", "paid_amount", 0.05, 42)
    hit = st.payments.where(inject.in_sample("payment_id", 0.05, 42, "g") & (F.col("paid_amount") >= 0)).count()
    before = profile.negative_payments(st.payments).first().n_negative
    assert profile.negative_payments(dirty).first().n_negative == before + hit
    vals = [r.paid_amount for r in dirty.where(inject.in_sample("payment_id", 0.05, 42, "g")).collect()]
    assert vals and all(Decimal("-9999.00") <= v <= Decimal("-1.00") for v in vals)
    # Q8 tests the due amount, so it does not see these (as in the reference)
    assert (_report(spark, _St(st, payments=dirty))["Negative payment"].n
            == _report(spark, st)["Negative payment"].n)


def test_injected_bad_dates(spark):
    st = staging_from_driver(spark, SF)
    dirty = inject.inject_bad_dates(st.payments, "payment_id", "paid_date", "due_date", 0.05, 42)
    hit = dirty.where(inject.in_sample("payment_id", 0.05, 42, "t") & F.col("paid_date").isNotNull())
    diffs = [r[0] for r in hit.select(F.datediff("due_date", "paid_date")).collect()]
    assert diffs and all(1 <= d <= 10 for d in diffs)


def test_hash_sample_is_deterministic_and_near_fraction(spark):
    st = staging_from_driver(spark, "/root/testdata/sf0.01")
    a = inject.hash_sample(st.payments, "payment_id", 0.1, 42)
    n, total = a.count(), st.payments.count()
    assert abs(n / total - 0.1) < 0.02
    assert a.select("payment_id").exceptAll(inject.hash_sample(st.payments, "payment_id", 0.1, 42)
                                            .select("payment_id")).count() == 0


def test_constraint_checks_fire(spark):
    df = spark.createDataFrame(
        [("a", "x" * 25, 1e13), (None, "ok", 1.0), ("a", "ok", 2.0), ("b", None, None)],
        "k string, s string, v double")
    kv = quality.key_violations(df, "t", ["k"]).first()
    assert (kv.n_null_keys, kv.n_duplicate_groups, kv.n_duplicate_rows) == (1, 1, 1)
    bv = {(r.column_name, r.bound): r.n for r in
          quality.bound_violations(df, "t", {"s": 20}, {"v": (12, 2)}).collect()}
    assert bv == {("s", "varchar(20)"): 1, ("v", "numeric(12,2)"): 1}
    nv = {r.column_name: r.n for r in quality.null_violations(df, "t", ["k", "s"]).collect()}
    assert nv == {"k": 1, "s": 1}
    parent = spark.createDataFrame([("a",)], "k string")
    fk = quality.fk_violations(df, "t", "k", parent, "p", "k").first()
    assert fk.n == 1  # 'b' is an orphan; NULL passes


def test_bounds_are_checked_on_the_files_as_delivered(spark):
    from starforge import schemas
    from starforge.session import work_path
    from starforge.sources.staging import read_raw_staging
    base = work_path(spark, "test-raw", uuid.uuid4().hex)
    rows = [("PAY1", "S1", "10.00"), ("PAY2", "S" * 16, "99999999999.00"), ("P" * 21, None, "no number"), (None, "S3", None)]
    spark.createDataFrame(rows, "payment_id string, subscription_id string, due_amount string").write.parquet(f"{base}/payments")
    raw = read_raw_staging(spark, base, "payments")
    got = {r.column_name: r.n for r in quality.bound_violations(
        raw, "staging.payments", schemas.VARCHAR_BOUNDS["payments"], schemas.NUMERIC_BOUNDS["payments"]).collect()}
    assert got == {"payment_id": 1, "subscription_id": 1, "due_amount": 2}
    assert quality.bound_violations(raw, "t", {}, {}).count() == 0


def test_report_scans_each_table_once_for_its_rules(spark):
    st = staging_from_driver(spark, SF)
    for src in ("members", "payments", "plans"):
        got = {r.rule: r.n for r in quality.verdict(quality.table_counts(st, src, AS_OF)).collect()}
        want = {r.rule: r.n for r in quality.row_rule_counts(
            getattr(st, src), [r for r in quality.ROW_RULES if r.source == src], AS_OF).collect()}
        want |= {d[0]: quality.duplicate_rule(st, d[0]).first().n for d in quality.DUPLICATE_RULES if d[2] == src}
        assert got == want
        none = quality.table_counts(_St(st, **{src: getattr(st, src).limit(0)}), src, AS_OF)
        assert all(r.n == 0 for r in none.collect())


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([("x",), (None,), ("y",)], "k string")
    parent = spark.createDataFrame([("x",)], "k string")
    assert quality.orphans(child, parent, ["k"]).first().n == 2


def test_underage_uses_field_wise_age(spark):
    st_members = spark.createDataFrame(
        [(dt.date(2004, 2, 29),), (dt.date(1990, 1, 1),)], "birth_date date")
    r = quality.RowRule("u", "t", "members", quality.ROW_RULES[3].predicate)
    got = quality.row_rule_counts(st_members, [r], dt.date(2022, 2, 28)).first().n
    assert got == 1


def test_row_rule_null_semantics(spark):
    from decimal import Decimal as Dec
    from starforge import schemas
    rows = [("M1", "n", "h", "c", "d", 1990, dt.date(1990, 1, 1), Dec("1.00"), dt.date(2020, 1, 1), "aktif", None, None),
            ("M2", "n", None, "c", "d", 1990, dt.date(1990, 1, 1), Dec("1.00"), dt.date(2020, 1, 1), None, None, None),
            ("M3", "n", "h", None, "d", 1990, dt.date(1990, 1, 1), Dec("0.00"), None, "bogus", None, None),
            ("M4", "n", "h", "c", "d", 1990, dt.date(1990, 1, 1), None, dt.date(2020, 1, 1), "terk", None, None)]
    members = spark.createDataFrame(rows, schemas.STAGING_MEMBERS)
    counts = {r.rule: r.n for r in quality.row_rule_counts(members, quality.ROW_RULES[:4], AS_OF).collect()}
    assert counts["NULL zorunlu alan (members)"] == 3   # M2 (hash, status), M3 (city, signup), M4 (income)
    assert counts["Invalid member_status"] == 1         # 'bogus'; NULL is not counted by NOT IN
    assert counts["Invalid income"] == 1                # 0.00; NULL is not counted
