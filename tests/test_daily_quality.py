"""The report that adds batch after batch equals the report over all rows."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starforge import schemas
from starforge.operators import dims, quality
from starforge.plans import daily_quality
from starforge.session import work_path
from starforge.sources import snapshots as snap
from starforge.sources.adapter import AS_OF, Staging, staging_from_driver
from starforge.sources.table_state import read_state

SF = "/root/testdata/sf0.001"


def _rows(df):
    return {r.rule: tuple(r) for r in df.collect()}


def _base(spark):
    return work_path(spark, "daily-quality", uuid.uuid4().hex)


def _staging(spark, **tables):
    """A bundle of hand-made rows; columns left out are NULL, tables left out empty."""
    made = {}
    for t, schema in schemas.STAGING.items():
        made[t] = spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in tables.get(t, [])], schema)
    return Staging(**made)


def _ids(staging):
    return dims.clean_members(staging.members).select("member_id")


def _member(i, **over):
    return {"member_id": i, "tc_hash": f"h{i}", "city": "x", "income": Decimal(10), "signup_date": dt.date(2020, 1, 1),
            "status": "ACTIVE", "birth_date": dt.date(1990, 1, 1)} | over


def _pay(i, sub, **over):
    return {"payment_id": i, "subscription_id": sub, "due_date": dt.date(2024, 1, 1), "due_amount": Decimal(5)} | over


def _n(spark, base, rule, as_of=AS_OF):
    return _rows(daily_quality.report(spark, base, as_of))[rule][2]


@pytest.fixture(scope="module")
def three_days(spark):
    """Three batches of the given rows; repeated keys, orphans and late parents lie across them."""
    st = staging_from_driver(spark, SF)
    deal = {t: F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in getattr(st, t).columns]), F.lit(3)) for t in ("members", "subscriptions", "payments", "plans")}
    days = [Staging(lottery=st.lottery, **{t: getattr(st, t).where(of == d) for t, of in deal.items()}) for d in range(3)]
    base = _base(spark)
    for d, part in enumerate(days):
        daily_quality.add_batch(spark, base, f"d{d}", part, _ids(part), buckets=3)
    return base, days


def _whole(days, as_of):
    st = Staging(lottery=days[0].lottery, **{t: quality.union_all([getattr(d, t) for d in days]) for t in ("members", "subscriptions", "payments", "plans")})
    return quality.dq_report(st, quality.union_all([_ids(d) for d in days]), as_of)


@pytest.mark.parametrize("as_of", [AS_OF, AS_OF - dt.timedelta(days=9 * 365)])
def test_equals_the_report_over_all_rows_on_any_day(spark, three_days, as_of):
    base, days = three_days
    got, want = _rows(daily_quality.report(spark, base, as_of)), _rows(_whole(days, as_of))
    assert got == want
    assert set(got) == set(quality.REPORT_ORDER) and got["Duplicate payment_id"][2] > 0 and got["Orphan payments"][2] > 0


def test_earlier_version_is_the_report_of_that_day(spark, three_days):
    base, days = three_days
    assert _rows(daily_quality.report(spark, base, AS_OF, version=2)) == _rows(_whole(days[:2], AS_OF))


def test_compaction_keeps_report_and_later_batches(spark, three_days):
    base, days = three_days
    before = _rows(daily_quality.report(spark, base, AS_OF))
    state = daily_quality.compact(spark, base, "c1")
    assert state.folders == ["c1"] and _rows(daily_quality.report(spark, base, AS_OF)) == before
    assert daily_quality.add_batch(spark, base, "d1", days[1], _ids(days[1])) == state  # was folded: nothing is added again
    daily_quality.add_batch(spark, base, "d9", days[0], _ids(days[0]))
    with pytest.raises(ValueError):
        daily_quality.compact(spark, base, "d9")
    assert _rows(daily_quality.report(spark, base, AS_OF)) == _rows(_whole([*days, days[0]], AS_OF))


def test_parent_that_comes_later_takes_its_orphans_back(spark):
    base = _base(spark)
    day1 = _staging(spark, payments=[_pay("p1", "s1"), _pay("p2", "s1"), _pay("p3", "s2"), _pay("p4", None)])
    daily_quality.add_batch(spark, base, "d1", day1, _ids(day1), buckets=4)
    assert _n(spark, base, "Orphan payments") == 4
    day2 = _staging(spark, subscriptions=[{"subscription_id": "s1", "member_id": "m1"}, {"subscription_id": None}],
                    payments=[_pay("p5", "s1"), _pay("p6", "s2"), _pay("p7", None)])
    daily_quality.add_batch(spark, base, "d2", day2, _ids(day2))
    assert _n(spark, base, "Orphan payments") == 4  # p3, p4, p6, p7
    assert _n(spark, base, "subscription → member FK") == 2
    day3 = _staging(spark, members=[_member("m1")], subscriptions=[{"subscription_id": "s1", "member_id": "m1"}], payments=[_pay("p8", "s1")])
    daily_quality.add_batch(spark, base, "d3", day3, _ids(day3))
    assert _n(spark, base, "Orphan payments") == 4  # a parent that comes twice takes nothing back twice
    assert _n(spark, base, "subscription → member FK") == 1


def test_key_counts_once_as_a_duplicate_group(spark):
    base = _base(spark)
    for d, ids in enumerate((["a", None], ["a", "b"], ["a", "a", None], [])):
        part = _staging(spark, payments=[_pay(i, "s") for i in ids])
        daily_quality.add_batch(spark, base, f"d{d}", part, _ids(part), buckets=4)
    assert _n(spark, base, "Duplicate payment_id") == 2  # a and the NULL group
    assert _n(spark, base, "NULL payment fields") == 2


def test_age_is_that_of_the_report_day(spark):
    base = _base(spark)
    part = _staging(spark, members=[_member("m1", birth_date=dt.date(2006, 12, 3)), _member("m2", birth_date=None)])
    daily_quality.add_batch(spark, base, "d1", part, _ids(part), buckets=4)
    assert _n(spark, base, "Underage members", dt.date(2024, 12, 2)) == 1
    assert _n(spark, base, "Underage members", dt.date(2024, 12, 3)) == 0


def test_batch_reads_the_buckets_of_its_keys_only(spark):
    base = _base(spark)
    day1 = _staging(spark, payments=[_pay(f"p{i}", f"s{i}") for i in range(200)])
    state = daily_quality.add_batch(spark, base, "d1", day1, _ids(day1), buckets=16)
    held = daily_quality.held_keys(spark, base, state, {"duplicate-payments": [3], "orphan-payments": [5, 7]})
    files = {r[0].split("/run_id=d1/")[1].rsplit("/", 1)[0] for r in held.select(F.input_file_name()).distinct().collect()}
    assert files == {"topic=duplicate-payments/bucket=3", "topic=orphan-payments/bucket=5", "topic=orphan-payments/bucket=7"}
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_lost_and_repeated_batches(spark, monkeypatch):
    base = _base(spark)
    day1 = _staging(spark, payments=[_pay("p1", "s1"), _pay("p1", "s1")])

    def lost(*a):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(daily_quality, "publish", lost)
        with pytest.raises(RuntimeError):
            daily_quality.add_batch(spark, base, "d1", day1, _ids(day1), buckets=4)
    assert read_state(spark, base, daily_quality.COUNTS).version == 0 and not daily_quality.report(spark, base, AS_OF).collect()
    for _ in range(2):
        daily_quality.add_batch(spark, base, "d1", day1, _ids(day1), buckets=4)
    assert _n(spark, base, "Duplicate payment_id") == 1 and _n(spark, base, "Orphan payments") == 2
    assert snap.list_names(spark, f"{base}/{daily_quality.BROUGHT}") == []
