"""G2 daily load (stage order, audit, failure isolation, re-run) and G3 streaming."""

import datetime as dt
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from starforge import schemas
from starforge.operators import dims, scd2
from starforge.plans.star_load import STAGES, run_star_load
from starforge.session import work_path
from starforge.sources import snapshots as snap
from starforge.sources.adapter import AS_OF, SPINE, previous_members, staging_from_driver
from starforge.streaming.incremental import run_incremental_scd2

SF = "/root/testdata/sf0.001"


def test_daily_load_audit_and_snapshots(spark):
    st = staging_from_driver(spark, SF)
    base = work_path(spark, "test-star", uuid.uuid4().hex)
    rep = run_star_load(spark, st, base, AS_OF, spine=SPINE)
    assert [s.stage for s in rep.stages] == STAGES
    assert all(s.status == "success" for s in rep.stages), rep.stages
    audit = snap.read_audit(spark, base).where(F.col("run_id") == rep.run_id)
    assert audit.count() == 5
    by = {s.stage: s.rows for s in rep.stages}
    assert by["dim_date"] == (SPINE[1] - SPINE[0]).days + 1
    dm = snap.read_scd2(spark, base, "dim_member", schemas.DIM_MEMBER)
    clean = dims.one_row_per_member(dims.clean_members(st.members)).count()
    assert by["dim_member"] == clean == dm.where("is_current").count()
    fp = snap.read_latest(spark, base, "fact_payments")
    assert fp.select("payment_id").distinct().count() == fp.count()
    assert by["fact_payments"] >= fp.count()  # reported before de-duplication


def test_failed_stage_is_isolated_and_facts_use_last_good_snapshot(spark):
    st = staging_from_driver(spark, SF)
    base = work_path(spark, "test-star", uuid.uuid4().hex)
    run_star_load(spark, st, base, AS_OF - dt.timedelta(1), spine=SPINE)
    rep = run_star_load(spark, st, base, AS_OF, spine=SPINE, fail_stages=("dim_plan",))
    status = {s.stage: s.status for s in rep.stages}
    assert status["dim_plan"] == "failed"
    assert status["fact_payments"] == status["fact_lottery"] == "success"
    err = snap.read_audit(spark, base).where("status = 'failed'").first().error_msg
    assert "forced failure" in err


def test_rerun_same_day_is_idempotent(spark):
    st = staging_from_driver(spark, SF)
    base = work_path(spark, "test-star", uuid.uuid4().hex)
    run_star_load(spark, st, base, AS_OF, spine=SPINE)
    first = snap.read_scd2(spark, base, "dim_member", schemas.DIM_MEMBER)
    rows1 = {tuple(r) for r in first.collect()}
    run_star_load(spark, st, base, AS_OF, spine=SPINE)  # same run id: replay
    again = snap.read_scd2(spark, base, "dim_member", schemas.DIM_MEMBER)
    assert {tuple(r) for r in again.collect()} == rows1


def test_streaming_incremental_equals_batch(spark):
    st = staging_from_driver(spark, SF)
    root = work_path(spark, "test-stream", uuid.uuid4().hex)
    inc, base, ck = f"{root}/in", f"{root}/star", f"{root}/ck"
    prev_day = AS_OF - dt.timedelta(1)
    previous_members(st.members).write.parquet(f"{inc}/d1")
    run_incremental_scd2(spark, inc, base, ck, prev_day, prefix="a")
    st.members.write.parquet(f"{inc}/d2")
    run_incremental_scd2(spark, inc, base, ck, AS_OF, prefix="b")
    run_incremental_scd2(spark, inc, base, ck, AS_OF, prefix="c")  # nothing new: no batch
    streamed = snap.read_scd2(spark, base, "dim_member", schemas.DIM_MEMBER)
    d1 = scd2.scd2_apply(scd2.empty_dim_member(spark), previous_members(st.members), prev_day)
    batch = scd2.scd2_apply(d1, st.members, AS_OF)
    key = lambda df: {tuple(r) for r in df.drop("member_key").collect()}
    assert key(streamed) == key(batch)
    assert len(snap.snapshot_runs(spark, base, "dim_member")) == 2


def test_incremental_payments_insert_ignore(spark):
    from starforge.operators import facts
    from starforge.operators.dedupe import first_per_key
    from starforge.streaming.incremental import fact_batches, run_incremental_payments
    st = staging_from_driver(spark, SF)
    root = work_path(spark, "test-stream", uuid.uuid4().hex)
    inc, base, ck = f"{root}/in", f"{root}/star", f"{root}/ck"
    dm, dp = dims.dim_member_full(st.members, AS_OF), dims.dim_plan(st.plans)
    snap.write_snapshot(dm, base, "dim_member", "d0", ["is_current"])
    snap.write_snapshot(dp, base, "dim_plan", "d0")
    cut = F.col("due_date") < F.lit(dt.date(1999, 1, 1))
    st.payments.where(cut).write.parquet(f"{inc}/a")
    run_incremental_payments(spark, inc, base, ck, "p1")
    st.payments.where(~F.coalesce(cut, F.lit(False))).write.parquet(f"{inc}/b")
    run_incremental_payments(spark, inc, base, ck, "p2")
    run_incremental_payments(spark, inc, base, ck, "p3")  # nothing new: no batch
    got = fact_batches(spark, base, "fact_payments")
    assert got.select("payment_id").distinct().count() == got.count()
    rows = facts.payment_rows(st.payments, dm, dp)
    day1 = first_per_key(rows.where(cut), ["payment_id"], facts.payment_order())
    day2 = first_per_key(rows.where(~F.coalesce(cut, F.lit(False)))
                         .join(day1.select("payment_id"), "payment_id", "left_anti"),
                         ["payment_id"], facts.payment_order())
    want = day1.unionByName(day2)
    key = lambda df: {tuple(r) for r in df.select(sorted(df.columns)).collect()}
    assert key(got.drop("member_key", "plan_key")) == key(want.drop("member_key", "plan_key"))


def _one_member(member_id, status="aktif"):
    return (member_id, "n", f"hash-{member_id}", "c", "d", 1980, dt.date(1980, 1, 1), Decimal("1.00"),
            dt.date(2020, 1, 1), status, None, None)


def _one_payment(payment_id, member_id, due, paid, plan_id="P1"):
    return (payment_id, "S1", member_id, plan_id, 1, due, paid, Decimal("10.00"), Decimal("10.00"), "odendi")


def test_incremental_payments_late_member_paid_later_and_replay(spark):
    from starforge import schemas
    from starforge.operators import facts
    from starforge.streaming import incremental as inc
    base = work_path(spark, "test-g3", uuid.uuid4().hex)
    members = lambda *ids: spark.createDataFrame([_one_member(i) for i in ids], schemas.STAGING_MEMBERS)
    pays = lambda *rows: spark.createDataFrame(list(rows), schemas.STAGING_PAYMENTS)
    plans = spark.createDataFrame([("P1", "p", "konut", 12, Decimal("120.00"), None)], schemas.STAGING_PLANS)
    snap.write_snapshot(dims.dim_plan(plans), base, "dim_plan", "d9")
    snap.write_snapshot(dims.dim_member_full(members("M1"), AS_OF), base, "dim_member", "d9", ["is_current"])
    d1, d2, d3 = dt.date(2001, 1, 1), dt.date(2001, 2, 1), dt.date(2001, 3, 1)
    got = lambda: {r.payment_id: (r.member_id, r.due_date, r.paid_date, r.payment_status)
                   for r in inc.fact_batches(spark, base).collect()}
    first = pays(_one_payment("A", "M1", d1, None), _one_payment("B", "M2", d1, d1), _one_payment("C", "M2", d1, None),
                 _one_payment("D", "M1", d1, d1), _one_payment(None, "M1", d1, d1), _one_payment("E", None, d1, d1))
    inc.load_payments(spark, base, first, "p9")
    assert set(got()) == {"A", "D"} and got()["A"][3] == "odenmedi"
    assert {r.payment_id for r in inc.pending_payments(spark, base).collect()} == {"B", "C"}
    # the next day M2 is there, A and C are paid, D comes again under another due date
    snap.write_snapshot(dims.dim_member_full(members("M1", "M2"), AS_OF), base, "dim_member", "d10", ["is_current"])
    second = pays(_one_payment("A", "M1", d1, d2), _one_payment("C", "M2", d1, d2), _one_payment("D", "M1", d3, d3),
                  _one_payment("D", "M1", d2, None))
    inc.load_payments(spark, base, second, "p10")
    want = {"A": ("M1", d1, d2, "gecikmeli"), "B": ("M2", d1, d1, "zamaninda"), "C": ("M2", d1, d2, "gecikmeli"),
            "D": ("M1", d1, d1, "zamaninda")}
    assert got() == want and inc.fact_batches(spark, base).count() == 4
    assert inc.pending_payments(spark, base).count() == 0
    # the fact equals a reload of the newest staging rows
    newest = pays(_one_payment("A", "M1", d1, d2), _one_payment("B", "M2", d1, d1), _one_payment("C", "M2", d1, d2),
                  _one_payment("D", "M1", d1, d1), _one_payment("D", "M1", d3, d3))
    full = facts.fact_payments(newest, dims.dim_member_full(members("M1", "M2"), AS_OF), dims.dim_plan(plans))
    assert {r.payment_id: (r.member_id, r.due_date, r.paid_date, r.payment_status) for r in full.collect()} == want
    # a replayed batch reads the dimensions of its first attempt
    snap.write_snapshot(dims.dim_member_full(members("M1"), AS_OF), base, "dim_member", "d11", ["is_current"])
    inc.load_payments(spark, base, second, "p10")
    assert got() == want
    inc.retry_pending_payments(spark, base)
    inc.retry_pending_payments(spark, base)
    assert got() == want
    # a payment whose member comes without new payments
    inc.load_payments(spark, base, pays(_one_payment("F", "M3", d1, d1)), "p11")
    assert got() == want
    snap.write_snapshot(dims.dim_member_full(members("M1", "M2", "M3"), AS_OF), base, "dim_member", "d12", ["is_current"])
    inc.retry_pending_payments(spark, base)
    assert got() == want | {"F": ("M3", d1, d1, "zamaninda")}


def test_rejected_members_are_written_and_counted(spark):
    members = spark.createDataFrame(
        [_one_member("M1"), _one_member("M1")[:2] + ("zzz",) + _one_member("M1")[3:], _one_member("M2"),
         (None, "n", "h1") + _one_member("x")[3:], (None, "n", "h2") + _one_member("x")[3:]], schemas.STAGING_MEMBERS)
    got = sorted((r.member_id or "", r.tc_hash, r.reason) for r in dims.rejected_members(members).collect())
    assert got == [("", "h1", dims.NO_MEMBER_ID), ("", "h2", dims.NO_MEMBER_ID), ("M1", "hash-M1", dims.OTHER_HASH_KEPT)]
    dim = scd2.scd2_apply(scd2.empty_dim_member(spark), members, AS_OF)
    assert sorted((r.member_id, r.tc_hash) for r in dim.collect()) == [("M1", "zzz"), ("M2", "hash-M2")]
    counts = {r.action: r.n for r in scd2.scd2_counts(scd2.empty_dim_member(spark), members, AS_OF).collect()}
    assert counts == {"insert": 2, "reject": 3}  # five clean rows read
    base = work_path(spark, "test-rejects", uuid.uuid4().hex)
    rep = run_star_load(spark, _St(staging_from_driver(spark, SF), members=members), base, AS_OF, spine=SPINE)
    assert {s.stage: s.rows for s in rep.stages}["dim_member"] == 5
    assert snap.read_latest(spark, base, "dim_member_rejects").count() == 3


def test_drop_old_runs_keeps_the_newest(spark):
    base = work_path(spark, "test-keep", uuid.uuid4().hex)
    for run in ("d2", "d9", "d10"):
        snap.write_snapshot(spark.range(2), base, "t", run)
    assert snap.drop_old_runs(spark, base, "t", 2) == ["d2"]
    assert snap.snapshot_runs(spark, base, "t") == ["d9", "d10"]


def test_scd2_history_is_append_only_across_runs(spark):
    st = staging_from_driver(spark, SF)
    base = work_path(spark, "test-star", uuid.uuid4().hex)
    day1, day2 = AS_OF - dt.timedelta(1), AS_OF
    run_star_load(spark, _St(st, members=previous_members(st.members)), base, day1, spine=SPINE)
    run_star_load(spark, st, base, day2, spine=SPINE)
    runs = snap.snapshot_runs(spark, base, "dim_member")
    assert len(runs) == 2
    # run 2 stores only the rows it closed, not the whole history
    root = f"{base}/dim_member/run_id={runs[-1]}"
    closed = spark.read.schema(schemas.DIM_MEMBER).parquet(root).where("NOT is_current")
    assert closed.count() == closed.where(F.col("valid_to") == F.lit(day2)).count() > 0
    full = snap.read_scd2(spark, base, "dim_member", schemas.DIM_MEMBER)
    d1 = scd2.scd2_apply(scd2.empty_dim_member(spark), previous_members(st.members), day1)
    want = scd2.scd2_apply(d1, st.members, day2)
    key = lambda df: {tuple(r) for r in df.collect()}
    assert key(full) == key(want)


class _St:
    def __init__(self, st, **over):
        for k in ("members", "plans", "subscriptions", "payments", "lottery"):
            setattr(self, k, over.get(k, getattr(st, k)))


def test_streaming_days_pending_together_stay_separate(spark):
    st = staging_from_driver(spark, SF)
    root = work_path(spark, "test-stream", uuid.uuid4().hex)
    inc, base, ck = f"{root}/in", f"{root}/star", f"{root}/ck"
    previous_members(st.members).coalesce(1).write.parquet(f"{inc}/d1")
    st.members.coalesce(1).write.parquet(f"{inc}/d2")
    run_incremental_scd2(spark, inc, base, ck, AS_OF, prefix="x", max_files_per_trigger=1)
    assert len(snap.snapshot_runs(spark, base, "dim_member")) == 2


def test_replayed_older_day_uses_its_own_dimensions(spark):
    st = staging_from_driver(spark, SF)
    day1_st = _St(st, members=previous_members(st.members))
    base = work_path(spark, "test-star", uuid.uuid4().hex)
    day1, day2 = AS_OF - dt.timedelta(1), AS_OF
    run_star_load(spark, day1_st, base, day1, spine=SPINE)
    run_star_load(spark, st, base, day2, spine=SPINE)  # status changes: new member versions
    keys = lambda df: {r.member_key for r in df.select("member_key").distinct().collect()}
    cur1 = keys(snap.read_scd2_current(spark, base, "dim_member", schemas.DIM_MEMBER,
                                       upto=day1.strftime("%Y%m%d")))
    cur2 = keys(snap.read_scd2_current(spark, base, "dim_member", schemas.DIM_MEMBER))
    assert cur2 - cur1  # day 2 holds versions day 1 does not
    # replaying day 1 after day 2 exists: its facts load against day 1's dimensions
    rep = run_star_load(spark, day1_st, base, day1, spine=SPINE, fail_stages=("dim_member",))
    assert {s.stage: s.status for s in rep.stages}["fact_payments"] == "success"
    fp1 = keys(snap.read_latest(spark, base, "fact_payments", upto=day1.strftime("%Y%m%d")))
    assert fp1 <= cur1 and not (fp1 & (cur2 - cur1))

def test_load_then_incremental_is_one_fact(spark):
    """The full load's fact, its batches, its index of keys, compaction and retention."""
    from starforge.sources.table_state import read_state, versions
    from starforge.streaming import incremental as inc
    base = work_path(spark, "test-one", uuid.uuid4().hex)
    st = staging_from_driver(spark, SF)
    members = spark.createDataFrame([_one_member("M1"), _one_member("M2")], schemas.STAGING_MEMBERS)
    plans = spark.createDataFrame([("P1", "p", "konut", 12, Decimal("120.00"), None)], schemas.STAGING_PLANS)
    pays = lambda *rows: spark.createDataFrame(list(rows), schemas.STAGING_PAYMENTS)
    day, late, old = dt.date(1996, 1, 1), dt.date(1996, 2, 1), dt.date(1900, 1, 1)
    first = [_one_payment(f"K{i:03d}", "M1", day, None if i % 2 else day) for i in range(200)]
    first += [_one_payment("U1", "M9", day, day), _one_payment("U2", "M1", day, day, "P9"), _one_payment("U3", "M1", old, None),
              _one_payment("U4", None, day, day), _one_payment("U5", "M1", None, None)]
    rep = run_star_load(spark, _St(st, members=members, plans=plans, payments=pays(*first)), base, AS_OF, spine=SPINE)
    by = {s.stage: s for s in rep.stages}
    assert by["fact_payments"].status == "success" and by["fact_payments"].rejected == 4
    audit = snap.read_audit(spark, base).where("stage = 'fact_payments'").first()
    assert audit.rows_rejected == 4
    rejects = {r.payment_id: r.reason for r in spark.read.parquet(f"{base}/{inc.REJECTS}/run_id={rep.run_id}").collect()}
    assert rejects == {"U1": "no member", "U2": "no plan", "U3": "no date", "U4": "no member"}
    ids = lambda: sorted(r.payment_id for r in inc.fact_batches(spark, base).collect())
    held = sorted({p[0] for p in first} - set(rejects))
    assert ids() == held
    # the same rows again, one paid now, one new: nothing twice, the paid row replaces the unpaid one
    inc.load_payments(spark, base, pays(*first[:50], _one_payment("K001", "M1", day, late), _one_payment("N1", "M2", day, day)), "b1")
    assert ids() == sorted(held + ["N1"])
    paid = {r.payment_id: r.paid_date for r in inc.fact_batches(spark, base).collect()}
    assert paid["K001"] == late and paid["K003"] is None
    state = read_state(spark, base, inc.FACT)
    assert state.base == rep.run_id and state.batches == ("b1",) and state.indexed
    # a later batch sees the paid row; a batch reads only the folders of its own buckets
    inc.load_payments(spark, base, pays(_one_payment("K001", "M1", day, day)), "b2")
    assert {r.payment_id: r.paid_date for r in inc.fact_batches(spark, base).collect()}["K001"] == late
    keys = inc.held_keys(spark, base, read_state(spark, base, inc.FACT), [3])
    assert {f.split("bucket=")[1].split("/")[0] for f in keys.select(F.col("_metadata.file_path")).distinct().toPandas().iloc[:, 0]} == {"3"}
    assert "PartitionFilters: [isnotnull(bucket" in keys._jdf.queryExecution().toString() or "PartitionFilters: [bucket" in keys._jdf.queryExecution().toString()
    # waiting rows cost nothing until a dimension has a newer run
    waiting = read_state(spark, base, inc.FACT).pending
    assert len(waiting) == 3 and {r.payment_id for r in inc.pending_payments(spark, base).collect()} == {"U1", "U2"}
    assert "U1" not in ids()
    snap.write_snapshot(dims.dim_member_full(spark.createDataFrame([_one_member(m) for m in ("M1", "M2", "M9")], schemas.STAGING_MEMBERS), AS_OF),
                        base, "dim_member", "99990101", ["is_current"])
    inc.retry_pending_payments(spark, base)
    assert ids() == sorted(held + ["N1", "U1"])
    # compaction changes no row; then only named folders stay
    before = {tuple(r) for r in inc.fact_batches(spark, base).collect()}
    run = inc.compact_payments(spark, base)
    state = read_state(spark, base, inc.FACT)
    assert (state.base, state.batches) == (run, ()) and {tuple(r) for r in inc.fact_batches(spark, base).collect()} == before
    assert {r.payment_id for r in inc.pending_payments(spark, base).collect()} == {"U2"}
    inc.load_payments(spark, base, pays(_one_payment("N1", "M2", day, day), _one_payment("N2", "M2", day, day)), "b3")
    assert ids() == sorted(held + ["N1", "N2", "U1"])
    inc.drop_unnamed_payments(spark, base, keep=1)
    assert snap.snapshot_runs(spark, base, inc.FACT) == ["b3", run] or set(snap.snapshot_runs(spark, base, inc.FACT)) == {"b3", run}
    assert len(versions(spark, base, inc.FACT)) == 1 and ids() == sorted(held + ["N1", "N2", "U1"])


def test_state_is_published_on_top_of_what_was_read(spark):
    import pytest
    from starforge.sources.table_state import publish, read_state
    base = work_path(spark, "test-state", uuid.uuid4().hex)
    seen = read_state(spark, base, "t")
    publish(spark, base, "t", seen.with_base("r1"))
    with pytest.raises(RuntimeError, match="changed while"):
        publish(spark, base, "t", seen.with_base("r2"))
    state = read_state(spark, base, "t")
    assert (state.version, state.folders) == (1, ["r1"])
    assert publish(spark, base, "t", state.with_batch("b", (), ())).folders == ["r1", "b"]


def test_a_failed_run_goes_on_and_is_published_as_a_whole(spark):
    from starforge.plans.star_load import read_star
    st = staging_from_driver(spark, SF)
    base = work_path(spark, "test-resume", uuid.uuid4().hex)
    assert read_star(spark, base) is None
    rep = run_star_load(spark, st, base, AS_OF, spine=SPINE, fail_stages=("fact_lottery",))
    assert {s.stage: s.status for s in rep.stages}["fact_lottery"] == "failed"
    assert read_star(spark, base) is None  # four tables of the day are there, but no reader sees them
    again = run_star_load(spark, st, base, AS_OF, spine=SPINE, resume=True)
    assert {s.stage: s.status for s in again.stages} == {n: "kept" for n in STAGES[:4]} | {"fact_lottery": "success"}
    assert [s.rows for s in again.stages][:4] == [s.rows for s in rep.stages][:4]
    star = read_star(spark, base)
    assert set(star) == set(STAGES) and all(star[t].count() > 0 for t in STAGES)
    assert snap.read_audit(spark, base).count() == 6  # five of the first call, one of the second
    # the next day fails in a dimension: readers stay on the first day, and both facts run again
    day2 = AS_OF + dt.timedelta(1)
    run_star_load(spark, st, base, day2, spine=SPINE, fail_stages=("dim_plan",))
    assert read_star(spark, base)["fact_lottery"].inputFiles()[0].split("run_id=")[1].startswith(AS_OF.strftime("%Y%m%d"))
    rep = run_star_load(spark, st, base, day2, spine=SPINE, resume=True)
    assert [s.status for s in rep.stages] == ["kept", "success", "kept", "success", "success"]
    assert read_star(spark, base)["fact_lottery"].inputFiles()[0].split("run_id=")[1].startswith(day2.strftime("%Y%m%d"))
