"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the staging adapter and runs
the library's own operator on the whole tables. Surrogate keys are left out
of the outputs (they are engine-specific hashes); business keys identify rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge import schemas
from starforge.functions import rules
from starforge.functions.calendar import is_ramadan as ramadan_flag
from starforge.operators import calendar, dims, facts, inject, profile, quality, scd2, schedule, selection
from starforge.operators.dedupe import first_per_key, insert_ignore
from starforge.session import work_path
from starforge.sources import snapshots as snap
from starforge.sources.adapter import AS_OF, SPINE, Staging, previous_members, staging_from_driver
from starforge.sources.staging import read_staging, write_staging

PREV_AS_OF = AS_OF - dt.timedelta(days=1)
# Boundary of "yesterday's" target for the insert-ignore-against-target query.
EXISTING_CUTOFF = dt.date(1999, 1, 1)
SEED = 42
# Payments' due dates lie in the nineties; the calendar queries move them by whole years into the years
# for which the lunar dates are known.
CALENDAR_SHIFT_YEARS = 27
# Fields that must be filled in staging (those of the report's NULL rules).
MANDATORY = {
    "members": ["member_id", "tc_hash", "city", "income", "signup_date", "status"],
    "payments": ["payment_id", "subscription_id", "due_date", "due_amount"],
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ROWS_ONLY: set[str] = set()


def query(name: str, rows_only: bool = False):
    def deco(fn):
        QUERIES[name] = fn
        if rows_only:
            ROWS_ONLY.add(name)
        return fn
    return deco


def _st(spark, sf_dir):
    return staging_from_driver(spark, sf_dir)


def _with(st, **tables):
    """Staging with some of its tables replaced."""
    return Staging(**{t: tables.get(t, getattr(st, t)) for t in schemas.STAGING})


def _dims(st):
    return dims.dim_member_full(st.members, AS_OF), dims.dim_plan(st.plans)


def _fact_payments(st):
    dm, dp = _dims(st)
    return facts.fact_payments(st.payments, dm, dp)


def _fact_lottery(st):
    dm, dp = _dims(st)
    return facts.fact_lottery(st.lottery, st.payments, dm, dp)


def _recent_payments(st):
    return st.payments.withColumn("due_date", F.add_months("due_date", 12 * CALENDAR_SHIFT_YEARS))


def _holidays(spark, st):
    years = _recent_payments(st).where(F.col("due_date").isNotNull()).select(
        F.year("due_date").alias("year")).distinct()
    return calendar.holiday_calendar(spark, years)


def _dim_date_of_data(st):
    return calendar.dim_date_covering((st.payments, ["due_date", "paid_date"]),
                                      (st.lottery, "lottery_date"))


def _scd2_inputs(st):
    prev = dims.dim_member_full(previous_members(st.members), PREV_AS_OF)
    return prev, st.members


DIM_MEMBER_OUT = ["member_id", "full_name", "tc_hash", "city", "district", "age_group",
                  "income_bracket", "signup_date", "member_status", "churn_date", "valid_from",
                  "valid_to", "is_current", "version_no"]
FACT_PAYMENT_OUT = ["payment_id", "member_id", "plan_id", "date_key", "installment_no",
                    "due_amount", "paid_amount", "days_late", "payment_status"]
FACT_LOTTERY_OUT = ["lottery_id", "member_id", "plan_id", "date_key", "lottery_round",
                    "is_winner", "cumulative_paid_ratio"]
STAGING_PAYMENT_COLS = [f.name for f in schemas.STAGING_PAYMENTS.fields]


# ---------------- sources and sinks ----------------

@query("scan_staging_members")
def q_scan_staging_members(spark, sf_dir):
    """S2 + S1: write the staging tables, scan members back with the declared schema."""
    st = _st(spark, sf_dir)
    base = work_path(spark, "staging", uuid.uuid4().hex)
    write_staging(st, base)
    return read_staging(spark, base, "members")


@query("insert_ignore_payments")
def q_insert_ignore_payments(spark, sf_dir):
    """First row per payment_id wins (deterministic order)."""
    st = _st(spark, sf_dir)
    return first_per_key(st.payments, ["payment_id"], facts.payment_order())


@query("insert_ignore_existing")
def q_insert_ignore_existing(spark, sf_dir):
    """S5 against a target: rows to append = keys the target does not hold, first wins."""
    st = _st(spark, sf_dir)
    target = first_per_key(st.payments.where(F.col("due_date") < F.lit(EXISTING_CUTOFF)),
                           ["payment_id"], facts.payment_order())
    return insert_ignore(target, st.payments, ["payment_id"], facts.payment_order())


@query("stage_audit")
def q_stage_audit(spark, sf_dir):
    """G2 + S3/S4/S6: run the daily star load into the shared work folder and return
    the deterministic part of its audit (stage, status, rows; timings dropped)."""
    from starforge.plans.star_load import run_star_load
    st = _st(spark, sf_dir)
    base = work_path(spark, "star", uuid.uuid4().hex)
    rep = run_star_load(spark, st, base, AS_OF, spine=SPINE)
    return (snap.read_audit(spark, base).where(F.col("run_id") == rep.run_id)
                .select("stage", "status", "rows_inserted"))


@query("incremental_scd2")
def q_incremental_scd2(spark, sf_dir):
    """Two daily member files consumed by availableNow streams (SCD2 per batch);
    returns the resulting member dimension (current rows plus closed history)."""
    from starforge.streaming.incremental import run_incremental_scd2
    st = _st(spark, sf_dir)
    root = work_path(spark, "incremental", uuid.uuid4().hex)
    incoming, base, ckpt = f"{root}/incoming", f"{root}/star", f"{root}/_checkpoint"
    previous_members(st.members).write.mode("overwrite").parquet(f"{incoming}/day=1")
    run_incremental_scd2(spark, incoming, base, ckpt, PREV_AS_OF, prefix="d1")
    st.members.write.mode("overwrite").parquet(f"{incoming}/day=2")
    run_incremental_scd2(spark, incoming, base, ckpt, AS_OF, prefix="d2")
    return snap.read_scd2(spark, base, "dim_member", schemas.DIM_MEMBER).select(*DIM_MEMBER_OUT)


@query("incremental_fact_payments")
def q_incremental_fact_payments(spark, sf_dir):
    """G3 + F1 + S5: payments arrive in two daily files (due before / from the cutoff);
    an availableNow stream adds each day's payments to the fact. Ids the fact already
    holds are ignored, unless the same instalment comes paid; payments without a member
    wait as pending."""
    from starforge.streaming.incremental import fact_batches, run_incremental_payments
    st = _st(spark, sf_dir)
    root = work_path(spark, "incremental", uuid.uuid4().hex)
    incoming, base, ckpt = f"{root}/incoming", f"{root}/star", f"{root}/_checkpoint"
    dm, dp = _dims(st)
    snap.write_snapshot(dm, base, "dim_member", "d0", partition_by=["is_current"])
    snap.write_snapshot(dp, base, "dim_plan", "d0")
    early = F.col("due_date") < F.lit(EXISTING_CUTOFF)
    st.payments.where(early).write.mode("overwrite").parquet(f"{incoming}/day=1")
    run_incremental_payments(spark, incoming, base, ckpt, prefix="p1")
    st.payments.where(~F.coalesce(early, F.lit(False))).write.mode("overwrite").parquet(
        f"{incoming}/day=2")
    run_incremental_payments(spark, incoming, base, ckpt, prefix="p2")
    return fact_batches(spark, base).select(*FACT_PAYMENT_OUT)


@query("load_then_incremental")
def q_load_then_incremental(spark, sf_dir):
    """G2 + G3 + S5 on one fact: the full load on day one, then the same payments again and the later ones as files."""
    from starforge.plans.star_load import run_star_load
    from starforge.streaming.incremental import fact_batches, run_incremental_payments
    st = _st(spark, sf_dir)
    root = work_path(spark, "incremental", uuid.uuid4().hex)
    incoming, base, ckpt = f"{root}/incoming", f"{root}/star", f"{root}/_checkpoint"
    early = F.col("due_date") < F.lit(EXISTING_CUTOFF)
    st.payments.where(early).write.mode("overwrite").parquet(f"{incoming}/day=1")
    day1 = spark.read.schema(schemas.STAGING_PAYMENTS).parquet(f"{incoming}/day=1")
    run_star_load(spark, _with(st, payments=day1), base, PREV_AS_OF, spine=SPINE)
    run_incremental_payments(spark, incoming, base, ckpt, prefix="d1")
    st.payments.where(~F.coalesce(early, F.lit(False))).write.mode("overwrite").parquet(f"{incoming}/day=2")
    run_incremental_payments(spark, incoming, base, ckpt, prefix="d2")
    return fact_batches(spark, base).select(*FACT_PAYMENT_OUT)


#: Shares of payments that lose their member, plan and date in the query of enforced foreign keys.
LOST_PARENTS = {"m": 0.01, "p": 0.01, "d": 0.01}


@query("fact_rejects")
def q_fact_rejects(spark, sf_dir):
    """A load of payments some of which name an unknown member, plan or day: the rejected rows with the reason, and
    the ids that the fact took."""
    from starforge.plans.star_load import run_star_load
    st = _st(spark, sf_dir)
    lost = {k: inject.in_sample("payment_id", f, SEED, f"lost-{k}") for k, f in LOST_PARENTS.items()}
    payments = (st.payments.withColumn("member_id", F.when(lost["m"], "M-none").otherwise(F.col("member_id")))
                  .withColumn("plan_id", F.when(lost["p"], "P-none").otherwise(F.col("plan_id")))
                  .withColumn("paid_date", F.when(lost["d"], F.lit(None)).otherwise(F.col("paid_date")))
                  .withColumn("due_date", F.when(lost["d"], F.lit(dt.date(1900, 1, 1))).otherwise(F.col("due_date"))))
    base = work_path(spark, "star", uuid.uuid4().hex)
    run = run_star_load(spark, _with(st, payments=payments), base, AS_OF, spine=SPINE).run_id
    cols = ["payment_id", "member_id", "plan_id", "due_date", "reason"]
    return spark.read.parquet(f"{base}/fact_payments_rejects/run_id={run}").select(*cols).unionByName(
        snap.read_latest(spark, base, "fact_payments").withColumn("reason", F.lit("taken")).select(*cols))


@query("dense_member_keys")
def q_dense_member_keys(spark, sf_dir):
    """G1: member versions numbered 1..n without gaps over two days, each day's in the order of their ids."""
    prev, members = _scd2_inputs(_st(spark, sf_dir))
    cols = ["member_id", "tc_hash", "version_no"]
    day1, high = selection.dense_numbers(prev.select(*cols), cols, "member_no")
    new = scd2.scd2_delta(prev, members, AS_OF).where("is_current").select(*cols).join(prev.select(*cols), cols, "left_anti")
    return day1.unionByName(selection.dense_numbers(new, cols, "member_no", high)[0])


# ---------------- calendar ----------------

@query("dim_date")
def q_dim_date(spark, sf_dir):
    """Calendar rows for every day the payment and lottery data span."""
    return _dim_date_of_data(_st(spark, sf_dir))


@query("is_ramadan")
def q_is_ramadan(spark, sf_dir):
    """Range membership of every payment due date."""
    st = _st(spark, sf_dir)
    return _recent_payments(st).select("payment_id", "installment_no", "due_date",
                                       ramadan_flag("due_date").alias("is_ramadan"))


@query("holiday_calendar")
def q_holiday_calendar(spark, sf_dir):
    """Holiday set for the years the payments cover."""
    st = _st(spark, sf_dir)
    return _holidays(spark, st)


@query("near_holiday")
def q_near_holiday(spark, sf_dir):
    """Due date within 7 days before a holiday (equi-join on expanded days)."""
    st = _st(spark, sf_dir)
    p = _recent_payments(st).select("payment_id", "installment_no", "due_date")
    return calendar.flag_near_holiday(p, "due_date", _holidays(spark, st), 7)


@query("payment_risk_boost")
def q_payment_risk_boost(spark, sf_dir):
    """Seasonal + holiday boost per payment."""
    st = _st(spark, sf_dir)
    return schedule.payment_risk_boost(_recent_payments(st), _holidays(spark, st), 7)


# ---------------- scalar rules ----------------

@query("age_group")
def q_age_group(spark, sf_dir):
    st = _st(spark, sf_dir)
    return st.members.select("member_id", "birth_year",
                             rules.age_group("birth_year", AS_OF).alias("age_group"))


@query("income_bracket")
def q_income_bracket(spark, sf_dir):
    st = _st(spark, sf_dir)
    return st.members.select("member_id", "income",
                             rules.income_bracket("income").alias("income_bracket"))


@query("days_late")
def q_days_late(spark, sf_dir):
    st = _st(spark, sf_dir)
    return st.payments.select("payment_id", "installment_no", "due_date", "paid_date",
                              rules.days_late("due_date", "paid_date").alias("days_late"))


@query("derive_payment_status")
def q_derive_payment_status(spark, sf_dir):
    st = _st(spark, sf_dir)
    late = rules.days_late("due_date", "paid_date")
    return st.payments.select("payment_id", "installment_no", "paid_date", late.alias("days_late"),
                              rules.derived_payment_status("paid_date", late).alias("payment_status"))


@query("months_elapsed")
def q_months_elapsed(spark, sf_dir):
    """R10 on the lottery fact's inputs (signup date of the current member, draw date)."""
    fl = _fact_lottery(_st(spark, sf_dir))
    return fl.select("lottery_id", "signup_date", "lottery_date", "months_elapsed")


@query("cumulative_paid_ratio")
def q_cumulative_paid_ratio(spark, sf_dir):
    """Capped ratio of paid installments to elapsed months."""
    fl = _fact_lottery(_st(spark, sf_dir))
    return fl.select("lottery_id", "paid_before_lottery", "months_elapsed", "cumulative_paid_ratio")


@query("pseudonymise_id")
def q_pseudonymise_id(spark, sf_dir):
    st = _st(spark, sf_dir)
    return st.members.select("member_id", rules.pseudonymise("member_id").alias("id_hash"))


@query("format_business_id")
def q_format_business_id(spark, sf_dir):
    st = _st(spark, sf_dir)
    k = F.substring("member_id", 2, 64).cast("long")
    return st.members.select("member_id", rules.format_business_id("M", 5, k).alias("business_id"))


@query("installment_schedule")
def q_installment_schedule(spark, sf_dir):
    """Monthly schedule of each lottery entry's plan from the draw date, up to as_of."""
    st = _st(spark, sf_dir)
    subs = st.lottery.select("lottery_id", "plan_id", "lottery_date").join(
        st.plans.select("plan_id", "duration_months"), "plan_id")
    return schedule.installment_schedule(subs, "lottery_id", "lottery_date", "duration_months", AS_OF)


@query("income_tier")
def q_income_tier(spark, sf_dir):
    return schedule.income_profile(_st(spark, sf_dir).members)


# ---------------- dimensions, SCD2, facts ----------------

@query("latest_per_key")
def q_latest_per_key(spark, sf_dir):
    """Newest signup per non-empty hash."""
    return dims.clean_members(_st(spark, sf_dir).members).select(
        "member_id", "tc_hash", "signup_date", "status")


@query("dim_member_clean")
def q_dim_member_clean(spark, sf_dir):
    """D3: full-refresh member dimension."""
    return dims.dim_member_full(_st(spark, sf_dir).members, AS_OF).select(*DIM_MEMBER_OUT)


@query("dim_plan")
def q_dim_plan(spark, sf_dir):
    """D2 + R5."""
    return dims.dim_plan(_st(spark, sf_dir).plans).drop("plan_key")


@query("union_all_members")
def q_union_all_members(spark, sf_dir):
    """Members with a 3% hash sample appended (UNION ALL)."""
    m = _st(spark, sf_dir).members
    return m.unionByName(inject.hash_sample(m, "member_id", 0.03, SEED))


@query("scd2_classify")
def q_scd2_classify(spark, sf_dir):
    prev, members = _scd2_inputs(_st(spark, sf_dir))
    return scd2.scd2_classify(prev, members, AS_OF)


@query("scd2_apply")
def q_scd2_apply(spark, sf_dir):
    prev, members = _scd2_inputs(_st(spark, sf_dir))
    return scd2.scd2_apply(prev, members, AS_OF).select(*DIM_MEMBER_OUT)


@query("scd2_current")
def q_scd2_current(spark, sf_dir):
    prev, members = _scd2_inputs(_st(spark, sf_dir))
    return (scd2.scd2_apply(prev, members, AS_OF).where("is_current")
                .select("member_id", "member_status", "valid_from", "version_no"))


@query("scd2_counts")
def q_scd2_counts(spark, sf_dir):
    prev, members = _scd2_inputs(_st(spark, sf_dir))
    return scd2.scd2_counts(prev, members, AS_OF)


@query("fact_payments")
def q_fact_payments(spark, sf_dir):
    return _fact_payments(_st(spark, sf_dir)).select(*FACT_PAYMENT_OUT)


@query("fact_payment_status_share")
def q_fact_payment_status_share(spark, sf_dir):
    """Flagship: derived payment status share over the payment fact."""
    return profile.share_of_total(_fact_payments(_st(spark, sf_dir)), "payment_status")


@query("paid_before_lottery")
def q_paid_before_lottery(spark, sf_dir):
    """Paid installments of the member due on or before the draw date."""
    fl = _fact_lottery(_st(spark, sf_dir))
    return fl.select("lottery_id", "member_id", "lottery_date", "paid_before_lottery")


@query("fact_lottery")
def q_fact_lottery(spark, sf_dir):
    return _fact_lottery(_st(spark, sf_dir)).select(*FACT_LOTTERY_OUT)


# ---------------- data quality ----------------

def _dq_row(name):
    def fn(spark, sf_dir):
        return quality.row_rule(_st(spark, sf_dir), name, AS_OF)
    return fn


for _key, _rule in [("dq_null_members", "NULL zorunlu alan (members)"),
                    ("dq_invalid_status", "Invalid member_status"),
                    ("dq_invalid_income", "Invalid income"),
                    ("dq_underage_members", "Underage members"),
                    ("dq_null_payments", "NULL payment fields"),
                    ("dq_negative_payment", "Negative payment"),
                    ("dq_invalid_payment_status", "Invalid payment_status"),
                    ("dq_invalid_plan_type", "Invalid plan_type")]:
    query(_key)(_dq_row(_rule))


@query("dq_duplicate_member_id")
def q_dq_duplicate_member_id(spark, sf_dir):
    return quality.duplicate_rule(_st(spark, sf_dir), "Duplicate member_id")


@query("dq_duplicate_payment_id")
def q_dq_duplicate_payment_id(spark, sf_dir):
    return quality.duplicate_rule(_st(spark, sf_dir), "Duplicate payment_id")


@query("dq_orphan_payments")
def q_dq_orphan_payments(spark, sf_dir):
    return quality.orphan_payments(_st(spark, sf_dir))


@query("dq_fk_fact_member")
def q_dq_fk_fact_member(spark, sf_dir):
    """Q12: subscriptions whose member is in no version of the member dimension."""
    st = _st(spark, sf_dir)
    return quality.fk_fact_member(st.subscriptions, dims.dim_member_full(st.members, AS_OF))


@query("dq_report")
def q_dq_report(spark, sf_dir):
    st = _st(spark, sf_dir)
    return quality.dq_report(st, dims.dim_member_full(st.members, AS_OF), AS_OF)


@query("dq_report_by_batches")
def q_dq_report_by_batches(spark, sf_dir):
    """Q1-Q12 on what is new: all staging rows, dealt to three daily batches, are added one batch after the other (members by
    hash, so that each hash's newest row is that of the whole table; payments by the year they are due; plans on day one)."""
    from starforge.plans import daily_quality
    st = _st(spark, sf_dir)
    base = work_path(spark, "daily-quality", uuid.uuid4().hex)
    day = {"members": F.pmod(F.xxhash64("tc_hash"), F.lit(3)), "subscriptions": F.pmod(F.xxhash64("subscription_id"), F.lit(3)),
           "payments": F.coalesce(F.year("due_date") % 3, F.lit(0)), "plans": F.lit(0)}
    incoming = f"{base}/incoming"
    for t, of in day.items():  # the days' files, as they would arrive; each table is made once
        getattr(st, t).withColumn("day", of.cast("int")).write.partitionBy("day").parquet(f"{incoming}/{t}")
    for d in range(3):
        part = _with(st, **{t: spark.read.schema(T.StructType([*schemas.STAGING[t], T.StructField("day", T.IntegerType())])).parquet(
            f"{incoming}/{t}").where(F.col("day") == d).drop("day") for t in day})
        daily_quality.add_batch(spark, base, f"d{d}", part, dims.clean_members(part.members).select("member_id"))
    return daily_quality.report(spark, base, AS_OF)


@query("pk_violations")
def q_pk_violations(spark, sf_dir):
    """Q13: key violations of the staging member key, the fact keys before
    insert-ignore, the calendar key, the member version key and the declared surrogate keys."""
    st = _st(spark, sf_dir)
    dm, dp = _dims(st)
    return quality.union_all([
        quality.key_violations(st.members, "staging.members", ["member_id"]),
        quality.key_violations(facts.payment_rows(st.payments, dm, dp), "fact_payments",
                               ["payment_id"]),
        quality.key_violations(facts.lottery_rows(st.lottery, dm, dp), "fact_lottery",
                               ["lottery_id"]),
        quality.key_violations(_dim_date_of_data(st), "dim_date", ["date_key"]),
        quality.key_violations(dm, "dim_member", ["member_id", "version_no"]),
        quality.key_violations(dm, "dim_member", schemas.PRIMARY_KEYS["dim_member"]),
        quality.key_violations(dp, "dim_plan", schemas.PRIMARY_KEYS["dim_plan"]),
    ])


@query("fk_violations")
def q_fk_violations(spark, sf_dir):
    """Fact keys without a dimension row (calendar spine of the fixtures), by business
    id and by the declared surrogate keys; also against the member dimension of the day before,
    which lacks the members that came since."""
    st = _st(spark, sf_dir)
    dm, dp = _dims(st)
    keys = ["member_id", "plan_id", "member_key", "plan_key", "date_key"]
    root = work_path(spark, "foreign-keys", uuid.uuid4().hex)

    def stored(name, fact):  # each of a fact's keys is checked on its own: the fact is made once
        fact.select(*keys).write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    fp = stored("fact_payments", facts.fact_payments(st.payments, dm, dp))
    fl = stored("fact_lottery", facts.fact_lottery(st.lottery, st.payments, dm, dp))
    dd = calendar.dim_date(spark, *SPINE)
    parts = []
    for name, f in [("fact_payments", fp), ("fact_lottery", fl)]:
        parts += [quality.fk_violations(f, name, "member_id", dm, "dim_member", "member_id"),
                  quality.fk_violations(f, name, "plan_id", dp, "dim_plan", "plan_id"),
                  quality.fk_violations(f, name, "date_key", dd, "dim_date", "date_key")]
    child, parent = {"fact_payments": fp, "fact_lottery": fl}, {"dim_member": dm, "dim_plan": dp}
    for name, col, table, key in schemas.FOREIGN_KEYS:
        if table in parent:
            parts.append(quality.fk_violations(child[name], name, col, parent[table], table, key))
        if table == "dim_member":
            parts.append(quality.fk_violations(child[name], name, col, _scd2_inputs(st)[0],
                                               "dim_member, day before", key))
    return quality.union_all(parts)


@query("not_null_violations")
def q_not_null_violations(spark, sf_dir):
    """Q15: NULLs in NOT NULL columns of the loaded tables and in the mandatory fields of staging."""
    st = _st(spark, sf_dir)
    dm, dp = _dims(st)
    return quality.union_all([
        quality.null_violations(_dim_date_of_data(st), "dim_date", ["date_key", "full_date"]),
        quality.null_violations(dm, "dim_member", ["member_id", "valid_from"]),
        quality.null_violations(dp, "dim_plan", ["plan_id"]),
        quality.null_violations(facts.fact_payments(st.payments, dm, dp), "fact_payments",
                                ["payment_id"]),
        quality.null_violations(facts.fact_lottery(st.lottery, st.payments, dm, dp),
                                "fact_lottery", ["lottery_id"]),
        *[quality.null_violations(getattr(st, t), f"staging.{t}", cols) for t, cols in MANDATORY.items()],
    ])


@query("type_bound_violations")
def q_type_bound_violations(spark, sf_dir):
    """Q16: declared VARCHAR / NUMERIC bounds of the staging and the star schema's tables."""
    st = _st(spark, sf_dir)
    dm, dp = _dims(st)
    tables = {f"staging.{t}": (t, getattr(st, t)) for t in schemas.STAGING}
    tables |= {t: (t, df) for t, df in (("dim_member", dm), ("dim_plan", dp), ("fact_payments", _fact_payments(st)),
                                        ("fact_lottery", _fact_lottery(st)))}
    return quality.union_all([
        quality.bound_violations(df, label, schemas.VARCHAR_BOUNDS.get(t, {}), schemas.NUMERIC_BOUNDS.get(t, {}))
        for label, (t, df) in tables.items()])


# ---------------- fault injection ----------------

@query("hash_sample")
def q_hash_sample(spark, sf_dir):
    return inject.hash_sample(_st(spark, sf_dir).payments, "payment_id", 0.10, SEED)


@query("exact_sample")
def q_exact_sample(spark, sf_dir):
    """Exactly int(n * 0.1) payments, those with the smallest hashes."""
    return selection.exact_sample(_st(spark, sf_dir).payments, 0.10, ["payment_id"], SEED)


@query("inject_nulls")
def q_inject_nulls(spark, sf_dir):
    return inject.inject_nulls(_st(spark, sf_dir).members, "member_id", "tc_hash", 0.08, SEED)


@query("inject_duplicates")
def q_inject_duplicates(spark, sf_dir):
    m = inject.inject_nulls(_st(spark, sf_dir).members, "member_id", "tc_hash", 0.08, SEED)
    return inject.inject_duplicates(m, "member_id", 0.03, SEED)


@query("inject_negative")
def q_inject_negative(spark, sf_dir):
    return inject.inject_negative(_st(spark, sf_dir).payments, "payment_id", "paid_amount",
                                  0.005, SEED)


@query("inject_bad_dates")
def q_inject_bad_dates(spark, sf_dir):
    return inject.inject_bad_dates(_st(spark, sf_dir).payments, "payment_id", "paid_date",
                                   "due_date", 0.003, SEED)


# ---------------- profiling ----------------

@query("profile_totals")
def q_profile_totals(spark, sf_dir):
    return profile.totals(_st(spark, sf_dir))


@query("profile_status")
def q_profile_status(spark, sf_dir):
    return profile.status_distribution(_st(spark, sf_dir).members)


@query("profile_city_top10")
def q_profile_city_top10(spark, sf_dir):
    return profile.city_top(_st(spark, sf_dir).members, 10)


@query("profile_income")
def q_profile_income(spark, sf_dir):
    return profile.income_stats(_st(spark, sf_dir).members)


@query("profile_dirty_members")
def q_profile_dirty_members(spark, sf_dir):
    return profile.dirty_members(_st(spark, sf_dir).members)


@query("profile_plans")
def q_profile_plans(spark, sf_dir):
    return profile.plan_listing(_st(spark, sf_dir).plans)


@query("profile_payment_status")
def q_profile_payment_status(spark, sf_dir):
    return profile.payment_status_share(_st(spark, sf_dir).payments)


@query("profile_lateness")
def q_profile_lateness(spark, sf_dir):
    return profile.lateness(_st(spark, sf_dir).payments)


@query("profile_negative_payments")
def q_profile_negative_payments(spark, sf_dir):
    return profile.negative_payments(_st(spark, sf_dir).payments)


@query("profile_lottery")
def q_profile_lottery(spark, sf_dir):
    return profile.lottery_summary(_st(spark, sf_dir).lottery)


@query("profile_lottery_by_plan")
def q_profile_lottery_by_plan(spark, sf_dir):
    st = _st(spark, sf_dir)
    return profile.lottery_by_plan(st.lottery, st.plans)


@query("profile_lottery_trend")
def q_profile_lottery_trend(spark, sf_dir):
    return profile.lottery_trend(_st(spark, sf_dir).lottery, 10)
