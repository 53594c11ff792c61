"""Every operator runs to completion on staging tables full of NULLs (ANSI mode
raises on bad casts or arithmetic, so this catches unguarded expressions)."""

import datetime as dt

from starforge.operators import calendar, dims, facts, inject, profile, quality, scd2, schedule
from starforge.sources.adapter import AS_OF, staging_from_driver


class _St:
    pass


def _nulled(df, key, cols, seed):
    for i, c in enumerate(cols):
        df = inject.inject_nulls(df, key, c, 0.2, seed + i)
    return df


def test_operators_survive_null_heavy_staging(spark):
    src = staging_from_driver(spark, "/root/testdata/sf0.001")
    st = _St()
    st.members = _nulled(src.members, "full_name", ["member_id", "tc_hash", "birth_year", "birth_date",
                                                    "income", "signup_date", "status"], 1)
    st.plans = _nulled(src.plans, "plan_name", ["plan_id", "plan_type", "duration_months",
                                                "target_amount"], 20)
    st.subscriptions = _nulled(src.subscriptions, "start_date", ["subscription_id", "member_id"], 30)
    st.payments = _nulled(src.payments, "due_amount", ["payment_id", "member_id", "plan_id", "due_date",
                                                       "paid_date", "due_amount", "paid_amount",
                                                       "payment_status", "subscription_id"], 40)
    st.lottery = _nulled(src.lottery, "lottery_round", ["lottery_id", "member_id", "plan_id",
                                                         "lottery_date", "is_winner"], 60)
    dm = dims.dim_member_full(st.members, AS_OF)
    dp = dims.dim_plan(st.plans)
    hol = calendar.holiday_calendar(spark)
    jobs = [
        dm, dp, scd2.scd2_apply(dm, st.members, AS_OF + dt.timedelta(1)),
        scd2.scd2_counts(dm, st.members, AS_OF),
        facts.fact_payments(st.payments, dm, dp), facts.fact_lottery(st.lottery, st.payments, dm, dp),
        quality.dq_report(st, dm, AS_OF),
        quality.key_violations(st.payments, "p", ["payment_id"]),
        quality.bound_violations(st.members, "m", {"member_id": 20}, {"income": (12, 2)}),
        profile.totals(st), profile.income_stats(st.members), profile.dirty_members(st.members),
        profile.payment_status_share(st.payments), profile.lateness(st.payments),
        profile.lottery_summary(st.lottery), profile.lottery_by_plan(st.lottery, st.plans),
        profile.lottery_trend(st.lottery), profile.city_top(st.members),
        calendar.flag_near_holiday(st.payments, "due_date", hol),
        schedule.payment_risk_boost(st.payments, hol),
        schedule.installment_schedule(st.lottery.join(st.plans, "plan_id"), "lottery_id",
                                      "lottery_date", "duration_months", AS_OF),
        schedule.income_profile(st.members),
        inject.inject_negative(st.payments, "payment_id"), inject.inject_bad_dates(st.payments, "payment_id"),
    ]
    for df in jobs:
        df.write.format("noop").mode("overwrite").save()
