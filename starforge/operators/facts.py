"""Fact loads: payments (F1) and lottery (F2/F3) with the paid-before-draw count.

Joins to the dimensions are plain equi-joins: Catalyst/AQE broadcast a
dimension only when its measured size is under the broadcast threshold and use
a sort-merge join otherwise, so a large member dimension is never forced into
executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge.functions import rules
from starforge.functions.calendar import date_key
from starforge.operators.dedupe import first_per_key
from starforge.operators.foreign_keys import within_dates

# First-wins order for a duplicated key (total, so the winner is deterministic).
def payment_order():
    return [
        F.col("due_date").asc_nulls_last(), F.col("paid_date").asc_nulls_first(),
        F.col("plan_id").asc_nulls_last(), F.col("due_amount").asc_nulls_last(),
        F.col("paid_amount").asc_nulls_last(), F.col("member_id").asc_nulls_last(),
        F.col("installment_no").asc_nulls_last(), F.col("subscription_id").asc_nulls_last(),
    ]


def lottery_order():
    return [
        F.col("lottery_date").asc_nulls_last(), F.col("plan_id").asc_nulls_last(),
        F.col("member_id").asc_nulls_last(), F.col("lottery_round").asc_nulls_last(),
        F.col("is_winner").asc_nulls_last(),
    ]


def current_members(dim_member: DataFrame) -> DataFrame:
    """J1 side: the current version of each member (partition-pruned when the
    dimension is stored partitioned by ``is_current``)."""
    return dim_member.where(F.col("is_current")).select("member_id", "member_key", "signup_date")


def _payment_columns(j: DataFrame) -> DataFrame:
    """Date key and R3/R4 of payments that carry the keys of their parents."""
    late = rules.days_late("due_date", "paid_date")
    return j.select(
        "payment_id", "member_key", "plan_key",
        date_key(F.coalesce(F.col("paid_date"), F.col("due_date"))).alias("date_key"),
        "member_id", "plan_id", "subscription_id", "installment_no",
        "due_date", "paid_date", "due_amount", "paid_amount",
        late.alias("days_late"),
        rules.derived_payment_status("paid_date", late).alias("payment_status"),
    )


def _with_parents(payments: DataFrame, dim_member: DataFrame, dim_plan: DataFrame) -> DataFrame:
    """J1 + J2."""
    p = payments.where(F.col("payment_id").isNotNull())
    m = current_members(dim_member).select("member_id", "member_key")
    pl = dim_plan.select("plan_id", "plan_key")
    return p.join(m, "member_id").join(pl, "plan_id")


def payment_rows(payments: DataFrame, dim_member: DataFrame, dim_plan: DataFrame) -> DataFrame:
    """F1 before de-duplication: J1 + J2 + date key + R3/R4 per row."""
    return _payment_columns(_with_parents(payments, dim_member, dim_plan))


def first_payments(taken: DataFrame, keys: tuple[str, ...] = ("payment_id",)) -> DataFrame:
    """F1 of payments that carry the keys of their parents: the first row per payment_id. What can be derived from a row's
    other columns is derived after the shuffle."""
    names = ["payment_id", "member_key", "plan_key", "member_id", "plan_id", "subscription_id", "installment_no",
             "due_date", "paid_date", "due_amount", "paid_amount"]
    rows = taken.where(F.col("payment_id").isNotNull()).select(*names, *[k for k in keys if k not in names and k in taken.columns])
    return _payment_columns(first_per_key(rows, list(keys), payment_order()))


def fact_payments(payments: DataFrame, dim_member: DataFrame, dim_plan: DataFrame) -> DataFrame:
    """payment fact, one row per payment_id (first wins, after the joins)."""
    return first_payments(_with_parents(payments, dim_member, dim_plan))


def paid_before(rows: DataFrame, payments: DataFrame, date_col: str = "lottery_date",
                out: str = "paid_before_lottery", asks: DataFrame | None = None) -> DataFrame:
    """Per row, the number of the member's payments with a paid-like status
    and due date on or before the row's date (across all plans, raw staging rows).

    Rewritten from a per-member nested scan into a running count: payments and
    the dates to answer are aggregated to one row per (member, day) with
    map-side combine (payments due that day, and whether the day is asked),
    then a running sum per member ordered by day gives, on each asked day, the
    payments due on or before it. A member contributes at most one row per
    distinct day to the window, whatever its row count, so a hot member cannot
    overload a task.
    Rows with a NULL date or member get 0. ``asks`` (member_id, date) may name
    a cheaper source of the dates to answer than ``rows`` itself (e.g. the raw
    table before its dimension joins), so ``rows`` is not computed twice.
    """
    return with_counts(rows, paid_counts(payments, rows if asks is None else asks, date_col, out), date_col, out)


def paid_counts(payments: DataFrame, asks: DataFrame, date_col: str = "lottery_date", out: str = "paid_before_lottery") -> DataFrame:
    """The counts of :func:`paid_before` that are above 0: one row per member and asked day."""
    pay = (payments.where(F.col("payment_status").isin(rules.PAID_STATUSES)
                          & F.col("due_date").isNotNull() & F.col("member_id").isNotNull())
                   .select("member_id", F.col("due_date").alias("d"),
                           F.lit(1).alias("n"), F.lit(0).alias("asked")))
    ask = (asks.where(F.col(date_col).isNotNull() & F.col("member_id").isNotNull())
               .select("member_id", F.col(date_col).alias("d"),
                       F.lit(0).alias("n"), F.lit(1).alias("asked")))
    # one row per (member, day): payments due that day and whether the day is asked
    per_day = pay.unionByName(ask).groupBy("member_id", "d").agg(
        F.sum("n").cast("long").alias("n"), F.max("asked").alias("asked"))
    w = Window.partitionBy("member_id").orderBy("d").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (per_day.withColumn("running", F.sum("n").over(w))  # includes the day's own payments
                   .where((F.col("asked") == 1) & (F.col("running") > 0))
                   .select("member_id", F.col("d").alias(date_col),
                           F.col("running").cast("long").alias(out)))


def with_counts(rows: DataFrame, counts: DataFrame, date_col: str = "lottery_date", out: str = "paid_before_lottery") -> DataFrame:
    """Rows with their :func:`paid_counts`, 0 where there is none."""
    j = rows.join(counts, ["member_id", date_col], "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("long")))


def lottery_columns(j: DataFrame) -> DataFrame:
    """F2 of lottery entries that carry the keys of their parents and the signup date."""
    return j.where(F.col("lottery_id").isNotNull()).select(
        "lottery_id", "member_key", "plan_key",
        date_key("lottery_date").alias("date_key"),
        "member_id", "plan_id", "lottery_date", "lottery_round", "is_winner",
        "signup_date")


def lottery_rows(lottery: DataFrame, dim_member: DataFrame, dim_plan: DataFrame) -> DataFrame:
    """lottery entries joined to the current member (with signup date) and plan."""
    lt = lottery.where(F.col("lottery_id").isNotNull())
    m = current_members(dim_member)
    pl = dim_plan.select("plan_id", "plan_key")
    return lottery_columns(lt.join(m, "member_id").join(pl, "plan_id"))


def with_ratio(rows: DataFrame, payments: DataFrame, asks: DataFrame | None = None) -> DataFrame:
    """F3 of the rows of F2: the cumulative paid ratio (J3 + R10 + R11) of the first row per lottery_id."""
    return with_ratio_of(rows, paid_counts(payments, rows if asks is None else asks))


def with_ratio_of(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """:func:`with_ratio` from :func:`paid_counts` that cover the days of the rows."""
    base = with_counts(first_per_key(rows, ["lottery_id"], lottery_order()), counts)
    months = rules.months_elapsed("signup_date", "lottery_date")
    out = (base.withColumn("months_elapsed", months)
               .withColumn("cumulative_paid_ratio",
                           rules.capped_ratio("paid_before_lottery", "months_elapsed")))
    return out.select(
        "lottery_id", "member_key", "plan_key", "date_key", "member_id", "plan_id",
        "lottery_date", "signup_date", "lottery_round", "is_winner",
        "paid_before_lottery", "months_elapsed", "cumulative_paid_ratio")


def fact_lottery(lottery: DataFrame, payments: DataFrame, dim_member: DataFrame,
                 dim_plan: DataFrame, observation=None, dim_date: DataFrame | None = None) -> DataFrame:
    """lottery fact with the cumulative paid ratio (J3 + R10 + R11 + S5).

    With ``observation`` the joined rows are counted before insert-ignore
    (metric ``rows``), as the load reports them. With ``dim_date`` rows whose date
    key has no parent there are left out (J7).
    """
    rows = lottery_rows(lottery, dim_member, dim_plan)
    if observation is not None:
        rows = rows.observe(observation, F.count(F.lit(1)).alias("rows"))
    if dim_date is not None:
        rows = within_dates(rows, dim_date)
    return with_ratio(rows, payments, asks=lottery.select("member_id", "lottery_date"))
