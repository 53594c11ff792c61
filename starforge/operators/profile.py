"""Descriptive profiling of the staging tables.

Each function returns a DataFrame instead of printing. Scalars over one table
share one aggregate (one scan). Ratios are rounded half away from zero on
the exact value (integer arithmetic), as SQL ROUND(numeric) does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions.exact import round_ratio, scaled


def totals(staging) -> DataFrame:
    """A1: row counts of the member, payment and lottery tables (one row)."""
    m = staging.members.agg(F.count(F.lit(1)).alias("n_members"))
    p = staging.payments.agg(F.count(F.lit(1)).alias("n_payments"))
    lt = staging.lottery.agg(F.count(F.lit(1)).alias("n_lottery"))
    parts = [m.select(F.col("n_members").alias("n"), F.lit("n_members").alias("k")),
             p.select(F.col("n_payments").alias("n"), F.lit("n_payments").alias("k")),
             lt.select(F.col("n_lottery").alias("n"), F.lit("n_lottery").alias("k"))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # three one-row aggregates pivoted into one row (no join)
    return u.agg(*[F.max(F.when(F.col("k") == k, F.col("n"))).cast("long").alias(k)
                   for k in ("n_members", "n_payments", "n_lottery")])


def counts_by(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """A2 and friends: group count, largest first (ties by value)."""
    out = out or col
    return (df.groupBy(F.col(col).alias(out)).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(out).asc_nulls_last()))


def status_distribution(members: DataFrame) -> DataFrame:
    """A2."""
    return counts_by(members, "status")


def city_top(members: DataFrame, k: int = 10) -> DataFrame:
    """A3: top-k cities by member count (ties broken by city name)."""
    return counts_by(members, "city").limit(k)


def income_stats(members: DataFrame) -> DataFrame:
    """A4: MIN/MAX/AVG/STDDEV_SAMP of income, 2 decimals; NULLs skipped.

    AVG is rounded on the exact sum/count; STDDEV is the sample deviation.
    """
    c = (F.col("income") * 100).cast("decimal(38,0)")  # exact cents; no 64-bit overflow in the sum
    one = members.agg(F.min("income").alias("mn"), F.max("income").alias("mx"),
                      F.sum(c).alias("s"), F.count("income").alias("n"),
                      F.stddev_samp(F.col("income").cast("double")).alias("sd"))
    return one.select(
        F.col("mn").cast("decimal(14,2)").alias("min_income"),
        F.col("mx").cast("decimal(14,2)").alias("max_income"),
        round_ratio(F.col("s"), F.col("n"), 0).cast("decimal(38,0)").alias("_avg_cents"),
        F.round(F.col("sd"), 2).cast("decimal(14,2)").alias("stddev_income"),
    ).select("min_income", "max_income",
             scaled(F.col("_avg_cents"), 2).cast("decimal(14,2)").alias("avg_income"),
             "stddev_income")


def dirty_members(members: DataFrame) -> DataFrame:
    """A5: NULL tc_hash count and the number of non-NULL hashes held by >1 row."""
    nulls = members.agg(F.count_if(F.col("tc_hash").isNull()).alias("n"))
    dup = (members.where(F.col("tc_hash").isNotNull()).groupBy("tc_hash")
                  .agg(F.count(F.lit(1)).alias("c")).agg(F.count_if(F.col("c") > 1).alias("n")))
    u = nulls.select("n", F.lit(0).alias("k")).unionByName(dup.select("n", F.lit(1).alias("k")))
    return u.agg(F.max(F.when(F.col("k") == 0, F.col("n"))).cast("long").alias("null_tc_hash"),
                 F.max(F.when(F.col("k") == 1, F.col("n"))).cast("long").alias("duplicate_tc_hash"))


def plan_listing(plans: DataFrame) -> DataFrame:
    """Plan rows ordered by plan_id."""
    return plans.select("plan_id", "plan_name", "duration_months", "target_amount",
                        "monthly_installment").orderBy(F.col("plan_id").asc_nulls_last(),
                                                       F.col("plan_name").asc_nulls_last())


def share_of_total(df: DataFrame, col: str) -> DataFrame:
    """A6 + W1: count per value and its percentage of all rows (2 decimals).

    SUM(COUNT(*)) OVER () is computed as a scalar subquery over the grouped
    rows (inlined as a constant; AQE reuses the grouping shuffle), so no
    single-partition window gathers the groups and no join is needed.
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n")).scalar()  # over the grouped rows: its shuffle is reused
    # bind the subquery to a column once: every later reference reads the column
    return (g.withColumn("_total", total)
             .withColumn("pct", round_ratio(F.col("n") * 100, F.col("_total"), 2).cast("decimal(5,2)"))
             .drop("_total")
             .orderBy(F.col("n").desc(), F.col(col).asc_nulls_last()))


def payment_status_share(payments: DataFrame) -> DataFrame:
    """A6 on the source status."""
    return share_of_total(payments, "payment_status")


def lateness(payments: DataFrame) -> DataFrame:
    """Over paid rows, average (paid - due) to 1 decimal including early
    payments, the maximum, and the number paid after the due date."""
    paid = payments.where(F.col("paid_date").isNotNull())
    diff = F.datediff("paid_date", "due_date")
    one = paid.agg(F.sum(diff).alias("s"), F.count(diff).alias("n"),
                   F.max(diff).alias("max_days_late"),
                   F.count_if(F.col("paid_date") > F.col("due_date")).alias("n_late"))
    return one.select(round_ratio(F.col("s"), F.col("n"), 1).cast("decimal(10,1)").alias("avg_days_late"),
                      F.col("max_days_late").cast("int").alias("max_days_late"),
                      F.col("n_late").cast("long").alias("n_late"))


def negative_payments(payments: DataFrame) -> DataFrame:
    """Rows with a negative paid amount."""
    return payments.agg(F.count_if(F.col("paid_amount") < 0).cast("long").alias("n_negative"))


def lottery_summary(lottery: DataFrame) -> DataFrame:
    """Entries, winners and win rate in percent (2 decimals, NULL when empty)."""
    one = lottery.agg(F.count(F.lit(1)).alias("n_total"),
                      F.count_if(F.col("is_winner")).alias("n_winners"))
    return one.select(F.col("n_total").cast("long").alias("n_total"),
                      F.col("n_winners").cast("long").alias("n_winners"),
                      round_ratio(F.col("n_winners") * 100, F.col("n_total"), 2)
                      .cast("decimal(5,2)").alias("win_rate"))


def lottery_by_plan(lottery: DataFrame, plans: DataFrame) -> DataFrame:
    """Entries and winners per plan name (inner join on plan_id).

    Entries are counted per plan_id before the join (partial aggregation), so
    the join sees one row per plan instead of one per entry; a plan_id listed
    under several names still counts under each, as the row-level join does.
    """
    per_plan = lottery.groupBy("plan_id").agg(
        F.count(F.lit(1)).alias("c"), F.count_if(F.col("is_winner")).alias("w"))
    j = per_plan.join(plans.select("plan_id", "plan_name"), "plan_id")
    return (j.groupBy("plan_name").agg(F.sum("c").cast("long").alias("n_lottery"),
                                       F.sum("w").cast("long").alias("n_winners"))
             .orderBy(F.col("n_lottery").desc(), F.col("plan_name").asc_nulls_last()))


def lottery_trend(lottery: DataFrame, k: int = 10) -> DataFrame:
    """Top-k months (yyyy-MM) by number of entries."""
    m = F.date_format("lottery_date", "yyyy-MM")
    return (lottery.groupBy(m.alias("month")).agg(F.count(F.lit(1)).alias("n"))
                   .orderBy(F.col("n").desc(), F.col("month").asc_nulls_last()).limit(k))
