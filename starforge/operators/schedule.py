"""Installment schedule (R16) and payment risk boost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions import rules
from starforge.operators.calendar import flag_near_holiday


def installment_schedule(subs: DataFrame, key: str, start: str, duration: str, as_of) -> DataFrame:
    """One row per month k = 0..duration-1 with due = start + k months (day
    clipped, always counted from the start), stopping at the first due date
    after ``as_of``; installment_no = k + 1. Duration 0 or NULL gives no rows.

    ``explode(sequence)`` runs inside each task; a row's output is bounded by
    its duration and by the months up to ``as_of`` (months after it are never
    generated), so no group is gathered anywhere.
    """
    d = F.col(duration).cast("int")
    start_c, asof_c = F.col(start), F.lit(as_of)
    # months from start to as_of: no due date beyond month m can be on or before as_of
    m = ((F.year(asof_c) - F.year(start_c)) * 12 + (F.month(asof_c) - F.month(start_c))).cast("int")
    last = F.when(d > 0, F.least(d - 1, m))  # NULL (no rows) for a 0 or NULL duration
    ks = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    rows = subs.select(F.col(key), F.col(start).alias("_start"), F.explode(ks).alias("_k"))
    due = F.add_months(F.col("_start"), F.col("_k"))
    return (rows.select(F.col(key), (F.col("_k") + 1).cast("int").alias("installment_no"),
                        due.alias("due_date"))
                .where(F.col("due_date") <= F.lit(as_of)))


def payment_risk_boost(payments: DataFrame, holidays: DataFrame, window: int = 7) -> DataFrame:
    """Seasonal boost (+5 in January and July) plus holiday boost (+10 when
    the due date is within ``window`` days before a holiday)."""
    flagged = flag_near_holiday(payments, "due_date", holidays, window)
    return flagged.select(
        "payment_id", "installment_no", "due_date",
        rules.seasonal_boost("due_date").alias("seasonal_boost"),
        F.when(F.col("near_holiday"), rules.HOLIDAY_BOOST).otherwise(0).cast("int").alias("holiday_boost"),
    ).withColumn("total_boost", (F.col("seasonal_boost") + F.col("holiday_boost")).cast("int"))


def income_profile(members: DataFrame) -> DataFrame:
    """Income tier and lateness surcharge per member row."""
    return members.select("member_id", "income",
                          rules.income_tier("income").alias("income_tier"),
                          rules.late_surcharge("income").alias("late_surcharge"))
