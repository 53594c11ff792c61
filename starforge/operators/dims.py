"""Dimension loads: clean members (P2 + W2), member rows (R6), plans (D2 + R5), keys (G1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions import rules
from starforge.operators.dedupe import first_per_key

PLAN_COLUMNS = ["plan_id", "plan_name", "plan_type", "duration_months", "target_amount"]
MEMBER_SOURCE_COLUMNS = ["member_id", "full_name", "tc_hash", "city", "district",
                         "birth_year", "income", "signup_date", "status"]
# Reasons of rejected member rows.
NO_MEMBER_ID, OTHER_HASH_KEPT = "no member_id", "another hash of the member is kept"


def clean_members(members: DataFrame) -> DataFrame:
    """P2 + W2: rows with a non-empty hash, newest signup per hash.

    DISTINCT ON (tc_hash) ORDER BY tc_hash, signup_date DESC: the descending
    order puts NULL signup dates first (as PostgreSQL does); member_id and
    status complete the order so the winner is deterministic.
    """
    src = members.select(*MEMBER_SOURCE_COLUMNS).where(
        F.col("tc_hash").isNotNull() & (F.col("tc_hash") != ""))
    return first_per_key(src, ["tc_hash"], [
        F.col("signup_date").desc_nulls_first(),
        F.col("member_id").asc_nulls_last(),
        F.col("status").asc_nulls_last(),
    ])


def one_row_per_member(clean: DataFrame) -> DataFrame:
    """Keep one clean row per member_id (the greatest hash); see T8 in the README. The
    others, and rows without an id, are the rows of :func:`rejected_members`."""
    return first_per_key(clean.where(F.col("member_id").isNotNull()), ["member_id"],
                         [F.col("tc_hash").desc_nulls_last()])


def rejected_members(members: DataFrame) -> DataFrame:
    """Clean rows that a versioned dimension with one current row per member can't take, with
    the reason. The kept hash per member is an aggregate with map-side combine and the
    join's hot keys are split by AQE, so no member's rows gather in one task."""
    clean = clean_members(members)
    kept = clean.where(F.col("member_id").isNotNull()).groupBy("member_id").agg(F.max("tc_hash").alias("kept_hash"))
    other = clean.join(kept, "member_id").where(F.col("tc_hash") != F.col("kept_hash"))
    return other.select(*MEMBER_SOURCE_COLUMNS, F.lit(OTHER_HASH_KEPT).alias("reason")).unionByName(
        clean.where(F.col("member_id").isNull()).select(*MEMBER_SOURCE_COLUMNS, F.lit(NO_MEMBER_ID).alias("reason")))


def member_rows(clean: DataFrame, as_of, keep: list[str] = ()) -> DataFrame:
    """Dimension attributes of clean member rows, as a new current version."""
    return clean.select(*keep,
        "member_id", "full_name", "tc_hash", "city", "district",
        rules.age_group("birth_year", as_of).alias("age_group"),
        rules.income_bracket("income").alias("income_bracket"),
        "signup_date",
        F.col("status").alias("member_status"),
        rules.churn_date("status", as_of).alias("churn_date"),
        F.coalesce(F.col("signup_date"), F.lit(as_of).cast("date")).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def member_key(member_id="member_id", version_no="version_no"):
    """G1: deterministic surrogate key of one member version (no global sort)."""
    return F.xxhash64(F.col(member_id), F.col(version_no).cast("int"))


def null_safe_key(*columns: str):
    """Hash of all columns in which a NULL keeps its place (xxhash64 alone skips NULLs)."""
    return F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def dim_member_full(members: DataFrame, as_of) -> DataFrame:
    """D3: full-refresh member dimension (first version of every clean row).

    A member_id under several hashes has a row for each, as in the source; the
    key therefore covers the hash, and NULL ids.
    """
    rows = member_rows(clean_members(members), as_of)
    rows = rows.withColumn("version_no", F.lit(1))
    return rows.select(null_safe_key("member_id", "version_no", "tc_hash").alias("member_key"), *rows.columns)


def dim_plan(plans: DataFrame) -> DataFrame:
    """DISTINCT over the five plan columns, installment re-derived (R5), hash key (G1).

    A plan_id with several distinct variants yields several rows, as in the
    source; the key hashes all five columns so it is stable across runs.
    """
    d = plans.select(*PLAN_COLUMNS).distinct()
    return d.select(
        null_safe_key(*PLAN_COLUMNS).alias("plan_key"),
        *PLAN_COLUMNS,
        rules.monthly_installment("target_amount", "duration_months").alias("monthly_installment"),
    )
