"""Slowly changing member dimension, type 2 (D4 classify, D5 apply, D6 counters).

Set-based, in one pass: the *current* rows and the day's clean batch (already
shaped as dimension rows) are put side by side and marked per member with a
window partitioned by member_id (the current rows are shuffled once, no join); closed rows, kept rows
and new versions all come out of that one pass. No per-row lookups and no
MERGE. Only current rows are read; closed history never changes again, so it
is never re-read or rewritten and the cost of a day grows with the number of
members, not with the history length (see :mod:`starforge.sources.snapshots`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from starforge import schemas
from starforge.operators.dims import clean_members, member_key, member_rows, one_row_per_member, rejected_members

INSERT, UPDATE, SKIP, REJECT = "insert", "update", "skip", "reject"
DIM_COLUMNS = [f.name for f in schemas.DIM_MEMBER.fields]


def empty_dim_member(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.DIM_MEMBER)


def _marked(current: DataFrame, members: DataFrame, as_of, clean_rows: Observation | None = None) -> DataFrame:
    """Current rows and the day's transformed batch rows side by side, each row
    marked with its member's action. One shuffle by member_id, no join.

    The window per member holds the member's current row(s) plus at most one
    batch row, so no group grows with the data.
    """
    clean = clean_members(members)
    if clean_rows is not None:
        clean = clean.observe(clean_rows, F.count(F.lit(1)).alias("rows"))
    batch = member_rows(one_row_per_member(clean), as_of).select(
        F.lit(None).cast("long").alias("member_key"), "*",
        F.lit(None).cast("int").alias("version_no"), F.lit(1).alias("_src"))
    cur = current.where(F.col("is_current")).select(*DIM_COLUMNS, F.lit(0).alias("_src"))
    u = cur.unionByName(batch.select(*DIM_COLUMNS, "_src"))
    w = Window.partitionBy("member_id")
    is_b = F.col("_src") == 1
    u = u.select(
        "*",
        F.max(F.when(~is_b, F.col("version_no"))).over(w).alias("_cur_version"),
        F.max(F.when(~is_b, F.col("member_status"))).over(w).alias("_cur_status"),
        F.max(F.when(is_b, F.col("member_status"))).over(w).alias("_new_status"),
        F.max(is_b.cast("int")).over(w).alias("_has_batch"),
    )
    cur_s, new_s = F.col("_cur_status"), F.col("_new_status")
    action = (F.when(F.col("_has_batch") == 0, F.lit(None).cast("string"))
              .when(cur_s.isNull(), INSERT)
              .when(~cur_s.eqNullSafe(new_s), UPDATE)
              .otherwise(SKIP))
    return u.withColumn("action", action)


def scd2_classify(dim: DataFrame, members: DataFrame, as_of) -> DataFrame:
    """Action per clean staging member against the current rows.

    insert: no current row, or its status is NULL (both look the same to a
    status lookup); update: the status differs (NULL-aware); skip: same status.
    Only the status is tracked; other attribute changes do not make a version.
    """
    m = _marked(dim, members, as_of)
    return m.where(F.col("_src") == 1).select("member_id", "action")


def scd2_delta(current: DataFrame, members: DataFrame, as_of,
               observation: Observation | None = None, clean_rows: Observation | None = None) -> DataFrame:
    """D5 on the current rows only: the new current set (is_current = true) plus
    the rows closed today (is_current = false), as one DataFrame / one write.

    Every member that gets a new version has its current row(s) closed
    (valid_to = as_of, is_current = false); the new version is current with
    valid_from = signup date and version_no = previous version + 1. Members
    missing from staging keep their current row. With ``observation`` the D6
    counters (inserted / updated / skipped) are collected during the write, with
    ``clean_rows`` the number of clean rows read (metric ``rows``).
    """
    m = _marked(current, members, as_of, clean_rows)
    a = F.col("action")
    if observation is not None:
        b = F.col("_src") == 1
        m = m.observe(observation, F.count_if(b & (a == INSERT)).alias(INSERT),
                      F.count_if(b & (a == UPDATE)).alias(UPDATE),
                      F.count_if(b & (a == SKIP)).alias(SKIP))
    changed = a.isin(INSERT, UPDATE)
    is_b = F.col("_src") == 1
    version = F.when(is_b, (F.coalesce(F.col("_cur_version"), F.lit(0)) + 1).cast("int")) \
        .otherwise(F.col("version_no"))
    out = (m.where(~is_b | changed)
            .withColumn("version_no", version)
            .withColumn("member_key", F.when(is_b, member_key()).otherwise(F.col("member_key")))
            .withColumn("valid_to", F.when(~is_b & changed, F.lit(as_of).cast("date"))
                        .otherwise(F.col("valid_to")))
            .withColumn("is_current", F.when(~is_b & changed, F.lit(False))
                        .otherwise(F.col("is_current"))))
    return out.select(*DIM_COLUMNS)


def scd2_apply(dim: DataFrame, members: DataFrame, as_of,
               observation: Observation | None = None) -> DataFrame:
    """D5 on a whole dimension: unchanged history, plus today's delta."""
    history = dim.where(~F.col("is_current"))
    return history.select(*DIM_COLUMNS).unionByName(
        scd2_delta(dim.where(F.col("is_current")), members, as_of, observation))


def scd2_counts(dim: DataFrame, members: DataFrame, as_of) -> DataFrame:
    """Inserted / updated / skipped / rejected; their sum is the number of clean rows read."""
    actions = scd2_classify(dim, members, as_of).select("action").unionByName(
        rejected_members(members).select(F.lit(REJECT).alias("action")))
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))
