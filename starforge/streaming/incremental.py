"""Incremental daily loads as Structured Streaming jobs (SCD2 member
dimension, and the payment fact, which ``load`` and batches share: a table state
names the folders of both, see :mod:`starforge.sources.table_state`).

New staging member files land in a folder; ``trigger(availableNow=True)``
processes whatever arrived since the last run and stops. Each micro-batch is
one day's staging snapshot: ``foreachBatch`` applies SCD2 against the newest
complete dimension snapshot and writes a new snapshot named after the batch
id. The streaming checkpoint records which files were consumed; a replayed
batch rewrites the same snapshot directory, so recovery after a lost
executor or driver restart is idempotent.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge import schemas
from starforge.operators import dims, facts, foreign_keys, scd2
from starforge.operators.dedupe import first_per_key
from starforge.sources import snapshots as snap
from starforge.sources.table_state import KEPT_STATES, TableState, drop_unnamed, publish, read_state

FACT, KEYS, REPLACED = "fact_payments", "fact_payments_keys", "fact_payments_replaced"
PENDING, REJECTS = "payments_pending", "fact_payments_rejects"
#: Keys of one bucket of the index, and bounds of the number of buckets (fixed at a full load or compaction).
KEYS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 1_000_000, 16, 4096


def scd2_batch_writer(spark: SparkSession, base: str, as_of: dt.date, prefix: str | None = None):
    prefix = prefix or as_of.strftime("%Y%m%d")

    def write(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{prefix}-{batch_id:09d}"
        prev = snap.read_scd2_current(spark, base, "dim_member", schemas.DIM_MEMBER, before=run_id)
        prev = scd2.empty_dim_member(spark) if prev is None else prev
        delta = scd2.scd2_delta(prev, batch, as_of)
        snap.write_snapshot(dims.rejected_members(batch), base, "dim_member_rejects", run_id)
        snap.write_snapshot(delta, base, "dim_member", run_id, partition_by=["is_current"])

    return write


def _source(spark: SparkSession, schema, incoming: str, max_files: int | None) -> DataFrame:
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")  # any folder layout
    if max_files:
        # one day's drop per micro-batch when several days are pending
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(incoming)


def run_incremental_scd2(spark: SparkSession, incoming: str, base: str, checkpoint: str,
                         as_of: dt.date, prefix: str | None = None,
                         max_files_per_trigger: int | None = None) -> None:
    """Consume all member files that arrived in ``incoming`` and stop.

    Run once per daily drop: files that arrive together form one batch, i.e.
    one day's staging snapshot. If several days are pending and each day is
    one file, ``max_files_per_trigger=1`` keeps them in separate batches.
    """
    stream = _source(spark, schemas.STAGING_MEMBERS, incoming, max_files_per_trigger)
    q = (stream.writeStream
               .foreachBatch(scd2_batch_writer(spark, base, as_of, prefix))
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()


def _path(base: str, table: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{table}/run_id={run_id}"


def _folders(spark: SparkSession, base: str, table: str, runs, schema) -> DataFrame | None:
    """The folders of ``runs`` that ``table`` has."""
    have = set(snap.snapshot_runs(spark, base, table)) if runs else set()
    paths = [_path(base, table, r) for r in runs if r in have]
    if not paths:
        return None
    rows = spark.read.schema(schema).option("basePath", f"{base.rstrip('/')}/{table}").parquet(*paths)
    return rows.drop("run_id")


def _without_replaced(rows: DataFrame, replaced: DataFrame | None) -> DataFrame:
    """Drop the unpaid row of every payment that a later batch brought paid."""
    if replaced is None:
        return rows
    unpaid = F.col("paid_date").isNull()
    return rows.where(~unpaid).unionByName(rows.where(unpaid).join(replaced, "payment_id", "left_anti"))


def fact_batches(spark: SparkSession, base: str, table: str = FACT, version: int | None = None) -> DataFrame | None:
    """The payment fact: the last full load and all batches since, as the newest state (or that of ``version``) names
    them; None when there is none. Paid rows pass as they are; unpaid ones are held against the ids that batches replaced."""
    state = read_state(spark, base, table, version)
    rows = _folders(spark, base, table, state.folders, schemas.FACT_PAYMENTS)
    return None if rows is None else _without_replaced(rows, _folders(spark, base, REPLACED, state.batches, "payment_id string"))


def pending_payments(spark: SparkSession, base: str, state: TableState | None = None) -> DataFrame | None:
    """Staging rows that wait for their member or plan. Of one instalment that waits unpaid in one folder and paid in a
    later one, the paid row counts."""
    state = state or read_state(spark, base, FACT)
    names = schemas.STAGING_PAYMENTS.fieldNames()
    parts = [p.withColumn("_at", F.lit(i)) for i, r in enumerate(state.pending)
             if (p := _folders(spark, base, PENDING, [r], schemas.STAGING_PAYMENTS)) is not None]
    if not parts:
        return None
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    if len(parts) == 1:
        return rows.select(*names)
    paid = F.col("paid_date").isNotNull()
    last_paid = rows.where(paid).groupBy("payment_id", "due_date").agg(F.max("_at").alias("_paid_at"))
    unpaid = rows.where(~paid).join(last_paid, ["payment_id", "due_date"], "left").where(F.coalesce(F.col("_at") >= F.col("_paid_at"), F.lit(True)))
    return rows.where(paid).select(*names).unionByName(unpaid.select(*names))


# ---- S5: the index of held keys
# KEYS holds (payment_id, due_date, paid) of every fact row in folders by hash bucket, each file sorted by payment_id.

KEY_SCHEMA = "payment_id string, due_date date, paid boolean, bucket int"


def key_bucket(buckets: int):
    return F.pmod(F.xxhash64("payment_id"), F.lit(buckets)).cast("int")


def _write_keys(spark: SparkSession, base: str, run_id: str, fact: DataFrame, buckets: int) -> None:
    keys = fact.select("payment_id", "due_date", F.col("paid_date").isNotNull().alias("paid"), key_bucket(buckets).alias("bucket"))
    keys.repartition("bucket").sortWithinPartitions("bucket", "payment_id").write.mode("overwrite").partitionBy("bucket").parquet(_path(base, KEYS, run_id))


def buckets_for(rows: int) -> int:
    """Buckets of the key index of a fact of so many rows: about KEYS_PER_BUCKET keys in each, at most MOST_BUCKETS."""
    return max(LEAST_BUCKETS, min(MOST_BUCKETS, -(-rows // KEYS_PER_BUCKET)))


def index_base(spark: SparkSession, base: str, state: TableState) -> TableState:
    """Index the keys of the base, once, when the first batch needs them (a full load need not wait for it)."""
    if state.base is None or state.indexed:
        return state
    fact = _folders(spark, base, FACT, [state.base], schemas.FACT_PAYMENTS)
    buckets = buckets_for(fact.count())
    _write_keys(spark, base, state.base, fact, buckets)
    return publish(spark, base, FACT, replace(state, buckets=buckets, indexed=True))


def held_keys(spark: SparkSession, base: str, state: TableState, buckets: list[int]) -> DataFrame | None:
    """Index rows in ``buckets`` (at most MOST_BUCKETS numbers): the filter on the folder column leaves all other folders unread."""
    rows = _folders(spark, base, KEYS, state.folders, KEY_SCHEMA)
    return None if rows is None else rows.where(F.col("bucket").isin(buckets))


def newest_parents(spark: SparkSession, base: str) -> tuple[str, ...]:
    runs = [snap.snapshot_runs(spark, base, t) for t in ("dim_member", "dim_plan")]
    if not all(runs):
        raise RuntimeError("no complete dimension snapshot to load payments against")
    return tuple(r[-1] for r in runs)


def load_payments(spark: SparkSession, base: str, batch: DataFrame, run_id: str) -> None:
    """One batch of staging payments on top of the fact (F1, S5), whether ``load`` or batches have made it.

    The batch is held against its parents and written first, so its keys' buckets are known; of the held keys only those buckets are read. Rows
    whose member or plan is missing are added to the waiting ones, which are tried again when a dimension has a newer
    run than they were last held against: a batch in between costs the same however many rows wait. Rows with a NULL
    payment, member or plan id can match nothing and are left out, as in the full load. A batch that the fact already
    has changes nothing; one that did not get so far starts again from the newest state.
    """
    def put(df: DataFrame, table: str) -> DataFrame:
        df.write.mode("overwrite").parquet(_path(base, table, run_id))
        return spark.read.schema(df.schema).parquet(_path(base, table, run_id))

    state = read_state(spark, base, FACT)
    if run_id in state.batches:
        return
    state = index_base(spark, base, state)
    parents = newest_parents(spark, base)
    dm = snap.read_scd2_current(spark, base, "dim_member", schemas.DIM_MEMBER, upto=parents[0])
    dp = snap.read_latest(spark, base, "dim_plan", upto=parents[1])
    dd = snap.read_latest(spark, base, "dim_date")
    names = schemas.STAGING_PAYMENTS.fieldNames()
    paid = F.col("paid_date").isNotNull()

    rows = batch.select(*names)
    retry = state.pending and state.parents != parents
    if retry:  # of one instalment, unpaid while it waited and paid now, the paid row counts
        waiting = pending_payments(spark, base, state)
        now_paid = rows.where(paid).select("payment_id", "due_date").distinct()
        rows = rows.unionByName(waiting.where(paid)).unionByName(
            waiting.where(~paid).join(now_paid, ["payment_id", "due_date"], "left_anti"))
    rows = rows.where(F.col("payment_id").isNotNull() & F.col("member_id").isNotNull() & F.col("plan_id").isNotNull())
    against = put(foreign_keys.held_against(rows, F.coalesce("paid_date", "due_date"), dm, dp, dd), "payments_against")
    rejected = put(foreign_keys.rejected(against, names), REJECTS)
    put(waiting_rows(rejected), PENDING)

    fresh = foreign_keys.taken(against)
    touched = [r[0] for r in fresh.select(key_bucket(state.buckets)).distinct().collect()]  # at most MOST_BUCKETS
    held = held_keys(spark, base, state, touched)
    if held is None:
        new = facts.first_payments(fresh)
    else:
        held = put(held.join(fresh.select("payment_id"), "payment_id", "left_semi").groupBy("payment_id").agg(
            F.max("paid").alias("paid"), F.max("due_date").alias("due_date")), "payments_held")  # the one row of an id, or an unpaid one and its paid successor
        arrived = facts.first_payments(fresh.withColumn("_paid", paid), ("payment_id", "due_date", "_paid"))
        known = held.select("payment_id", F.col("paid").alias("_held_paid"), F.col("due_date").alias("_held_due"))
        now_paid = paid & ~F.col("_held_paid") & (F.col("due_date") == F.col("_held_due"))
        new = arrived.join(known, "payment_id", "left").where(F.col("_held_paid").isNull() | now_paid).drop("_held_paid", "_held_due")
        new = first_per_key(new, ["payment_id"], facts.payment_order())
    new = put(schemas.conform(new, schemas.FACT_PAYMENTS).sortWithinPartitions("date_key"), FACT)
    if held is not None:  # what came although its id was held came paid
        put(held.select("payment_id").join(new.select("payment_id"), "payment_id", "left_semi"), REPLACED)
    _write_keys(spark, base, run_id, new, state.buckets)
    # what waits now has been held against these dimensions, unless older rows were not tried
    old = () if retry else state.pending
    publish(spark, base, FACT, state.with_batch(run_id, (*old, run_id), parents if retry or not old else state.parents))
    for table in ("payments_against", "payments_held"):
        snap.remove(spark, _path(base, table, run_id))


def waiting_rows(rejected: DataFrame) -> DataFrame:
    """Rejected staging rows that a later member or plan can still take."""
    ids = F.col("payment_id").isNotNull() & F.col("member_id").isNotNull() & F.col("plan_id").isNotNull()
    return rejected.where(ids & F.col("reason").isin(foreign_keys.NO_MEMBER, foreign_keys.NO_PLAN)).select(*schemas.STAGING_PAYMENTS.fieldNames())


def retry_pending_payments(spark: SparkSession, base: str) -> None:
    """Try the pending payments again without new ones (e.g. after a member load), as a batch that comes right after
    the newest folder (``<newest>-retry0001`` and so on). Nothing to do while the dimensions are those last tried."""
    state = read_state(spark, base, FACT)
    if not state.folders or not state.pending or state.parents == newest_parents(spark, base):
        return
    stem, _, n = state.folders[-1].partition("-retry")
    load_payments(spark, base, spark.createDataFrame([], schemas.STAGING_PAYMENTS), f"{stem}-retry{int(n or 0) + 1:04d}")


def compact_payments(spark: SparkSession, base: str) -> str | None:
    """Fold the batches and what they replaced into one new base, in order of date, and index its keys; the waiting rows
    become one folder. One publication switches readers over. Returns the new base, None if there are no batches."""
    state = read_state(spark, base, FACT)
    if not state.batches:
        return None
    run_id = f"{state.folders[-1]}-c{state.version:06d}"
    fact_batches(spark, base).repartitionByRange("date_key").sortWithinPartitions("date_key").write.mode("overwrite").parquet(_path(base, FACT, run_id))
    fact = _folders(spark, base, FACT, [run_id], schemas.FACT_PAYMENTS)
    buckets = buckets_for(fact.count())
    _write_keys(spark, base, run_id, fact, buckets)
    waiting = pending_payments(spark, base, state)
    if waiting is not None:
        waiting.write.mode("overwrite").parquet(_path(base, PENDING, run_id))
    publish(spark, base, FACT, replace(state, base=run_id, batches=(), pending=() if waiting is None else (run_id,), buckets=buckets, indexed=True))
    return run_id


def drop_unnamed_payments(spark: SparkSession, base: str, keep: int = KEPT_STATES) -> list[str]:
    """S4 for the payment fact: folders of fact, index, replaced, waiting and rejected rows that no kept state names."""
    return drop_unnamed(spark, base, FACT, (KEYS, REPLACED, PENDING, REJECTS), keep)


def run_incremental_payments(spark: SparkSession, incoming: str, base: str, checkpoint: str,
                             prefix: str, max_files_per_trigger: int | None = None) -> None:
    """Consume all staging payment files that arrived in ``incoming`` and stop.
    Batches may be any size: the result is the same however the files are
    grouped, up to which of several rows that share a payment_id wins."""
    stream = _source(spark, schemas.STAGING_PAYMENTS, incoming, max_files_per_trigger)
    q = (stream.writeStream
               .foreachBatch(lambda batch, batch_id: load_payments(spark, base, batch, f"{prefix}-{batch_id:09d}"))
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
