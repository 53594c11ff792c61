"""Q1-Q12 on what is new: a data-quality report that adds each batch to the counts of all batches before.

A batch's rows are read once. What is kept of them lies in two tables whose rows only ever add up:

* ``dq_counts``: one row per rule. A rule that depends on the report's date (age) has one row per date of birth
  instead, so a report can be made for any day.
* ``dq_keys``: (topic, bucket, key, n, p), in folders by topic and hash bucket. For a duplicate rule n is the rows of a key. For a
  reference n is the child rows that wait for their parent and p is 1 where the parent is known.

A batch changes a rule's count only through keys that it brings: a key becomes a duplicate with its second row, child rows
whose parent is unknown are orphans, and a parent that comes later takes back the orphans that waited for it. So a
batch reads only the buckets of its own keys, and of the rows before none. Its folders are written first and become
part of the tables by one rename (:mod:`starforge.sources.table_state`); a batch that the state has already changes nothing,
one that was lost before its publication is written again. :func:`compact` folds all batches into one.

Defined results: as in ``quality.dq_report`` over the rows of all batches (a NULL key is a group of the duplicate rules and an
orphan of the references). A member is known once any batch brought a version of it. Without batches the report is empty.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.functions import rules
from starforge.operators import quality
from starforge.sources import snapshots as snap
from starforge.sources.table_state import TableState, drop_unnamed, publish, read_state
from starforge.streaming.incremental import buckets_for

COUNTS, KEYS, BROUGHT = "dq_counts", "dq_keys", "dq_brought"
COUNT_SCHEMA = "rule string, table_name string, n long, threshold long, birth_date date"
KEY_SCHEMA = "key string, n long, p long, change long, topic string, bucket int"
UNDERAGE = "Underage members"
DUPLICATES = {f"duplicate-{source}": (rule, table, source, keys[0]) for rule, table, source, keys in quality.DUPLICATE_RULES}
#: topic: (rule, table), child table, key
REFERENCES = {"orphan-payments": (quality.ORPHAN_PAYMENTS, "payments", "subscription_id"),
              "orphan-subscriptions": (quality.FK_FACT_MEMBER, "subscriptions", "member_id")}


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def _brought(staging, member_ids: DataFrame, buckets: int) -> DataFrame:
    """(topic, key, bucket, n, p) of the batch: rows per key, and whether it brings the key's parent. Combined
    where the rows are read, so a hot key is one row a task."""
    def entry(topic: str, column: str, n: int, p: int) -> Column:
        return F.struct(F.lit(topic).alias("topic"), F.col(column).cast("string").alias("key"),
                        F.lit(n).cast("long").alias("n"), F.lit(p).cast("long").alias("p"))

    entries: dict[str, list[Column]] = {}
    for topic, (_, _, source, key) in DUPLICATES.items():
        entries.setdefault(source, []).append(entry(topic, key, 1, 0))
    for topic, (_, child, key) in REFERENCES.items():
        entries.setdefault(child, []).append(entry(topic, key, 1, 0))
    entries["subscriptions"].append(entry("orphan-payments", "subscription_id", 0, 1))
    frames = {t: getattr(staging, t) for t in entries} | {"member_ids": member_ids}
    entries["member_ids"] = [entry("orphan-subscriptions", "member_id", 0, 1)]
    parts = [frames[t].select(F.explode(F.array(*e)).alias("x")).select("x.*") for t, e in entries.items()]
    parts = [x.where((F.col("p") == 0) | F.col("key").isNotNull()) for x in parts]  # a NULL is nobody's parent
    rows = quality.union_all(parts).groupBy("topic", "key").agg(F.sum("n").alias("n"), F.max("p").alias("p"))
    return rows.withColumn("bucket", _bucket(buckets))


def _read(spark: SparkSession, base: str, table: str, runs: list[str], schema: str) -> DataFrame:
    root = f"{base.rstrip('/')}/{table}"
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/run_id={r}" for r in runs]).drop("run_id")


def held_keys(spark: SparkSession, base: str, state: TableState, touched: dict[str, list[int]]) -> DataFrame:
    """What is held of the keys in the buckets ``touched`` of each topic; other folders are not read."""
    wanted = F.lit(False)
    for topic, buckets in touched.items():
        wanted = wanted | ((F.col("topic") == topic) & F.col("bucket").isin(buckets))
    return _read(spark, base, KEYS, state.folders, KEY_SCHEMA).where(wanted)


def _settled(brought: DataFrame, held: DataFrame) -> DataFrame:
    """What the batch adds to ``dq_keys``, and by how much each of its keys changes the count of its rule."""
    names = ["topic", "bucket", "key"]
    own = brought.select(F.col("topic").alias("_topic"), F.col("key").alias("_key"))
    held = held.join(own, (F.col("topic") == F.col("_topic")) & F.col("key").eqNullSafe(F.col("_key")), "left_semi")
    nil = F.lit(0).cast("long")
    both = brought.select(*names, F.col("n").alias("n1"), F.col("p").alias("p1"), nil.alias("n0"), nil.alias("p0")).unionByName(
        held.select(*names, nil.alias("n1"), nil.alias("p1"), F.col("n").alias("n0"), F.col("p").alias("p0")))
    sums = both.groupBy(*names).agg(*[F.sum(c).alias(c) for c in ("n1", "p1", "n0", "p0")])
    many = lambda n: (n > 1).cast("long")
    n1, p1, n0, p0 = (F.col(c) for c in ("n1", "p1", "n0", "p0"))
    orphaned = F.when(p1 + p0 > 0, -n0).otherwise(n1)
    duplicate = F.col("topic").isin(list(DUPLICATES))
    return sums.select(
        "key", F.when(duplicate, n1).otherwise(orphaned).alias("n"),
        F.when(duplicate, nil).otherwise(((p1 > 0) & (p0 == 0)).cast("long")).alias("p"),
        F.when(duplicate, many(n1 + n0) - many(n0)).otherwise(orphaned).alias("change"),
        "topic", "bucket").where("n != 0 or p != 0")


def _write_keys(rows: DataFrame, base: str, run_id: str) -> None:
    names = [c.split()[0] for c in KEY_SCHEMA.split(", ")]
    laid = rows.select(*names).repartition("topic", "bucket").sortWithinPartitions("topic", "bucket", "key")
    snap.write_snapshot(laid, base, KEYS, run_id, partition_by=["topic", "bucket"])


def _counts(staging, settled: DataFrame) -> DataFrame:
    """The batch's rows of ``dq_counts``: row rules by one scan per table, and the changes of the key rules. The plans,
    whose rule has no key, and every rule without a hit have a row too."""
    spark = settled.sparkSession
    no_date = F.lit(None).cast("date").alias("birth_date")
    by_key = {t: (rule, table) for t, (rule, table, _, _) in DUPLICATES.items()} | {t: ref[0] for t, ref in REFERENCES.items()}
    parts = [quality.row_rule_counts(getattr(staging, source), [r for r in quality.ROW_RULES if r.source == source and r.rule != UNDERAGE], None)
             for source in ("members", "payments", "plans")]
    changes = settled.groupBy("topic").agg(F.sum("change").alias("n"))
    name = F.create_map(*[F.lit(x) for t, (rule, _) in by_key.items() for x in (t, rule)])
    table = F.create_map(*[F.lit(x) for t, (_, table) in by_key.items() for x in (t, table)])
    parts.append(changes.select(name[F.col("topic")].alias("rule"), table[F.col("topic")].alias("table_name"), "n", F.lit(0).cast("long").alias("threshold")))
    age = next(r for r in quality.ROW_RULES if r.rule == UNDERAGE)
    none = [F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("threshold"))
            for rule, table in [*by_key.values(), (age.rule, age.table)]]
    parts.append(spark.range(1).select(F.explode(F.array(*none)).alias("x")).select("x.*"))
    births = staging.members.where(F.col("birth_date").isNotNull()).groupBy(F.col("birth_date").cast("date").alias("birth_date")).agg(F.count("*").alias("n"))
    dated = births.select(F.lit(age.rule).alias("rule"), F.lit(age.table).alias("table_name"), "n", F.lit(age.threshold).cast("long").alias("threshold"), "birth_date")
    return quality.union_all(parts).select("*", no_date).unionByName(dated)


def add_batch(spark: SparkSession, base: str, run_id: str, staging, member_ids: DataFrame, buckets: int | None = None) -> TableState:
    """Add the staging rows of a batch to the counts under ``base``. ``member_ids`` (column member_id): the members that the
    batch adds to the dimension. ``buckets`` of the key tables is fixed by the first batch (default: by its rows)."""
    state = read_state(spark, base, COUNTS)
    if run_id in (*state.folders, *state.folded):
        return state
    if not state.version:
        state = replace(state, buckets=buckets or buckets_for(staging.payments.count()))
    snap.write_snapshot(_brought(staging, member_ids, state.buckets), base, BROUGHT, run_id)
    brought = _read(spark, base, BROUGHT, [run_id], "topic string, key string, n long, p long, bucket int")
    touched = {r["topic"]: r["of"] for r in brought.groupBy("topic").agg(F.collect_set("bucket").alias("of")).collect()}  # at most four rows of MOST_BUCKETS numbers
    _write_keys(_settled(brought, held_keys(spark, base, state, touched)), base, run_id)
    settled = _read(spark, base, KEYS, [run_id], KEY_SCHEMA)
    snap.write_snapshot(_counts(staging, settled).coalesce(1), base, COUNTS, run_id)
    made = publish(spark, base, COUNTS, state.with_batch(run_id, (), ()))
    snap.remove(spark, f"{base.rstrip('/')}/{BROUGHT}/run_id={run_id}")
    return made


def report(spark: SparkSession, base: str, as_of, version: int | None = None) -> DataFrame:
    """The report over all batches for the day ``as_of``: rule, table_name, n, threshold, status, detail."""
    state = read_state(spark, base, COUNTS, version)
    rows = _read(spark, base, COUNTS, state.folders, COUNT_SCHEMA)
    counted = F.col("birth_date").isNull() | (rules.age_years("birth_date", as_of) < 18)
    total = rows.groupBy("rule", "table_name", "threshold").agg(F.sum(F.when(counted, F.col("n")).otherwise(0)).alias("n"))
    return quality.verdict(total)


def compact(spark: SparkSession, base: str, run_id: str) -> TableState:
    """Fold all batches into one folder of each table, with as many buckets as the keys now ask for; the report stays the
    same. The names of the folded batches are kept, so that one which comes again still changes nothing."""
    state = read_state(spark, base, COUNTS)
    if len(state.folders) < 2:
        return state
    if run_id in (*state.folders, *state.folded):
        raise ValueError(f"{run_id} is the name of a batch")
    held = _read(spark, base, KEYS, state.folders, KEY_SCHEMA)
    buckets = max(state.buckets, buckets_for(held.count() // (len(DUPLICATES) + len(REFERENCES))))
    keys = held.groupBy("topic", "key").agg(*[F.sum(c).alias(c) for c in ("n", "p", "change")]).withColumn("bucket", _bucket(buckets))
    _write_keys(keys.where("n != 0 or p != 0"), base, run_id)
    counts = _read(spark, base, COUNTS, state.folders, COUNT_SCHEMA).groupBy("rule", "table_name", "threshold", "birth_date").agg(F.sum("n").alias("n"))
    names = [c.split()[0] for c in COUNT_SCHEMA.split(", ")]
    snap.write_snapshot(counts.select(*names).coalesce(1), base, COUNTS, run_id)
    folded = (*state.folded, *state.folders)
    made = publish(spark, base, COUNTS, replace(state.with_base(run_id, buckets=buckets), folded=folded))
    drop_unnamed(spark, base, COUNTS, beside=(KEYS, BROUGHT))  # what no kept state names
    return made
