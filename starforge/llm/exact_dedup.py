"""Exact de-duplication by an extendible-hash index on shared files; DataFrame functions only.

Texts are equal when they are identical without ASCII white space. The 64-bit hash of a text
is its key. A directory maps the leading bits of a key to a bucket. It doubles, that is, takes one
more bit, wherever a bucket would hold more distinct keys than its capacity: from one histogram of leading
bits (of bounded size) the load of every node of the directory's tree follows, and a bucket
is a node that fits while its parent does not, so it is a contiguous range of keys.

Every row is routed by the directory to its bucket. The task that owns a bucket puts its rows in the order of
key and text: texts that share a key form a chain, a row belongs to the place in the chain whose bytes equal its
own, and group, size and the row that stays are read off there. Owners write their
buckets to files of the shared folder, sorted by bucket, key and chain; their number is that of the shuffle's partitions.

Keys whose texts weigh over ``HOT_BYTES`` and over 1 / ``HOT_KEYS`` of all bytes (so there are at most ``HOT_KEYS``
of them) are not routed row by row: equal texts are first combined where they are read, and rows find their place
by a broadcast of those few. No task holds such a group.

The capacity rises with the table so that the directory has at most 2 ** ``MOST_BITS`` slots. A bucket that is too full even
at that depth (possible only if leading bits of keys are far from even) costs its owner time, not rows.

Defined results: null text counts as empty. A very long text is one value of its row: it is never cut, and must fit a task's memory
a few times over; the sort of an owner spills. Of equal texts the row with the most code points stays, then the smallest doc_id (a null doc_id last). Of rows alike in text
length and doc_id one stays. Other columns, whatever their names, are carried along unread. An empty table gives an empty index and result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import keep_named, stored

#: Distinct keys a bucket holds before it is split.
CAPACITY = 4_096
#: The directory has at most 2 ** MOST_BITS slots.
MOST_BITS = 20
#: A key is hot when its texts weigh more than this, and more than 1 / HOT_KEYS of all texts.
HOT_BYTES = 32 << 20
HOT_KEYS = 65_536
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), WHITE, "")


def leading(key: Column | str, bits: int) -> Column:
    """The leading bits of a 64-bit key (none: 0; Spark takes a shift by 64 as one by 0)."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def directory(index: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for every slot of the directory over the keys of ``index`` (one row a key), and its global
    depth. A bucket's number is its first slot."""
    n = index.count()
    capacity = max(capacity, math.ceil(4 * n / 2**MOST_BITS))
    bits = max(0, min(MOST_BITS, math.ceil(math.log2(max(1, n) / capacity)) + 4)) if n > capacity else 0
    cells = _cells(index, bits)
    if bits < MOST_BITS and (cells.agg(F.max("n")).first()[0] or 0) > capacity:
        bits = MOST_BITS
        cells = _cells(index, bits)
    nodes = (cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"))
             .withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {bits} - depth)"))
             .groupBy("depth", "prefix").agg(F.sum("n").alias("load")))
    nodes = stored(nodes, "dedup-nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"), F.col("load").alias("above"))
    tree = nodes.withColumn("up", F.shiftrightunsigned("prefix", 1)).join(above, ["depth", "up"], "left")
    fits = (F.col("load") <= capacity) | (F.col("depth") == bits)
    buckets = tree.where(fits & (F.col("above").isNull() | (F.col("above") > capacity))).select("depth", "prefix")
    buckets = stored(buckets, "dedup-buckets")
    depth = buckets.agg(F.max("depth")).first()[0] or 0
    first = F.expr(f"shiftleft(prefix, {depth} - depth)")
    last = F.expr(f"shiftleft(prefix + 1, {depth} - depth) - 1")
    return buckets.select(F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"), "depth"), depth


def _cells(index: DataFrame, bits: int) -> DataFrame:
    return index.groupBy(leading("key", bits).alias("cell")).agg(F.count("*").alias("n"))


def _keyed(docs: DataFrame, row: Column, hashed: Callable[[Column], Column]) -> DataFrame:
    """row (what travels with a row; has doc_id and text), key."""
    have = docs.select(row.alias("row"))
    return have.withColumn("key", hashed(normalised(F.col("row.text"))))


def _facts(rows: DataFrame) -> DataFrame:
    """``rows`` with doc_id, n_points (code points of the text) and norm."""
    text = F.col("row.text").cast("string")
    return rows.withColumns({"doc_id": F.col("row.doc_id").cast("long"), "n_points": F.coalesce(F.length(text), F.lit(0)).cast("long"),
                             "norm": normalised(text)})


def _owned(routed: DataFrame, *carried: str) -> DataFrame:
    """What the owners of the buckets find for each of their rows: doc_id, n_points, bucket, key, chain, keep_id, group_size, kept, sha.

    One shuffle, by bucket; all windows work on one order of a task's rows."""
    rows = _facts(routed.repartition("bucket")).select("doc_id", "n_points", "bucket", "key", "norm", *carried)
    text = Window.partitionBy("key", "bucket", "norm")
    best = text.orderBy(F.desc("n_points"), F.asc_nulls_last("doc_id"))
    rows = rows.withColumns({"keep_id": F.first("doc_id").over(best), "place": F.row_number().over(best)})
    rows = rows.withColumn("group_size", F.count(F.lit(1)).over(text))
    rows = rows.withColumn("chain", F.dense_rank().over(Window.partitionBy("key", "bucket").orderBy("norm")))
    return rows.select("doc_id", "n_points", "bucket", "key", F.col("chain").cast("int").alias("chain"), "keep_id", "group_size",
                       (F.col("place") == 1).alias("kept"), F.sha2("norm", 256).alias("text_sha256"), *carried)


def _hot_entries(routed: DataFrame) -> DataFrame:
    """One row for each distinct text of the hot keys. Equal texts are combined before the shuffle."""
    by_length = _facts(routed).groupBy("key", "bucket", "norm", "n_points").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    texts = by_length.groupBy("key", "bucket", "norm").agg(
        F.max_by("least", "n_points").alias("keep_id"), F.max("n_points").alias("keep_points"), F.sum("n").alias("group_size"))
    chain = F.row_number().over(Window.partitionBy("key", "bucket").orderBy("norm"))
    return texts.select("key", "bucket", chain.alias("chain"), F.sha2("norm", 256).alias("text_sha256"), "keep_id", "keep_points", "group_size")


def _routed(rows: DataFrame, capacity: int, hot_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with the bucket that the directory gives their key: those that go to the owners, and those of hot keys (None: there are none)."""
    weighed = rows.groupBy("key").agg(F.sum(F.coalesce(F.octet_length(F.col("row.text").cast("string")), F.lit(0)).cast("long") + 16).alias("bytes"))
    keys = stored(weighed, "dedup-keys")
    slots, depth = directory(keys, capacity)
    placed = rows.withColumn("slot", leading("key", depth)).join(F.broadcast(slots.select("slot", "bucket")), "slot").drop("slot")  # at most 2 ** MOST_BITS
    limit = max(hot_bytes, (keys.agg(F.sum("bytes")).first()[0] or 0) / HOT_KEYS)
    hot = keys.where(F.col("bytes") > limit).select("key")
    if not hot.take(1):
        return placed, None
    hot = F.broadcast(hot)  # at most HOT_KEYS keys
    return placed.join(hot, "key", "left_anti"), placed.join(hot, "key", "left_semi")


def _is_best() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))


def deduplicate(docs: DataFrame, capacity: int = CAPACITY, hashed: Callable[[Column], Column] = F.xxhash64, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_points, bucket, key, chain, keep_id, group_size, kept, text_sha256, read
    from the files that the owners wrote."""
    rows = _keyed(keep_named(docs, {"doc_id": "long", "text": "string"}), F.struct("doc_id", "text"), hashed)
    routed, hot = _routed(rows, capacity, hot_bytes)
    out = stored(_owned(routed).sortWithinPartitions("bucket", "key", "chain"), "dedup-index")
    if hot is None:
        return out
    entries = stored(_hot_entries(hot), "dedup-hot-index")
    narrow = _facts(hot).select("doc_id", "n_points", "key", F.sha2("norm", 256).alias("text_sha256"))
    found = stored(narrow.join(F.broadcast(entries), ["key", "text_sha256"]), "dedup-hot")
    # of the rows alike in all columns the first one stays
    group = [F.col(c) for c in found.columns]
    best = found.where(_is_best()).groupBy(*group).agg(F.count("*").alias("m"))
    best = best.select(*group, F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("i"))
    rest = found.where(~_is_best()).withColumn("i", F.lit(0).cast("long"))
    return out.unionByName(best.unionByName(rest).withColumn("kept", F.col("i") == 1).select(*out.columns))


def keep_one(docs: DataFrame, capacity: int = CAPACITY, hashed: Callable[[Column], Column] = F.xxhash64, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with the same columns. A row travels to its owner whole, once."""
    rows = _keyed(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), hashed)
    routed, hot = _routed(rows, capacity, hot_bytes)
    out = _owned(routed, "row").where("kept").select("row")
    if hot is not None:
        entries = stored(_hot_entries(hot), "dedup-hot-index")
        marked = _facts(hot).withColumn("text_sha256", F.sha2("norm", 256)).join(F.broadcast(entries.drop("bucket")), ["key", "text_sha256"])
        out = out.unionByName(marked.where(_is_best()).groupBy("key", "text_sha256").agg(F.first("row").alias("row")).select("row"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
