"""Exact sample sizes and dense numbers without a global sort.

``first_by_hash`` takes exactly the k rows with the smallest hashes. The k-th smallest is found by refining a histogram
of leading hex digits: each pass counts rows per next digits below the prefix so far, 65,536 counts on the driver, until
the bin that holds the k-th row is small enough to look at. The leading digits are a hash of the key alone, so that over a
derived table the passes join and shuffle key columns, and whole rows of the sample only. ``dense_numbers`` numbers rows 1, 2, 3, ... by counts per
range partition and their prefix sums on top of what earlier runs have numbered.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.session import work_path

#: Hex digits by which one pass refines the histogram: 16 ** 4 counts. They divide those of the key's hash.
DIGITS = 4
#: Hex digits of the key's hash; those of the whole row's follow.
KEY_DIGITS = 32
#: Rows of the last bin whose hashes the driver looks at.
LAST_BIN = 4_096
#: Rows that one task numbers.
ROWS_PER_TASK = 1_000_000


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def key_hash(keys: list[str], seed: int | str) -> Column:
    """Hex hash of the key alone: over a derived table a filter on it needs no column but the key's, and moves below joins."""
    return F.md5(F.concat_ws("|", F.lit(f"{seed}:s"), *[_text(k) for k in keys]))


def sample_hash(df: DataFrame, keys: list[str], seed: int | str) -> Column:
    """Hex hash of the key, then of the whole row: only equal rows are equal in it."""
    row = F.md5(F.concat_ws("|", F.lit(f"{seed}:t"), *[_text(c) for c in df.columns]))
    return F.concat(key_hash(keys, seed), row)


def _first(df: DataFrame, size: Callable[[int], int], keys: list[str], seed: int | str) -> DataFrame:
    """The ``size``(n) rows of ``df`` with the smallest hashes, where n is its number of rows."""
    key, whole = key_hash(keys, seed), sample_hash(df, keys, seed)

    def inside(prefix: str) -> DataFrame:
        rows = df.where(key.startswith(prefix[:KEY_DIGITS])) if prefix else df
        return rows.where(whole.startswith(prefix)) if len(prefix) > KEY_DIGITS else rows

    prefix, before, k = "", 0, None  # rows below the prefix
    while True:
        at = len(prefix)
        digits = F.substring(key if at < KEY_DIGITS else whole, at + 1, DIGITS)
        counts = sorted((r["bin"], r["n"]) for r in inside(prefix).groupBy(digits.alias("bin")).agg(F.count("*").alias("n")).collect())
        if k is None:
            k = size(sum(n for _, n in counts))
            if k <= 0:
                return df.where(F.lit(False))
        for digit, n in counts:
            if before + n >= k:
                break
            before += n
        else:
            return df  # fewer than k rows
        prefix += digit
        if n <= LAST_BIN or len(prefix) >= 2 * KEY_DIGITS:
            break
    last = sorted((r["_h"], r["n"]) for r in inside(prefix).groupBy(whole.alias("_h")).agg(F.count("*").alias("n")).collect())
    for h, n in last:  # distinct hashes of one bin: at most LAST_BIN, or one hash of equal rows
        if before + n >= k:
            break
        before += n
    upto = df.where(key <= h[:KEY_DIGITS])  # by the key's columns; the rest of the hash decides among the last key's rows
    if before + n == k:
        return upto.where((key < h[:KEY_DIGITS]) | (whole <= h))
    # the rows of the last hash are equal: one of them, as often as it takes
    equal = inside(h).limit(1).withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(k - before)))).drop("_i")
    return upto.where((key < h[:KEY_DIGITS]) | (whole < h)).unionByName(equal)


def first_by_hash(df: DataFrame, k: int, keys: list[str], seed: int | str = 42) -> DataFrame:
    """Exactly the min(k, n) rows of ``df`` with the smallest hashes of ``keys``, ties by the whole row.

    ``df`` is read once per pass (about one for each 16 bits of n, of the key columns only), once for the rows of the last
    bin and once for the result; the last two read whole rows only of the keys that their filter lets pass.
    """
    return _first(df, lambda n: k, keys, seed)


def exact_sample(df: DataFrame, fraction: float, keys: list[str], seed: int | str = 42) -> DataFrame:
    """Exactly int(n * fraction) rows of ``df``, without replacement, the same ones on every run. The first pass
    also counts n."""
    return _first(df, lambda n: int(n * min(max(fraction, 0.0), 1.0)), keys, seed)


def dense_numbers(rows: DataFrame, order: list[str], name: str, after: int = 0, rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, int]:
    """G1: ``rows`` with the column ``name`` numbered ``after`` + 1, ``after`` + 2, ... in the order of ``order``, and the
    last number given. ``order`` must be total; the numbers then depend on neither partitions nor attempts."""
    spark = rows.sparkSession
    path = work_path(spark, "numbers", uuid.uuid4().hex)
    parts = -(-max(1, rows.count()) // rows_per_task)
    at = F.monotonically_increasing_id()  # partition number above 33 bits of the row's place in it
    (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
         .withColumn("_part", F.shiftright(at, 33)).withColumn("_place", at.bitwiseAND((1 << 33) - 1)).write.parquet(path))
    placed = spark.read.parquet(path)
    base, starts = after, []
    for r in placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():  # one row a task
        starts.append((r["_part"], base))
        base += r["n"]
    start = spark.createDataFrame(starts, "_part long, _start long")
    return placed.join(start, "_part").withColumn(name, F.col("_start") + F.col("_place") + 1).drop("_part", "_place", "_start"), base
