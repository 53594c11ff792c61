"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows are first written to the shared folder with the partition they lie in and their place there. How many rows each
partition sends to each shard is drawn from the multivariate hypergeometric distribution, so rows and columns of the
matrix sum exactly to the sizes of partitions and shards, with the same law as a uniform shuffle of all rows. A
partition permutes its rows locally to choose which goes where, rows are exchanged, and what a shard received is permuted
again: a seeded random number deals its rows to blocks of bounded size and orders each block, and the counts of the
blocks before give every row its slot. Every order of all rows is equally likely, shards differ by one row at most, and
no task holds more than a block, however large a shard is.

The driver holds the matrix (partitions x shards) and one count for each block, no row data. All draws are seeded, so a
repeated task draws the same. Null columns are carried like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import ready, spare, stored

#: Rows of a block, the unit that is permuted at once, on average.
BLOCK_ROWS = 20_000


def shard_sizes(n: int, shards: int) -> list[int]:
    """n rows in shards of n // shards rows or one more."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def communication_matrix(counts: list[int], sizes: list[int], seed: int):
    """Yield, for each partition, how many of its rows go to each shard. Drawn one partition after the other
    from what is left of the shards, which is the multivariate hypergeometric law of a uniform shuffle."""
    rng = np.random.default_rng([seed, 0])
    left = np.array(sizes, np.int64)
    for n in counts:
        sent = np.zeros(len(left), np.int64)
        want, room = int(n), int(left.sum())
        for b in np.flatnonzero(left):  # one hypergeometric draw for each shard
            if not want:
                break
            others = room - int(left[b])
            sent[b] = _draw(rng, int(left[b]), others, want)
            room, want = others, want - int(sent[b])
        left -= sent
        yield sent


#: Places from which on numpy's draw does not take its arguments.
LARGE = 10**9


def _draw(rng, good: int, bad: int, sample: int) -> int:
    """Hypergeometric draw: good places among ``sample`` of good + bad. numpy draws up to 10 ** 9 places; beyond, the same
    law is drawn by ratio of uniforms (Stadlober 1990), with logarithms of factorials taken as differences, so that their
    size costs no precision. Small samples are drawn place by place."""
    places = good + bad
    if places < LARGE:
        return int(rng.hypergeometric(good, bad, sample))
    few = min(sample, places - sample)
    if few <= 20:
        got = 0
        for taken in range(few):
            got += int(rng.integers(places - taken)) < good - got
        return got if few == sample else good - got
    less, more = min(good, bad), max(good, bad)
    part = less / places
    centre = few * part + 0.5
    wide = math.sqrt((places - few) / (places - 1) * few * part * (1 - part) + 0.5)
    hat = 2 * math.sqrt(2 / math.e) * wide + 3 - 2 * math.sqrt(3 / math.e)
    mode = (few + 1) * (less + 1) // (places + 2)
    top = min(few, less) + 1
    while True:
        u, v = 1.0 - rng.random(), rng.random()
        at = centre + hat * (v - 0.5) / u
        if not 0 <= at < top:
            continue
        k = int(at)
        d = k - mode
        gap = -(_log_factorial_step(mode, d) + _log_factorial_step(less - mode, -d) + _log_factorial_step(few - mode, -d)
                + _log_factorial_step(more - few + mode, d))
        if 2 * math.log(u) <= gap:
            break
    if good > bad:
        k = few - k
    return k if few == sample else good - k


def _log_factorial_step(a: int, d: int) -> float:
    """log (a + d)! - log a!, by Stirling's series for large a, where the difference of both would lose digits."""
    b = a + d
    if min(a, b) < 1000:
        return math.lgamma(b + 1) - math.lgamma(a + 1)
    return d * math.log(a) + (b + 0.5) * math.log1p(d / a) - d + (1 / b - 1 / a) / 12 - (1 / b**3 - 1 / a**3) / 360


def shuffle_to_shards(rows: DataFrame, shards: int, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every row of ``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in its shard); the data
    lies partitioned by block and sorted by slot. Columns of these names are replaced."""
    spark = rows.sparkSession
    ready(spark)
    rows = rows.drop("shard", "slot")
    id_, block, rank, first, size = (spare(rows, x) for x in ("_id", "_block", "_rank", "_first", "_size"))
    placed = stored(rows.withColumn(id_, F.monotonically_increasing_id()), "shard-rows")
    part = F.shiftrightunsigned(id_, 33)
    counts = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}  # one row per partition
    parts = sorted(counts)
    n = sum(counts.values())
    matrix = dict(zip(parts, communication_matrix([counts[p] for p in parts], shard_sizes(n, shards), seed)))
    held = spark.sparkContext.broadcast(matrix)

    @F.pandas_udf("int")
    def target(ids: pd.Series) -> pd.Series:
        ids = ids.to_numpy(np.int64)
        out = np.empty(len(ids), np.int32)
        for p in np.unique(ids >> 33):
            if p not in _ORDER:
                _ORDER.clear()  # one partition at a time
                sent = held.value[int(p)]
                _ORDER[p] = np.random.default_rng([seed, 1, int(p)]).permutation(np.repeat(np.arange(len(sent), dtype=np.int32), sent))
            own = ids >> 33 == p
            out[own] = _ORDER[p][ids[own] & ((1 << 33) - 1)]
        return pd.Series(out)

    # the second permutation, in two parts of a seeded random number: block, and order within the block
    cut = max(1, math.ceil(n / shards / block_rows))
    sent = placed.withColumn("shard", target(id_)).withColumn(block, F.pmod(F.xxhash64(F.lit(seed), F.col(id_)), F.lit(cut)))
    sizes = sent.select("shard", block).groupBy("shard", block).agg(F.count("*").alias(size))
    before = F.sum(size).over(Window.partitionBy("shard").orderBy(block)) - F.col(size)
    places = stored(sizes.select("shard", block, before.alias(first)), "shard-places")
    order = Window.partitionBy("shard", block).orderBy(F.xxhash64(F.lit(seed + 1), F.col(id_)), id_)
    dealt = sent.withColumn(rank, F.row_number().over(order))
    out = dealt.join(places, ["shard", block])  # one row for each block; rows already lie by these keys
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], "shard", (F.col(first) + F.col(rank) - 1).alias("slot"))


_ORDER: dict[int, np.ndarray] = {}
