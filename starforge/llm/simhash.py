"""SimHash near-duplicates by a binary-trie self-join.

A text's fingerprint has bit i set if over half of its word shingles' 64-bit hashes have it set.
Fingerprints are the leaves of a binary trie; two sub-tries are walked together, the bits in which
the paths differ are added up, and a pair is given up as soon as they exceed the budget.

As a Spark job: equal fingerprints become one row; the trie's top is split into cells of at most
LEAF fingerprints and TOP_BITS bits (counts of prefixes, eight bits deeper wherever a cell is too full, so a dense
region is split as far as needed); the driver walks the cells of the top (at most a few per LEAF
fingerprints), and each pair of cells within the budget is one group, whose sub-tries a task
walks with whole frontiers of node pairs at a time in numpy. A task reduces its links to a
spanning forest, so that a dense cluster never leaves as all its pairs; components are
then joined over all groups.

Defined results: a null or blank text has fingerprint 0, linked like any other. Repeated rows share a
component. A component's id is its smallest doc_id (null only if all are null). An empty table gives
an empty result. Columns other than doc_id and text are ignored, and kept by ``keep_one``, whatever their names. A very
long text is held by its task as its words.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import join_groups, keep_named, ready, spare, stored
from starforge.llm.components import components

#: Fingerprints in one cell of the trie's top, at most.
LEAF = 32_768
#: Every cell is at least so deep: tasks enough for small tables, and a fingerprint goes to about as many pairs at any size.
TOP_BITS = 4
#: Shingles whose bits are counted at once.
CHUNK = 65_536
#: Node pairs in one frontier, and leaf pairs compared at once.
FRONTIER = 400_000
#: Pairs of nodes with at most so many leaf pairs are compared leaf by leaf.
SMALL = 32
HASH_SEED = 42


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned fingerprint of a text: A-Z lower-cased, words between ASCII white space, shingles of
    ``words`` words joined by a blank (repeats count), XXH64 with seed 42. Fewer words: one shingle of all."""
    from xxhash import xxh64_intdigest

    data = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not data:
        return 0
    n = max(1, len(data) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = data[at:at + CHUNK + words - 1] if n > CHUNK else data
        if len(part) < words:
            hashes = [xxh64_intdigest(b" ".join(part), HASH_SEED)]
        else:
            joined = b" ".join(part)
            end = np.cumsum([len(w) + 1 for w in part]) - 1
            begin = [0, *(end[:-1] + 1).tolist()]
            hashes = [xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in zip(begin, end[words - 1:].tolist())]
        ones += np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp, same) of every row; fp is the fingerprint as a signed long, same a hash of the text."""
    ready(docs.sparkSession)

    def run(batches):
        for pdf in batches:
            fp = np.array([fingerprint(t if isinstance(t, str) else None, words) for t in pdf["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fp.view(np.int64), "same": pdf["same"]})

    rows = keep_named(docs, {"doc_id": "long", "text": "string"}).withColumn("same", F.xxhash64("text"))
    return rows.mapInPandas(run, "doc_id long, fp long, same long")


def cells_of(classes: DataFrame, leaf: int = LEAF) -> list[tuple[int, int]]:
    """(prefix, depth) of the cells of the trie's top, in order, none with over ``leaf`` fingerprints
    (unless a full 64 bits deep). Each round counts eight bits deeper in the cells that are too full."""
    done: list[tuple[int, int]] = []

    def split(prefix: int, depth: int, deepest: int, counts: dict[int, int]) -> list[tuple[int, int]]:
        total = sum(counts.values())
        if not total:
            return []
        if total <= leaf and depth >= TOP_BITS:
            done.append((prefix, depth))
            return []
        if depth == deepest:
            if depth == 64:
                done.append((prefix, depth))
                return []
            return [(prefix, depth)]
        bit = deepest - depth - 1
        zero = {k: n for k, n in counts.items() if not k >> bit & 1}
        one = {k: n for k, n in counts.items() if k >> bit & 1}
        return split(2 * prefix, depth + 1, deepest, zero) + split(2 * prefix + 1, depth + 1, deepest, one)

    full = [(0, 0)]
    while full:
        depth = full[0][1]
        rows = classes
        if depth:
            rows = rows.where(F.shiftrightunsigned("fp", 64 - depth).isin([p for p, _ in full]))
        counts = rows.groupBy(F.shiftrightunsigned("fp", 56 - depth).alias("k")).agg(F.count("*").alias("n")).collect()
        mask = (1 << (depth + 8)) - 1
        by: dict[int, dict[int, int]] = {}
        for r in counts:  # at most 256 counts for each cell that is too full
            k = r["k"] & mask
            by.setdefault(k >> 8, {})[k] = r["n"]
        full = [c for p, d in full for c in split(p, d, depth + 8, by.get(p, {}))]
    return sorted(done, key=lambda c: c[0] << (64 - c[1]))


def cell_pairs(cells: list[tuple[int, int]], budget: int) -> list[tuple[int, int]]:
    """Pairs (i <= j) of cells whose prefixes differ in at most ``budget`` bits, by walking the top's nodes together."""
    tree: list = [None, None]
    for i, (prefix, depth) in enumerate(cells):
        if depth == 0:
            return [(0, 0)]
        at = tree
        for b in range(depth - 1, -1, -1):
            bit = prefix >> b & 1
            if b == 0:
                at[bit] = i
            else:
                at[bit] = at[bit] or [None, None]
                at = at[bit]
    out, stack = [], [(tree, tree, budget)]
    while stack:
        a, b, left = stack.pop()
        if a is None or b is None or left < 0:
            continue
        leaf_a, leaf_b = isinstance(a, int), isinstance(b, int)
        if leaf_a and leaf_b:
            out.append((min(a, b), max(a, b)))
        elif a is b:
            stack += [(a[0], a[0], left), (a[1], a[1], left), (a[0], a[1], left - 1)]
        elif leaf_a:
            stack += [(a, b[0], left), (a, b[1], left)]
        elif leaf_b:
            stack += [(a[0], b, left), (a[1], b, left)]
        else:
            stack += [(a[0], b[0], left), (a[1], b[1], left), (a[0], b[1], left - 1), (a[1], b[0], left - 1)]
    return sorted(set(out))


def trie_join(a: np.ndarray, b: np.ndarray, same: bool, budget: int):
    """Yield index arrays (i, j) of the links between sorted distinct fingerprints ``a`` and ``b``; for
    ``same``, b is a and each link comes once. Frontiers of node pairs go down one bit at a time."""
    start = (np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)]), np.array([0], np.int8))
    stack = [(63, start)]
    while stack:
        bit, (la, ra, lb, rb, used) = stack.pop()
        live = (used <= budget) & (ra > la) & (rb > lb)
        la, ra, lb, rb, used = la[live], ra[live], lb[live], rb[live], used[live]
        if not len(la):
            continue
        if len(la) > FRONTIER:
            half = len(la) // 2
            stack += [(bit, tuple(x[half:] for x in (la, ra, lb, rb, used))), (bit, tuple(x[:half] for x in (la, ra, lb, rb, used)))]
            continue
        small = ((ra - la) * (rb - lb) <= SMALL) | (bit < 0)
        if small.any():
            at = np.flatnonzero(small)
            wide = rb[at] - lb[at]
            area = (ra[at] - la[at]) * wide
            group = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(area) // FRONTIER)) + 1, [len(at)]])
            for g, h in zip(group[:-1], group[1:]):
                if g == h:
                    continue
                k = np.repeat(np.arange(g, h), area[g:h])
                place = np.arange(len(k)) - np.repeat(np.cumsum(area[g:h]) - area[g:h], area[g:h])
                i, j = la[at][k] + place // wide[k], lb[at][k] + place % wide[k]
                ok = np.bitwise_count(a[i] ^ b[j]) <= budget
                if same:
                    ok &= i < j
                if ok.any():
                    yield i[ok], j[ok]
            rest = ~small
            la, ra, lb, rb, used = la[rest], ra[rest], lb[rest], rb[rest], used[rest]
            if not len(la):
                continue
        one = np.uint64(1) << np.uint64(bit)
        va = a[la] | one
        vb = b[lb] | one
        low = ~(one - np.uint64(1))
        ma = np.minimum(np.maximum(np.searchsorted(a, va & low), la), ra)
        mb = np.minimum(np.maximum(np.searchsorted(b, vb & low), lb), rb)
        twin = (la == lb) if same else np.zeros(len(la), bool)
        cross = ~twin
        stack.append((bit - 1, (
            np.concatenate([la, ma, la, ma[cross]]), np.concatenate([ma, ra, ma, ra[cross]]),
            np.concatenate([lb, mb, mb, lb[cross]]), np.concatenate([mb, rb, rb, mb[cross]]),
            np.concatenate([used, used, used + 1, used[cross] + 1]))))


def forest(n: int, links) -> np.ndarray:
    """Least node reachable from each of n nodes; links come in chunks of (i, j), none is kept."""
    label = np.arange(n)
    for i, j in links:
        while True:
            x, y = label[i], label[j]
            open_ = x != y
            if not open_.any():
                break
            i, j, x, y = i[open_], j[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                flat = label[label]
                if (flat == label).all():
                    break
                label = flat
    return label


def links(classes: DataFrame, budget: int = 2, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) of at most ``budget`` differing bits,
    as spanning forests: within each pair of cells what is linked stays connected, no more."""
    spark = classes.sparkSession
    ready(spark)
    cells = cells_of(classes, leaf)
    pairs = cell_pairs(cells, budget) if cells else []
    of: list[list[tuple[int, int]]] = [[] for _ in cells]
    for k, (i, j) in enumerate(pairs):
        of[i].append((k, 0))
        if i != j:
            of[j].append((k, 1))
    first = np.array([p << (64 - d) for p, d in cells], np.uint64)
    start = np.cumsum([0, *map(len, of)])  # runs of (pair, side) of each cell
    pair, side_of = (np.array([x[t] for c in of for x in c], np.int32) for t in (0, 1))
    held = spark.sparkContext.broadcast((first, start, pair, side_of, np.array([i == j for i, j in pairs], bool)))

    def deal(batches):
        first, start, pair, side_of, _ = held.value
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64)
            cell = np.searchsorted(first, fp.view(np.uint64), side="right") - 1
            count = start[cell + 1] - start[cell]
            at = np.repeat(start[cell] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            yield pd.DataFrame({"k": pair[at], "side": side_of[at], "fp": np.repeat(fp, count)})

    def walk(key, pdf):
        same = bool(held.value[-1][key[0]])
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        side = pdf["side"].to_numpy()
        a = np.sort(fp[side == 0])
        b = a if same else np.sort(fp[side == 1])
        nodes = a if same else np.concatenate([a, b])
        shift = 0 if same else len(a)
        label = forest(len(nodes), ((i, j + shift) for i, j in trie_join(a, b, same, budget)))
        hit = np.flatnonzero(label != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[hit].view(np.int64), "b": nodes[label[hit]].view(np.int64)})

    dealt = classes.select("fp").mapInPandas(deal, "k int, side int, fp long")
    return dealt.groupBy("k").applyInPandas(walk, "a long, b long")


def roots(rows: DataFrame, budget: int, leaf: int = LEAF) -> DataFrame:
    """(fp, least, n, root) of every fingerprint of ``rows``: its smallest doc_id, its rows, and the least fingerprint of
    its component."""
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-classes")
    found = components(links(classes, budget, leaf))
    return stored(classes.join(found, classes["fp"] == found["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "simhash-roots")


def near_duplicates(docs: DataFrame, words: int = 3, budget: int = 2, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id
    reachable over links of at most ``budget`` bits)."""
    rows = stored(fingerprints(docs, words).select("doc_id", "fp"), "simhash")
    rooted = roots(rows, budget, leaf)
    whole = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("fps")), "simhash-components")
    of = stored(join_groups(rooted, whole, "root", "fps").select("fp", "component_id", "n"), "simhash-of")
    return join_groups(rows, of, "fp", "n").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, budget: int = 2) -> DataFrame:
    """Of each component one row, with the columns of ``docs``: that with the smallest doc_id (null last), then
    that whose text hashes least; of rows alike in both any one. Components are told apart by their fingerprints, so
    unrelated texts that share a doc_id, or have none, don't touch each other."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = stored(fingerprints(docs, words), "simhash")
    rooted = roots(rows, budget).select("fp", "n", "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_id"), F.col("same").alias("_same"))).alias("first")
    kept = stored(join_groups(rows, rooted, "fp", "n").groupBy("root").agg(first).select("first._id", "first._same"), "simhash-kept")
    # rows alike in id and text are few or none: only they are grouped with their texts
    copies = rows.groupBy("doc_id", "same").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_id"), F.col("same").alias("_same"))
    alike = F.col("k._id").eqNullSafe(F.col("c._id")) & (F.col("k._same") == F.col("c._same"))
    often = stored(kept.alias("k").join(copies.alias("c"), alike, "left_semi"), "simhash-often")
    hash_ = spare(docs, "_hash")
    marked = docs.withColumn(hash_, F.xxhash64("text"))

    def named(names: DataFrame) -> DataFrame:
        return marked.join(names, marked["doc_id"].cast("long").eqNullSafe(names["_id"]) & (marked[hash_] == names["_same"]), "left_semi")

    if not often.take(1):
        return named(kept).select(*columns)
    once = kept.alias("k").join(often.alias("c"), alike, "left_anti")
    return named(once).select(*columns).unionAll(named(often).dropDuplicates(["doc_id", hash_]).select(*columns))
