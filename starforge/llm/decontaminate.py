"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are normalised alike: lower case, every ASCII character that is neither letter
nor digit counts as a blank, runs of blanks are one. An item is cut into windows of SPAN characters
(bytes of UTF-8), one every STEP; a shorter item is one window. A document leaks an item when a
window of it occurs with at most k edits, k being EDIT_RATE of the window's length (for short windows
as many as leave the lemma a threshold of one).

STEP is twice the k of a whole window, so every passage of SPAN characters lies within k places of a window, whose other
characters then cost at most k edits: a passage copied word for word is sure to be found from SPAN characters on, wherever in
its item it begins. One of SPAN characters with e edits is sure to be found if it lies within k - e places of a window; one
of SPAN + STEP - 1 characters holds a whole window and is sure to be found with up to k edits.

An occurrence with at most k edits shares at least m - Q + 1 - k * Q q-grams with its window, and their
diagonals (place in the text less place in the window) lie within k of each other. So shared q-grams
are counted in diagonal bands of width 2 (k + 1) that overlap by half, bands below the threshold are dropped
(no occurrence is lost), and what remains is verified by an edit distance within the band.

Benchmark items are read in blocks of bounded size; each block's q-gram index is sent to the executors and all
rows are held against it. Rows never shuffle.

Defined results: null or blank texts leak nothing, null or blank items match nothing. Items of less than Q characters must
occur literally between blanks. Repeated rows each get their own results; items that share an id, or have none, are reported
under that id (null) as one. Other columns are ignored by ``leaks`` and kept by ``keep_clean``, whatever their names. A very
long text takes several numbers of eight bytes for each of its bytes in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import keep_named, ready
from starforge.llm.langid import lowered

#: Length of a q-gram; eight bytes are one 64-bit word.
Q = 8
SPAN = 64
EDIT_RATE = 0.1
#: Characters of normalised benchmark text in one block.
BLOCK_CHARS = 2_000_000
#: Bits of the table that most q-grams of a text fail.
SIEVE_BITS = 21
#: Zero bytes between texts, more than any alignment can bridge.
GAP = 2 * SPAN
#: Candidates aligned at once.
ALIGN = 10_000
#: Code points of the texts searched at once (a longer text: alone), and places whose q-grams are held at once.
PIECE = 500_000
PLACES = 1 << 18

_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))


def normalise(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Normalised bytes of all texts with gaps between, the byte of origin of each, where each text begins, the raw bytes."""
    raw = [lowered(t).encode("utf-8", "surrogatepass") for t in texts]
    gap = b"\0" * GAP
    joined = gap + gap.join(raw) + gap
    begin = np.cumsum([GAP] + [len(r) + GAP for r in raw])[:-1]
    flat = np.frombuffer(joined.replace(b"\0", b" ") if any(b"\0" in r for r in raw) else joined, np.uint8)
    inside = np.zeros(len(flat) + 1, np.int8)
    inside[begin] = 1
    np.add.at(inside, begin + [len(r) for r in raw], -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    flat = np.where(inside, np.frombuffer(flat.tobytes().translate(_TABLE), np.uint8), 0).astype(np.uint8)
    blank = flat == 32
    keep = np.append(True, ~(blank[1:] & blank[:-1]))
    origin = np.flatnonzero(keep)
    return flat[keep], origin, begin, joined


def grams(flat: np.ndarray) -> np.ndarray:
    """The q-gram at each place as a 64-bit word."""
    n = len(flat) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    return np.ndarray((n,), "<u8", np.ascontiguousarray(flat).data, 0, (1,)).copy()


def budget(m: int) -> int:
    return min(int(EDIT_RATE * m), (m - Q) // Q) if m >= Q else 0


#: Places from one window of an item to the next: no place is further than the edit budget from a window.
STEP = 2 * budget(SPAN)


def _sieve(g: np.ndarray) -> np.ndarray:
    return (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SIEVE_BITS)
#: Code points that a leak has at least for which a document is dropped.
LEAST_LEAK = 32


@dataclass
class Block:
    """Windows of some items and the index of their q-grams."""
    items: np.ndarray    # item_id of each window
    text: list           # bytes of each window
    size: np.ndarray
    need: np.ndarray     # least shared q-grams
    keys: np.ndarray     # sorted distinct q-grams
    start: np.ndarray    # their runs in window / place
    window: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    short: list          # (item_id, bytes) of items below Q characters


def make_block(rows: list[tuple[int, str]]) -> Block:
    items, text, short = [], [], []
    for item, t in rows:
        norm, _, _, _ = normalise([t])
        norm = norm[norm != 0].tobytes().strip()
        if not norm:
            continue
        if len(norm) < Q:
            short.append((item, norm))
            continue
        last = max(0, len(norm) - SPAN)
        for a in sorted({*range(0, last + 1, STEP), last}):
            items.append(item), text.append(norm[a:a + SPAN])
    size = np.array([len(t) for t in text], np.int64)
    need = np.array([m - Q + 1 - budget(m) * Q for m in size], np.int64)
    g, w, p = [np.empty(0, np.uint64)], [], []
    for i, t in enumerate(text):
        own = grams(np.frombuffer(t, np.uint8))
        g.append(own), w.append(np.full(len(own), i, np.int32)), p.append(np.arange(len(own), dtype=np.int32))
    g = np.concatenate(g)
    order = np.argsort(g, kind="stable")
    keys, first = np.unique(g[order], return_index=True)
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[_sieve(keys)] = True
    empty = [np.empty(0, np.int32)]
    return Block(np.array(items, object), text, size, need, keys, np.append(first, len(g)).astype(np.int64),
                 np.concatenate(empty + w)[order], np.concatenate(empty + p)[order], sieve, short)


def candidates(block: Block, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, first diagonal of the band) of all bands that hold as many shared q-grams as the lemma asks for."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    at, g = [], []
    for a in range(0, len(flat) - Q + 1 if len(block.keys) else 0, PLACES):
        here = grams(flat[a:a + PLACES + Q - 1])
        some = np.flatnonzero(block.sieve[_sieve(here)])
        at.append(some + a), g.append(here[some])
    if not sum(map(len, at)):
        return none
    at, g = np.concatenate(at), np.concatenate(g)
    k = np.minimum(np.searchsorted(block.keys, g), len(block.keys) - 1)
    real = block.keys[k] == g
    at, k = at[real], k[real]
    count = block.start[k + 1] - block.start[k]
    shift = np.repeat(block.start[k] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    window = block.window[shift].astype(np.int64)
    diagonal = np.repeat(at, count) - block.place[shift]
    steps = np.array([budget(m) + 1 for m in range(SPAN + 1)])
    band = diagonal // steps[block.size[window]] + GAP  # never below zero
    width = len(flat) + 2 * GAP
    key = window * width + band
    # a hit counts for its own band and the one before, which reaches over it
    values, n = np.unique(np.concatenate([key, key - 1]), return_counts=True)
    window, band = values // width, values % width - GAP
    enough = n >= block.need[window]
    window, band = window[enough], band[enough]
    return window, band * steps[block.size[window]]


def banded(pattern: np.ndarray, text: np.ndarray, width: int, anchored: bool = False) -> np.ndarray:
    """Edit distances of patterns (rows) to their texts within ``width`` diagonals: the last row of the table, one cell
    for each diagonal. Any start is free, or, if ``anchored``, only that on the first diagonal."""
    n, m = pattern.shape
    cost = np.arange(width)
    row = np.tile(cost if anchored else np.zeros(width, np.int64), (n, 1)).astype(np.int64)
    for i in range(m):
        meet = row + (text[:, i:i + width] != pattern[:, i:i + 1])
        meet[:, :-1] = np.minimum(meet[:, :-1], row[:, 1:] + 1)  # a pattern character left out
        row = np.minimum.accumulate(meet - cost, axis=1) + cost  # text characters left out
    return row


def verify(block: Block, flat: np.ndarray, window: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, ...]:
    """(window, edits, begin, end) of the candidates that align within their budget; places in ``flat``."""
    out = []
    for m in np.unique(block.size[window]):
        k = budget(m)
        width = 2 * (k + 1) + 2 * k + 1
        rows = np.flatnonzero(block.size[window] == m)
        for part in np.array_split(rows, max(1, -(-len(rows) // ALIGN))):
            if not len(part):
                continue
            pattern = np.array([np.frombuffer(block.text[w], np.uint8) for w in window[part]])
            from_ = diagonal[part] - k
            span = np.arange(m + width)

            def cut(first, step):
                at = first[:, None] + step * span
                return np.where((at >= 0) & (at < len(flat)), flat[np.clip(at, 0, len(flat) - 1)], 0)

            last = banded(pattern, cut(from_, 1), width)
            edits = last.min(axis=1)
            end = from_ + m + last.argmin(axis=1)
            good = np.flatnonzero(edits <= k)
            if not len(good):
                continue
            # backwards from the end, to find the beginning
            back = banded(pattern[good][:, ::-1], cut(end[good] - 1 + k, -1), 2 * k + 1)
            fits = np.abs(np.arange(2 * k + 1) - k)
            begin = end[good] - m - (np.argmin(back * 1000 + fits, axis=1) - k)
            out.append((window[part][good], edits[good], begin, end[good]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.empty(0, np.int64) for _ in range(4))


def pieces(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of at most PIECE code points; a longer text is a list of its own."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > PIECE:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def find_leaks(block: Block, texts: list[str]) -> list[list[tuple]]:
    """For each text its leaks, one (item_id, windows, least edits, start, end) for each item, in code points."""
    out: list[list[tuple]] = [[] for _ in texts]
    if not texts or not (len(block.items) or block.short):
        return out
    flat, origin, begin, joined = normalise(texts)
    window, edits, a, b = verify(block, flat, *candidates(block, flat))
    found: dict[tuple, list] = {}
    text_of = np.searchsorted(begin, origin[np.clip(a, 0, len(origin) - 1)] + GAP // 2, side="right") - 1
    for w, e, x, y, d in zip(window, edits, a, b, text_of):
        hit = found.setdefault((int(d), block.items[w]), [set(), 99, x, y])
        hit[0].add(w)
        hit[1:] = [min(hit[1], int(e)), min(hit[2], x), max(hit[3], y)]
    if block.short:
        data = flat.tobytes()
        for item, s in block.short:
            at = data.find(s)
            while at >= 0:
                if not (data[at - 1] not in (0, 32) or data[at + len(s)] not in (0, 32)):
                    d = int(np.searchsorted(begin, origin[at], side="right") - 1)
                    hit = found.setdefault((d, item), [set(), 0, at, at + len(s)])
                    hit[0].add(-1)
                    hit[1:] = [0, min(hit[2], at), max(hit[3], at + len(s))]
                at = data.find(s, at + 1)
    for (d, item), (windows, e, x, y) in found.items():
        head = begin[d]
        chars = lambda at: sum((c & 0xC0) != 0x80 for c in joined[head:at])
        stop = joined.find(b"\0" * GAP, head)
        start, end = (min(max(head, int(origin[min(max(int(p), 0), len(origin) - 1)])), stop) for p in (x, y - 1))
        out[d].append((item, len(windows), e, chars(start), min(chars(end) + 1, len(texts[d]))))
    return [sorted(x, key=lambda leak: (leak[0] is None, leak[0] or 0)) for x in out]


def blocks(benchmark: DataFrame):
    """Blocks of items of bounded size, one after the other; the driver holds one at a time."""
    rows, size = [], 0
    items = keep_named(benchmark, {"item_id": "long", "text": "string"}).where("text is not null")
    for r in items.toLocalIterator():
        if rows and size + len(r["text"]) > BLOCK_CHARS:
            yield make_block(rows)
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if rows:
        yield make_block(rows)


def leak_column(text: Column, block: Block, spark) -> Column:
    """Array of leaks of a text column against one block."""
    held = spark.sparkContext.broadcast(block)

    @F.pandas_udf("array<struct<item_id:long,windows:int,edits:int,start:int,end:int>>")
    def leaks(batch: pd.Series) -> pd.Series:
        found = [x for part in pieces([t if isinstance(t, str) else "" for t in batch]) for x in find_leaks(held.value, part)]
        return pd.Series([[dict(zip(("item_id", "windows", "edits", "start", "end"), x)) for x in f] for f in found], dtype=object)

    return leaks(text.cast("string"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, windows (matched), edits (least), start and end
    (code points, from the first to the last match of the item)."""
    spark = docs.sparkSession
    ready(spark)
    rows = keep_named(docs, {"doc_id": "long", "text": "string"})
    out = None
    for block in blocks(benchmark):
        part = rows.select("doc_id", F.explode(leak_column(F.col("text"), block, spark)).alias("leak")).select("doc_id", "leak.*")
        out = part if out is None else out.unionAll(part)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, windows int, edits int, start int, end int")
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, least_points: int = LEAST_LEAK) -> DataFrame:
    """The rows of ``docs`` without a leak of ``least_points`` code points or more, with the same columns. A shorter
    match, such as the word or phrase that a short item is, is no proof that a text holds the item."""
    spark = docs.sparkSession
    ready(spark)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    for block in blocks(benchmark):
        docs = docs.where(~F.exists(leak_column(F.col("text"), block, spark), lambda leak: leak["end"] - leak["start"] >= least_points))
    return docs.select(*columns)
