"""Alignment of two tokenizers: which tokens of one cover the same bytes as which tokens of the other.

A is a byte-level BPE file, B a SentencePiece file. Both encode the text after one blank (B adds it by itself), so
their tokens tile the same bytes. The tokens of a batch of documents are laid end to end; ``merge_asof``, keyed by
document, gives for the start of each A token the B token that covers it, and for the start of each B token the
covering A token. The union of both directions is the set of overlapping pairs: a pair that both directions find is
one whose tokens start together. Byte places where both sides end cut the document into groups.

A blank between two characters that are no white space starts a token on both sides, and what stands before it never
changes the tokens after it. So texts are cut there into words, each distinct word is encoded once and remembered in a
bounded table. A text with code points from U+0250 up, where Unicode tables of libraries differ, is one word, as is
every text where a file normalises, cuts otherwise or has pieces that cross blanks.

Counts of id pairs run over all documents: each document sends its distinct pairs, pre-aggregated where they are
read. Pairs that make up more than ``HOT_PAIRS`` of all (document, pair) rows number at most 1 / HOT_PAIRS and are
broadcast; the rest meet their documents in a shuffle that no pair dominates.

Defined results: a text that is null or empty, or whose joined token bytes differ from the blank and the text on
either side, has no tokens: all counts 0 and an empty ``groups_sha256``. Special tokens' strings in a text are plain
text. Equal rows count as documents of their own; a null ``doc_id`` stays null; a table without rows gives none.
Missing columns are null, all others are ignored, whatever their names. A very long text costs a task a few dozen
bytes per token of it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.bpe import byte_alphabet, gather
from starforge.llm.common import join_groups, keep_named, ready, stored

#: A pair with more than this share of all (document, pair) rows is broadcast: at most 1 / HOT_PAIRS pairs are.
HOT_PAIRS = 1.0 / 100_000
#: Bits of a byte place below a document's number in a token's key.
PLACE_BITS = 40
#: Bytes of text that are aligned together, unless one text has more.
BATCH_TEXT = 3 << 19
#: Words remembered by a worker before its table is emptied.
MEMO_WORDS = 400_000

_BEYOND = re.compile("[ɐ-\U0010ffff]").search
_RARE_BLANK = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0]").search
_BESIDE_BLANK = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")

ENCODED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<int>")


class Side:
    """One tokenizer: ids of words that stand behind a blank, and the bytes of every id."""

    def __init__(self, token_bytes: list[bytes]):
        self.token_bytes = token_bytes
        self.length = np.array([len(b) for b in token_bytes], np.int64)
        digits = [str(i) for i in range(len(token_bytes))]
        #: The decimal of every id before each separator: next of the side, next side, next group, end.
        self.shown = np.array([[d + s for d in digits] for s in (",", "|", ";", "")], dtype=object)
        self.clear()

    def clear(self) -> None:
        self.flat, self.start, self.whole = np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, bool)

    def encode(self, words: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def learn(self, words: list[str]) -> None:
        """Append the ids of words, and whether their bytes are the blank and the word."""
        ids = self.encode(words)
        held = self.token_bytes
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int64)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64)])
        self.whole = np.concatenate([self.whole, [b"".join([held[i] for i in x]) == b" " + w.encode() for w, x in zip(words, ids)]])


class ByteSide(Side):
    """A byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        self.own.no_truncation()
        self.own.no_padding()
        spec = json.loads(self.own.to_str())
        cut = spec["pre_tokenizer"] or {}
        #: Words stand alone where the file changes no text and cuts it by the usual pattern of byte-level files.
        self.by_words = spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = self.own.get_vocab(with_added_tokens=True)
        held = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            held[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        super().__init__(held)

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.own.encode_batch([" " + w for w in words], add_special_tokens=False)]


class PieceSide(Side):
    """A SentencePiece file; it adds the first blank itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.own.id_to_piece(i) for i in range(len(self.own))]
        held = [bytes([int(p[3:5], 16)]) if self.own.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: Words stand alone where no piece goes on with a blank after something else, and blanks stay as they are.
        self.by_words = not any(re.search("[^▁]▁", p) for p in pieces) and b"".join(held[i] for i in self.own.encode("a  b \t c  ")) == b" a  b \t c  "
        super().__init__(held)

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.own.encode(words, num_threads=1)


class Pair:
    """Both tokenizers of a worker, with a common bounded table of words."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.by_words = self.a.by_words and self.b.by_words
        self.memo: dict[str, int] = {}

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the words of all texts, how many words each text has, and the order in which the texts come."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear(), self.a.clear(), self.b.clear()
        plain, other, lists = [], [], []
        for k, t in enumerate(texts):
            if not self.by_words or _BEYOND(t):
                other.append(k), lists.append([t])
            elif t[0] == " " or t[-1] == " " or any(x in t for x in _BESIDE_BLANK) or _RARE_BLANK(t):
                other.append(k), lists.append(_LONE_BLANK.split(t))
            else:
                plain.append(k)
        cut = pc.split_pattern(pa.array([texts[k] for k in plain], pa.large_string()), " ")
        count = np.concatenate([pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64), np.array([len(x) for x in lists], np.int64)])
        found = pa.concat_arrays([cut.flatten(), pa.array(list(chain.from_iterable(lists)), pa.large_string())]).dictionary_encode()
        words = found.dictionary.to_pylist()
        code = np.fromiter(map(self.memo.get, words, repeat(-1)), np.int64, len(words))
        miss = np.flatnonzero(code < 0)
        if len(miss):
            new = [words[i] for i in miss.tolist()]
            code[miss] = np.arange(len(self.memo), len(self.memo) + len(new))
            self.memo.update(zip(new, code[miss].tolist()))
            self.a.learn(new), self.b.learn(new)
        return code[found.indices.to_numpy()], count, np.array(plain + other, np.int64)


_LOADED: dict[tuple[str, str], Pair] = {}


def load(path_a: str, path_b: str) -> Pair:
    """One pair of encoders per worker process and files."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs (i, j) of tokens that share bytes, each once, and the pairs among them that start together.

    Both sides tile the same bytes of every document. A token's key is its document above its byte place, so that no
    start finds a token of another document.
    """
    a = pd.DataFrame({"key": (doc_a << PLACE_BITS) + start_a, "i": np.arange(len(start_a))})
    b = pd.DataFrame({"key": (doc_b << PLACE_BITS) + start_b, "j": np.arange(len(start_b))})
    i, j = a["i"].to_numpy(), pd.merge_asof(a, b, on="key")["j"].to_numpy(np.int64)
    together = start_a[i] == start_b[j]
    left = np.ones(len(start_b), bool)
    left[j[together]] = False  # the other direction would find these pairs again
    back = pd.merge_asof(b[left], a, on="key")
    return np.concatenate([i, back["i"].to_numpy(np.int64)]), np.concatenate([j, back["j"].to_numpy(np.int64)]), np.flatnonzero(together)


def align(texts: list[str | None], both: Pair) -> dict[str, list]:
    """Per text: numbers of tokens, groups and links, digest of the groups, and its distinct id pairs (A * |B| + B) with their times."""
    a, b = both.a, both.b
    n, size = len(texts), len(b.token_bytes)
    out = {k: [0] * n for k in ("n_a", "n_b", "n_groups", "n_links")} | {"groups_sha256": [""] * n, "pairs": [[]] * n, "times": [[]] * n}
    full = np.array([k for k, t in enumerate(texts) if t], np.int64)
    if not len(full):
        return out
    code, words, order = both.codes([texts[k] for k in full.tolist()])
    full, doc = full[order], np.repeat(np.arange(len(full)), words)
    broken = np.bincount(doc, ~(a.whole & b.whole)[code], len(full)) > 0
    code, doc = code[~broken[doc]], doc[~broken[doc]]
    full, doc = full[~broken], (np.cumsum(~broken) - 1)[doc]
    if not len(full):
        return out
    (ids_a, each_a), (ids_b, each_b) = gather(a.flat, a.start, code), gather(b.flat, b.start, code)
    doc_a, doc_b = np.repeat(doc, each_a), np.repeat(doc, each_b)
    count_a, count_b = np.bincount(doc_a, minlength=len(full)), np.bincount(doc_b, minlength=len(full))
    len_a, len_b = a.length[ids_a], b.length[ids_b]
    i, j, together = overlaps(doc_a, np.cumsum(len_a) - len_a, doc_b, np.cumsum(len_b) - len_b)
    # a token ends where the next begins: ends are equal where the next tokens start together
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[i[together] - 1] = last_b[j[together] - 1] = True  # the first start closes the last token of all
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    held_a, held_b = np.bincount(group_a), np.bincount(group_b)
    before_a, before_b = np.cumsum(held_a), np.cumsum(held_b) - held_b
    place_a, place_b = np.arange(len(ids_a)) + before_b[group_a], np.arange(len(ids_b)) + before_a[group_b]
    close = np.zeros(len(ids_b), bool)
    close[np.cumsum(count_b) - 1] = True
    shown = np.empty(len(ids_a) + len(ids_b), dtype=object)
    shown[place_a] = a.shown[last_a.astype(np.int64), ids_a]
    shown[place_b] = b.shown[np.where(close, 3, np.where(last_b, 2, 0)), ids_b]
    edge = np.concatenate([[0], np.cumsum(count_a + count_b)])

    links = np.bincount(doc_a[i], minlength=len(full))
    wide = len(a.token_bytes) * size
    found = np.sort(doc_a[i] * wide + ids_a[i] * size + ids_b[j])
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    times = np.diff(np.concatenate([first, [len(found)]])).astype(np.int32)
    of, pair = np.divmod(found[first], wide)
    at = np.searchsorted(of, np.arange(len(full) + 1))
    groups = np.bincount(doc_b[last_b], minlength=len(full))
    for k, row in enumerate(full.tolist()):
        out["n_a"][row], out["n_b"][row] = int(count_a[k]), int(count_b[k])
        out["n_groups"][row], out["n_links"][row] = int(groups[k]), int(links[k])
        out["groups_sha256"][row] = hashlib.sha256("".join(shown[edge[k]:edge[k + 1]].tolist()).encode()).hexdigest()
        out["pairs"][row], out["times"][row] = pair[at[k]:at[k + 1]], times[at[k]:at[k + 1]]
    return out


def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches put together to about BATCH_TEXT code points: more words of a batch are equal."""
    held, size = [], 0
    for pdf in batches:
        more = sum(len(t) for t in pdf["text"] if t)
        if held and size + more > BATCH_TEXT:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
        held.append(pdf)
        size += more
    if held:
        yield pd.concat(held, ignore_index=True)


def encode_both(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document with a row number of its own, its counts and digest, and its distinct linked id pairs."""
    ready(docs.sparkSession)

    def run(batches):
        both = load(path_a, path_b)
        for pdf in gathered(batches):
            found = align(pdf["text"].tolist(), both)
            yield pd.DataFrame({"row": pdf["row"], "doc_id": pdf["doc_id"], **found})

    rows = keep_named(docs, {"doc_id": "long", "text": "string"}).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInPandas(run, ENCODED)


def pair_counts(encoded: DataFrame, size_b: int) -> DataFrame:
    """(pair, a, b, n, best): in how many documents A id and B id are linked; whether no other pair of the A id is in more."""
    n = stored(encoded.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")).select(
        "pair", F.expr(f"pair div {size_b}").alias("a"), (F.col("pair") % size_b).alias("b"), "n"), "pair-counts")
    top = n.groupBy("a").agg(F.max("n").alias("top"))  # one row per id of A's vocabulary at most
    return stored(n.join(top, "a").select("pair", "a", "b", "n", (F.col("n") == F.col("top")).alias("best")), "pair-best")


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    ``path_a`` is a byte-level BPE file, ``path_b`` a SentencePiece file, both readable on executors. ``n_best``
    counts links whose pair is in as many documents as any pair of its A id, ``count_sum`` sums over the links in how
    many documents their pair is.
    """
    import sentencepiece

    encoded = stored(encode_both(docs, path_a, path_b), "aligned")
    counts = pair_counts(encoded, len(sentencepiece.SentencePieceProcessor(model_file=path_b)))
    links = encoded.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    met = join_groups(links, counts, "pair", "n", HOT_PAIRS)
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return encoded.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
