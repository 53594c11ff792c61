"""BPE encoding and decoding by batched merge rounds in numpy.

``Bpe`` reads a public tokenizer file (path given by the caller) of the
word-level kind: special strings are cut out first, each other part is
normalised (NFC, white space to a blank, lower case), cut into words by the
file's pattern, and each word's bytes are merged.

Merging works on many words at once. The symbols of all words of a batch lie
in one flat array. In each round the keys of adjacent pairs are looked up by
binary search in the sorted keys of all merges, the lowest rank of each word
is found by a segmented minimum, and that pair is merged in every word. All
occurrences of the pair merge at once when no merge that uses its product has
a lower rank (checked for every rank when the file is read); otherwise only the
leftmost one does, as one-at-a-time merging would. Words without a pair left
leave the array.

A bounded table of words already merged is kept between batches; when full it
is emptied, so memory is bounded and results don't depend on it.

Null text counts as empty: no ids, an empty decoded text.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import ready

#: Words remembered by a worker before its table is emptied.
MEMO_WORDS = 400_000
#: Words looked up together.
CHUNK_WORDS = 200_000


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    out, free = {}, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return [out[b] for b in range(256)]


def gather(flat: np.ndarray, start: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[start[c]:start[c + 1]] of all codes one after the other, and the length of each."""
    begin = start[code]
    count = start[code + 1] - begin
    shift = np.repeat(begin - (np.cumsum(count) - count), count)
    return flat[shift + np.arange(len(shift))], count


class Bpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Regex, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # Letters and blanks of later Unicode versions differ between libraries; what lies beyond
        # Latin is normalised and cut by the tokenizers library.
        self.own_norm = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.own_cut = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.beyond = re.compile("[\x1c-\x1f\u0250-\U0010ffff]").search
        self.odd_blank = re.compile("[\x1c-\x1f]").search
        letter, number = "a-zA-Zªµºß-öø-ɏÀ-ÖØ-Þ", "0-9²³¹¼-¾"
        latin = pattern.replace("\\p{L}", letter).replace("\\p{N}", number)
        self.latin = re.compile(f"[{letter}]+|{latin}").findall
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + end] for c in alphabet], np.int64)
        self.n = 1 + max([*vocab.values(), *special.values()])
        self.strings = np.full(self.n, "", object)
        for s, i in [*vocab.items(), *special.items()]:
            self.strings[i] = s
        first, second, made, rank = [], [], [], []
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            first.append(vocab[a]), second.append(vocab[b]), made.append(vocab[a + b]), rank.append(r)
        a, b, made, rank = (np.array(x, np.int64) for x in (first, second, made, rank))
        used = np.full(self.n, len(rank), np.int64)  # lowest rank of a merge that takes a symbol
        np.minimum.at(used, a, rank)
        np.minimum.at(used, b, rank)
        order = np.argsort(a * self.n + b, kind="stable")
        self.keys = (a * self.n + b)[order]
        self.ranks, self.made = rank[order], made[order]
        self.at_once = (used[made] > rank)[order]
        self.none = len(rank)
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.start = np.zeros(1, np.int64)

    def _ranks(self, sym: np.ndarray, word: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place in the sorted keys of the pairs that start at ``pos``; a word's last symbol starts none."""
        nxt = np.minimum(pos + 1, len(sym) - 1)
        inside = (word[pos] == word[nxt]) & (nxt > pos)
        key = sym[pos] * self.n + sym[nxt]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(inside & (self.keys[at] == key), self.ranks[at], self.none), at

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and the start of each (one more than words). No word may be empty."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(size)
        sym = self.inner[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        rank, at = self._ranks(sym, word, np.arange(len(sym)))
        done_ids, done_word = [], []
        while len(sym):
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.repeat(np.minimum.reduceat(rank, head), np.diff(np.append(head, len(sym))))
            over = low == self.none
            if over.any():
                done_ids.append(sym[over]), done_word.append(word[over])
                stay = ~over
                sym, word, rank, at, low = sym[stay], word[stay], rank[stay], at[stay], low[stay]
            pos = np.flatnonzero(rank == low)
            if not len(pos):
                break
            # of a run of overlapping hits (a pair of equal symbols) every second one merges
            other = word[pos[1:]] != word[pos[:-1]]
            run = np.append(True, (np.diff(pos) != 1) | other)
            place = np.arange(len(pos))
            take = (place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0
            # where a lower rank could arise from this merge, only the word's first hit
            take &= self.at_once[at[pos]] | np.append(True, other)
            pos = pos[take]
            sym[pos] = self.made[at[pos]]
            stay = np.ones(len(sym), bool)
            stay[pos + 1] = False
            sym, word, rank, at = sym[stay], word[stay], rank[stay], at[stay]
            pos = pos - np.arange(len(pos))  # one symbol less for each merge before
            near = np.concatenate([pos, pos[pos > 0] - 1])  # only pairs beside a merge are new
            rank[near], at[near] = self._ranks(sym, word, near)
        ids, word = np.concatenate([np.empty(0, np.int64), *done_ids]), np.concatenate([np.empty(0, np.int64), *done_word])
        ids = ids[np.argsort(word, kind="stable")]
        start = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])
        return ids.astype(np.uint32), start

    def cut_words(self, text: str) -> list[str]:
        """Normalised words of a text without special strings."""
        low = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower()
        if not self.beyond(low) and not self.beyond(text):
            return self.latin(low)
        if self.odd_blank(text):
            return self.cut_any(text)
        return [w for run in text.split() for w in (self.latin(run.lower()) if run.isascii() else self.cut_any(run))]

    def cut_any(self, text: str) -> list[str]:
        return [w for w, _ in self.own_cut.pre_tokenize_str(self.own_norm.normalize_str(text))]

    def split(self, text: str) -> list[str]:
        """Words in order, special strings marked by a leading NUL and blank (no word holds a blank)."""
        if not any(s in text for s in self.special):
            return self.cut_words(text)
        out = []
        for k, part in enumerate(self.cut.split(text)):
            out += ["\0 " + part] if k % 2 else self.cut_words(part)
        return out

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if not w.startswith("\0 ")]
        special = [w for w in new if w.startswith("\0 ")]
        ids, start = self.merge([w.encode() for w in plain]) if plain else (np.empty(0, np.uint32), np.zeros(1, np.int64))
        base = len(self.memo)
        self.memo.update(zip(plain + special, range(base, base + len(new))))
        self.flat = np.concatenate([self.flat, ids, np.array([self.special[w[2:]] for w in special], np.uint32)])
        self.start = np.concatenate([self.start, self.start[-1] + start[1:], len(self.flat) - len(special) + 1 + np.arange(len(special))])

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of a chunk, flat, and the count of each unit."""
        if len(self.memo) > MEMO_WORDS:
            self._clear()
        code = np.fromiter(map(self.memo.get, words, repeat(-1)), np.int64, len(words))
        miss = np.flatnonzero(code < 0).tolist()
        if miss:
            unknown = [words[i] for i in miss]
            self._learn(list(dict.fromkeys(unknown)))
            code[miss] = [self.memo[w] for w in unknown]
        return gather(self.flat, self.start, code)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        out, held, sizes = [], [], []

        def flush() -> None:
            if held:
                ids, count = self._ids(held)
                ends = np.concatenate([[0], np.cumsum(count)])
            else:
                ids, ends = np.empty(0, np.uint32), np.zeros(1, np.int64)
            edge = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            out.extend(ids[ends[a]:ends[b]] for a, b in zip(edge[:-1], edge[1:]))
            held.clear(), sizes.clear()

        for t in texts:
            words = self.split(t) if t else []
            if held and len(held) + len(words) > CHUNK_WORDS:
                flush()
            held += words
            sizes.append(len(words))
        flush()
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The token strings joined by a blank, as the file (without a decoder) defines; specials stay."""
        return " ".join(self.strings[ids].tolist())


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """One encoder per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def token_ids(text: Column, path: str) -> Column:
    """Column of ids (array of int) of a text column."""
    @F.pandas_udf("array<int>")
    def encode(batch: pd.Series) -> pd.Series:
        return pd.Series([x.astype(np.int32) for x in load(path).encode_batch(batch.fillna("").tolist())])

    return encode(text.cast("string"))


def decoded_text(ids: Column, path: str) -> Column:
    """Column of decoded texts of a column of ids; null ids give null."""
    @F.pandas_udf("string")
    def decode(batch: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else load(path).decode(np.asarray(x, np.int64)) for x in batch], dtype=object)

    return decode(ids)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``: each whole text is
    encoded, its ids are decoded again, and both are hashed where they are made, so that ids and decoded
    texts need not leave the task. Repeated rows give repeated results; an empty table an empty one."""
    ready(docs.sparkSession)

    def run(batches):
        bpe = load(path)
        for pdf in batches:
            found = bpe.encode_batch(pdf["text"].fillna("").tolist())
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                "n_tokens": [len(x) for x in found],
                "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found],
                "decoded_sha256": [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in found],
            }).astype({"n_tokens": "int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
