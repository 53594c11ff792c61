"""Language identification of whole texts, with spans of mixed-language text.

A model is learned from labelled rows: hashed character n-grams of words, and
which languages use which script. To label a text its words are found, the
script range of a word's letters narrows the languages it may belong to, each
word scores each remaining language, and a Viterbi path over the words with a
penalty for each switch labels every word. Runs of one label are the spans.

The path is exact, yet most words never enter the dynamic program. Against the
best single label b of a text, a stretch of other labels can only lie where the
running sum of the best possible gain over b stays positive and reaches the
penalty; only those stretches are decoded, all others are b.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and no span. Ties go to the language that sorts first. Words of a script that
no learned language uses score nothing. A table without labelled rows gives a
model without languages, by which every text is ``und``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import keep_named, ready, spare

#: Labelled documents taken per language to fit the model (a documented bound).
TRAIN_DOCS = 500
#: Hashed n-grams of these lengths.
BUCKET_BITS = 17
ORDERS = (1, 2, 3, 4)
#: Evidence of one word in nats: scale of summed n-gram log ratios, and the most one word can say.
WORD_SCALE, WORD_LIMIT = 0.3, 6.0
#: Cost of a change of language between two words.
SWITCH = 12.0
#: A language uses a script when at least this share of its training letters are of that script.
SCRIPT_SHARE = 0.01
#: Words remembered by a worker before its table is emptied.
MEMO_WORDS = 300_000

# First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x323AF)],
}
_RANGES = sorted((a, b, k) for k, name in enumerate(SCRIPTS) for a, b in SCRIPTS[name])
_FIRST = np.array([r[0] for r in _RANGES])
_LAST = np.array([r[1] for r in _RANGES])
_SCRIPT = np.array([r[2] for r in _RANGES])
OTHER = len(SCRIPTS)  # letters outside all ranges

_WORD = re.compile(r"[^\W\d_]+")
_LATIN = re.compile("[a-zªµºß-öø-ɏ]+").findall  # the same words where every letter is lower-case Latin
_BEYOND = re.compile("[A-ZÀ-ÖØ-Þ\u0250-\U0010ffff²³¹¼-¾]").search


def words_of(low: str) -> list[str]:
    """Runs of letters of a lower-case text."""
    return _WORD.findall(low) if _BEYOND(low) else _LATIN(low)


def lowered(text: str) -> str:
    """Lower case with every code point at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


def script_of(points: np.ndarray) -> np.ndarray:
    at = np.maximum(np.searchsorted(_FIRST, points, side="right") - 1, 0)
    return np.where((points >= _FIRST[at]) & (points <= _LAST[at]), _SCRIPT[at], OTHER)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, each between two marks, and start and end of each."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    flat = np.frombuffer("".join(["\x02" + w + "\x03" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    end = np.cumsum(size)
    return flat.astype(np.uint64), end - size, end


def _grams(flat: np.ndarray, start: np.ndarray, end: np.ndarray):
    """For each order: bucket of the n-gram at each place, and its word, for places where it fits."""
    word = np.repeat(np.arange(len(start)), end - start)
    left = np.repeat(end, end - start) - np.arange(len(flat))
    h = np.zeros(len(flat), np.uint64)
    for n in ORDERS:
        moved = np.zeros(len(flat), np.uint64)
        moved[:len(flat) - n + 1] = flat[n - 1:]
        h = (h * np.uint64(0x100000001B3) + moved) ^ np.uint64(n)
        fits = np.flatnonzero(left >= n)
        yield (h[fits] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS), word[fits], n


@dataclass
class Model:
    """Log ratios of n-gram buckets (one row per bucket, one column per language) and script use."""
    langs: list[str]
    weight: np.ndarray
    allowed: np.ndarray  # script x language
    memo: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.clear()

    def __getstate__(self):
        return {"langs": self.langs, "weight": self.weight, "allowed": self.allowed}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.clear()

    def clear(self) -> None:
        self.memo = {}
        self.score = np.empty((0, len(self.langs)), np.float32)
        self.letters = np.empty(0, np.int64)
        self.known = np.empty(0, bool)  # whether some language uses the word's script

    def word_scores(self, words: list[str]) -> np.ndarray:
        flat, start, end = _points(words)
        total = np.zeros((len(words), len(self.langs)), np.float64)
        for bucket, word, _ in _grams(flat, start, end):
            edge = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else word
            if len(word):
                total[word[edge]] += np.add.reduceat(self.weight[bucket], edge, axis=0)
        total = np.clip(total * WORD_SCALE, -WORD_LIMIT, WORD_LIMIT)
        may = self.allowed[script_of(flat[start + 1].astype(np.int64))]
        none = ~may.any(axis=1)
        total = np.where(may, total, -WORD_LIMIT)
        total[none] = 0
        return total.astype(np.float32)

    def codes(self, words: list[str]) -> np.ndarray:
        if len(self.memo) > MEMO_WORDS:
            self.clear()
        code = np.fromiter(map(self.memo.get, words, [-1] * len(words)), np.int64, len(words))
        miss = np.flatnonzero(code < 0).tolist()
        if miss:
            unknown = [words[i] for i in miss]
            new = list(dict.fromkeys(unknown))
            base = len(self.memo)
            self.memo.update(zip(new, range(base, base + len(new))))
            self.score = np.concatenate([self.score, self.word_scores(new)])
            self.letters = np.concatenate([self.letters, [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in new]])
            self.known = np.concatenate([self.known, self.allowed[script_of(np.array([ord(w[0]) for w in new]))].any(axis=1)])
            code[miss] = [self.memo[w] for w in unknown]
        return code


def viterbi(scores: list[np.ndarray], enter: np.ndarray, leave: np.ndarray) -> list[np.ndarray]:
    """Best labels of several sequences (steps x labels each) at once; ``enter`` and ``leave`` cost the first
    and last label of each. Sequences of like length are decoded together. Ties keep the label, then the lowest."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    while order:
        least, group, total = len(scores[order[0]]), [], 0
        while order and len(group) < 4096 and total < 400_000 and len(scores[order[0]]) <= 2 * least + 8:
            group.append(order.pop(0))
            total += len(scores[group[-1]])
        size = np.array([len(scores[i]) for i in group])
        steps, labels = size.max(), scores[group[0]].shape[1]
        s = np.zeros((steps, len(group), labels), np.float64)
        for k, i in enumerate(group):
            s[:size[k], k] = scores[i]
        now = s[0] - enter[group]
        back = np.zeros((steps, len(group), labels), np.int16)
        final = np.zeros_like(now)
        own = np.arange(labels)
        for t in range(steps):
            if t:
                top = now.argmax(axis=1)
                moved = now[np.arange(len(group)), top][:, None] - SWITCH
                keep = now >= moved
                back[t] = np.where(keep, own, top[:, None])
                now = np.where(keep, now, moved) + s[t]
            over = size == t + 1
            final[over] = now[over]
        label = (final - leave[group]).argmax(axis=1)
        path = np.zeros((steps, len(group)), np.int64)
        for t in range(steps - 1, -1, -1):
            label = np.where(size == t + 1, (final - leave[group]).argmax(axis=1), label)
            path[t] = label
            label = np.where(t < size, back[t][np.arange(len(group)), label], label)
        for k, i in enumerate(group):
            out[i] = path[:size[k], k]
    return out


def label_words(score: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Label of every word of several texts: ``score`` (words x labels), text d is words edge[d]:edge[d + 1]."""
    size = np.diff(edge)
    text = np.repeat(np.arange(len(size)), size)
    if not len(text) or score.shape[1] == 1:
        return np.zeros(len(text), np.int64)
    score = score.astype(np.float64)
    total = np.zeros((len(size), score.shape[1]))
    full = size > 0
    total[full] = np.add.reduceat(score, edge[:-1][full], axis=0)
    base = total.argmax(axis=1)
    label = base[text]
    gain = score - score[np.arange(len(text)), label][:, None]
    gain[np.arange(len(text)), label] = -np.inf
    gain = gain.max(axis=1)
    # running sums of the gain within each text, less the least sum so far (the penalty as credit at its start)
    run = np.cumsum(gain)
    run = run - (run - gain)[edge[:-1][full]].repeat(size[full])
    far = 4 * (np.abs(run).max() + SWITCH)
    low = np.minimum.accumulate(np.where(np.arange(len(text)) == edge[:-1][text], np.minimum(run, -SWITCH), run) - text * far) + text * far
    before = np.concatenate([[0.0], low[:-1]])
    before[edge[:-1][full]] = -SWITCH
    held = run - before
    on = held > 0
    change = np.flatnonzero(np.append(True, (on[1:] != on[:-1]) | (text[1:] != text[:-1])))
    peak = np.maximum.reduceat(held, change)
    stop = np.append(change[1:], len(text))
    pick = np.flatnonzero(on[change] & (peak >= SWITCH - 1e-6))
    if len(pick):
        a, b = change[pick], stop[pick]
        home = base[text[a]]
        cost = np.full((len(pick), score.shape[1]), SWITCH)
        cost[np.arange(len(pick)), home] = 0
        enter = np.where((a == edge[:-1][text[a]])[:, None], 0.0, cost)
        leave = np.where((b == edge[1:][text[a]])[:, None], 0.0, cost)
        for i, path in enumerate(viterbi([score[x:y] for x, y in zip(a, b)], enter, leave)):
            label[a[i]:b[i]] = path
    return label


def predict_batch(model: Model, texts: list[str | None], spans: bool = False) -> list[tuple[str, float, list]]:
    """(language, score, spans) of each text; a span is (language, start, end) in code points, and the spans
    of a text cover it from end to end. The score is the share of letters under the language, times the
    logistic of its lead over the next language on its own words (the mean per word, over at most 20 words)."""
    return [x[:3] for x in predict_proof(model, texts, spans)]


def predict_proof(model: Model, texts: list[str | None], spans: bool = False) -> list[tuple[str, float, list, float]]:
    """What ``predict_batch`` gives, and the proof of each text: its score with only the letters of words whose script some
    language uses counted under the language, and 0 where the language has no lead over the next one."""
    lows = [lowered(t) if t else "" for t in texts]
    found = [words_of(t) for t in lows]
    out: list[tuple[str, float, list, float]] = [("und", 0.0, [], 0.0)] * len(texts)
    if not model.langs:
        return out
    code = model.codes([w for x in found for w in x])
    letters = model.letters[code]
    edge = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
    score = model.score[code]
    label = label_words(score, edge)
    n = len(model.langs)
    text = np.repeat(np.arange(len(texts)), np.diff(edge))
    mass = np.bincount(text * n + label, weights=letters, minlength=len(texts) * n).reshape(-1, n)
    pred = mass.argmax(axis=1)
    inside = np.flatnonzero(label == pred[text])
    home = text[inside]
    proven = np.bincount(home, weights=(letters * model.known[code])[inside], minlength=len(texts))
    count = np.bincount(home, minlength=len(texts))
    sums = np.zeros((len(texts), n))
    some = np.flatnonzero(count)
    if len(some):
        sums[some] = np.add.reduceat(score[inside].astype(np.float64), np.cumsum(count)[some] - count[some], axis=0)
    best = sums[np.arange(len(texts)), pred].copy()
    sums[np.arange(len(texts)), pred] = -np.inf
    lead = best - sums.max(axis=1) if n > 1 else best + count
    for i in range(len(texts)):
        whole = mass[i].sum()
        if not whole:
            continue
        mean = lead[i] / max(1, count[i])
        sure = 1 / (1 + np.exp(-np.clip(mean * min(count[i], 20), -50, 50)))
        parts = []
        if spans:
            own_labels = label[edge[i]:edge[i + 1]]
            turn = np.flatnonzero(np.append(True, own_labels[1:] != own_labels[:-1]))
            at = [0]
            if len(turn) > 1:
                starts = [m.start() for m in _WORD.finditer(lows[i])]
                at = [0] + [starts[k] for k in turn[1:]]
            parts = [(model.langs[own_labels[k]], a, b) for k, a, b in zip(turn, at, [*at[1:], len(texts[i])])]
        proof = float(proven[i] / whole * sure) if lead[i] > 0 else 0.0
        out[i] = (model.langs[pred[i]], float(mass[i][pred[i]] / whole * sure), parts, proof)
    return out


def held_out(doc_id: Column) -> Column:
    """The third of the documents that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, per_lang: int = TRAIN_DOCS) -> DataFrame:
    """At most ``per_lang`` labelled rows of each language, the same ones for the same rows."""
    rows = keep_named(docs, {"doc_id": "long", "text": "string", "lang": "string"})
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    size = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not size:
        return rows.select("lang", "text")
    odds = F.create_map(*[F.lit(x) for k, n in size.items() for x in (k, min(1.0, 2.0 * per_lang / n + 8 / n))])
    draw = F.xxhash64("doc_id", "text")
    rows = rows.withColumn("draw", draw).where(F.pmod("draw", F.lit(1 << 20)) < odds[F.col("lang")] * (1 << 20))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    return rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_lang).select("lang", "text")


def train(docs: DataFrame, per_lang: int = TRAIN_DOCS) -> Model:
    """Fit a model on a bounded sample; what reaches the driver is one count per language and bucket or script."""
    ready(docs.sparkSession)
    sample = training_sample(docs, per_lang)

    def count(batches):
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                words = [w for t in texts for w in _WORD.findall(lowered(t)) if any(map(str.isalpha, w))]
                if not words:
                    continue
                flat, start, end = _points(words)
                for bucket, _, n in _grams(flat, start, end):
                    key, times = np.unique(bucket, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "kind": n, "key": key.astype(np.int64), "n": times.astype(np.int64)})
                key, times = np.unique(script_of(flat[flat > 3].astype(np.int64)), return_counts=True)
                yield pd.DataFrame({"lang": lang, "kind": 0, "key": key.astype(np.int64), "n": times.astype(np.int64)})

    counts = sample.mapInPandas(count, "lang string, kind int, key long, n long")
    pdf = counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")).toPandas()  # bounded: languages x buckets
    langs = sorted(pdf["lang"].unique())
    code = {x: i for i, x in enumerate(langs)}
    column = pdf["lang"].map(code).to_numpy(np.int64)
    weight = np.zeros((1 << BUCKET_BITS, len(langs)), np.float32)
    for n in ORDERS:
        part = (pdf["kind"] == n).to_numpy()
        hits = np.zeros((1 << BUCKET_BITS, len(langs)))
        np.add.at(hits, (pdf["key"].to_numpy()[part], column[part]), pdf["n"].to_numpy()[part])
        used = hits.sum(axis=1) > 0
        p = np.log((hits + 0.5) / (hits.sum(axis=0) + 0.5 * max(1, used.sum())))
        if len(langs):
            weight[used] += (p - p.mean(axis=1, keepdims=True))[used]
    allowed = np.zeros((OTHER + 1, len(langs)))
    part = (pdf["kind"] == 0).to_numpy()
    np.add.at(allowed, (pdf["key"].to_numpy()[part], column[part]), pdf["n"].to_numpy()[part])
    share = allowed / np.maximum(1, allowed.sum(axis=0))
    return Model(langs, weight, share >= SCRIPT_SHARE)


def language_columns(text: Column, model: Model, spark) -> Column:
    """Struct (lang, score, spans, proof) of a text column."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, spans array<struct<lang:string,start:int,end:int>>, proof double")
    def predict(batch: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else None for t in batch]
        found = predict_proof(held.value, texts, spans=True)
        return pd.DataFrame({"lang": [f[0] for f in found], "score": [f[1] for f in found],
                             "spans": [[{"lang": a, "start": b, "end": c} for a, b, c in f[2]] for f in found],
                             "proof": [f[3] for f in found]})

    return predict(text.cast("string"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred``, ``score`` and ``lang_spans`` (columns of these names are replaced)."""
    ready(docs.sparkSession)
    rows = docs.drop("lang_pred", "score", "lang_spans")
    name = spare(rows, "_language")
    found = rows.withColumn(name, language_columns(F.col("text"), model, docs.sparkSession))
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], F.col(f"{name}.lang").alias("lang_pred"),
                        F.col(f"{name}.score").alias("score"), F.col(f"{name}.spans").alias("lang_spans"))


def identify_and_keep(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """Rows whose language is known: not ``und`` and a proof of at least ``min_score``. So a text goes whose words are all of
    scripts that no learned language uses, or in which its language doesn't lead, or has too small a share of the letters
    in learned scripts. The columns of ``docs``, whatever their names, with their own values."""
    ready(docs.sparkSession)
    name = spare(docs, "_language")
    found = docs.withColumn(name, language_columns(F.col("text"), train(docs), docs.sparkSession))
    return found.where((F.col(f"{name}.lang") != "und") & (F.col(f"{name}.proof") >= min_score)).select(*[F.col(f"`{c}`") for c in docs.columns])
