"""Personal data in texts: fixed patterns, and a linear-chain conditional random field for what they miss.

The patterns find e-mail addresses, IPv4 addresses, payment cards and international phone numbers; their spans always
stay. The field labels tokens (letter runs, digit runs, single marks) with the four kinds, from word-shape features of a
token and its neighbours, and adds spans that no base span overlaps: national phone numbers, IPv6 addresses, cards in
other groupings, addresses with a written-out at. It is trained by gradient ascent on a small labelled table, of at most
MAX_ROWS rows, and decoded by Viterbi in numpy over many sequences at once.

A span holds a digit, an @ or a bracketed "at", so sequences are cut around those: WINDOW characters to either
side within the line, merged where they meet. An added span must also be of its kind's form (digits of a phone, Luhn
sum of a card, a valid IPv6 address).

Defined results: null counts as empty, without spans. Offsets are code points, ends exclusive. Repeated rows repeat; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm.common import keep_named, ready

KINDS = ("email", "ip", "card", "phone")
#: Rows of the labelled table that training reads, at most.
MAX_ROWS = 2_000
#: Characters of context on either side of a seed.
WINDOW = 60
ROUNDS, RATE, DECAY = 90, 0.4, 0.002

LABELS = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns: kind, start, end; by kind, then start."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:  # the leftmost start of an address is that of the run before its @
        left = at
        while left > end and text[left - 1] in _LOCAL:
            left -= 1
        m = _DOMAIN.match(text, at + 1) if left < at else None
        if m:
            end = m.end()
            out.append(("email", left, end))
        at = text.find("@", max(at + 1, end))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p := part.lstrip("0")) < 4 and int(p or "0") <= 255 for part in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# ---- word shapes

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_SEED = re.compile(r"[0-9@]|[(\[{]\s?at\s?[)\]}]", re.I)
_MARKS = "@.-()+:/_%[]{},;#'\"*&=$€£"
_CUES = {  # fixed values: words that announce a kind
    "at": ("at",), "dot": ("dot",), "domain": ("com", "org", "net", "example", "edu", "info"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell", "telephone", "ring"),
    "card": ("card", "visa", "mastercard", "credit", "debit"), "ip": ("ip", "host", "server", "address", "addr", "ping"),
    "mail": ("mail", "email", "write", "contact"), "number": ("no", "nr", "id", "order", "version", "page", "isbn", "invoice", "line", "year"),
}
_CUE = {w: i for i, ws in enumerate(_CUES.values()) for w in ws}
_N = 1 + 6 + 7 + len(_MARKS) + 1 + len(_CUES) + 1
SHAPES = 2 * _N  # each with and without a blank before


def shape(token: str) -> int:
    """Number of a token's shape, 1 to _N - 1 (0 stands for outside of the sequence)."""
    c = token[0]
    if "0" <= c <= "9":
        n = len(token)
        return 7 + (n - 1 if n <= 4 else 4 if n <= 8 else 5 if n <= 12 else 6)
    if c.isalpha():
        low = token.lower()
        if low in _CUE:
            return 15 + len(_MARKS) + _CUE[low]
        if len(token) <= 4 and all(x in "abcdef" for x in low):
            return 15 + len(_MARKS) + len(_CUES)  # may be part of a hexadecimal group
        if len(token) == 1:
            return 1
        return 2 if token.islower() else 4 if token.isupper() else 3 if token[1:].islower() else 5
    at = _MARKS.find(c)
    return 14 + at if at >= 0 else 14 + len(_MARKS)


def sequences(text: str) -> list[tuple[list[tuple[int, int]], np.ndarray]]:
    """(token spans, shapes) of the stretches of a text that can hold a span."""
    windows: list[list[int]] = []
    for m in _SEED.finditer(text):
        a, b = m.span()
        if windows and a < windows[-1][1]:
            if b + WINDOW <= windows[-1][1]:
                continue
        line_end = text.find("\n", b, b + WINDOW)
        stop = line_end if line_end >= 0 else min(len(text), b + WINDOW)
        if windows and a <= windows[-1][1]:
            windows[-1][1] = max(stop, windows[-1][1])
            continue
        line_start = text.rfind("\n", max(0, a - WINDOW), a)
        start = line_start + 1 if line_start >= 0 else max(0, a - WINDOW)
        if windows and start <= windows[-1][1]:
            windows[-1][1] = stop
        else:
            windows.append([start, stop])
    out = []
    for a, b in windows:
        # don't cut a token in two
        while a > 0 and b > a and text[a - 1].isalnum() and text[a].isalnum():
            a -= 1
        while b < len(text) and text[b - 1].isalnum() and text[b].isalnum():
            b += 1
        spans = [m.span() for m in _TOKEN.finditer(text, a, b)]
        glued = [0] + [int(x[1] == y[0]) for x, y in zip(spans, spans[1:])]
        out.append((spans, np.array([shape(text[x:y]) + _N * g for (x, y), g in zip(spans, glued)], np.int64)))
    return out


OFFSETS = (-3, -2, -1, 0, 1, 2, 3)


class Crf:
    """Weights: shape at an offset x label, pairs of neighbouring shapes x label, label x next label, first label."""

    def __init__(self):
        k = len(LABELS)
        self.near = np.zeros((len(OFFSETS), SHAPES, k))
        self.left = np.zeros((SHAPES * SHAPES, k))
        self.right = np.zeros((SHAPES * SHAPES, k))
        self.move = np.zeros((k, k))
        self.first = np.zeros(k)
        for i, a in enumerate(LABELS):  # an I only follows B or I of its kind
            for j, b in enumerate(LABELS):
                if b[0] == "I" and a[2:] != b[2:]:
                    self.move[i, j] = -np.inf
        self.first[[x[0] == "I" for x in LABELS]] = -np.inf

    @staticmethod
    def pad(shapes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(s) for s in shapes])
        grid = np.zeros((len(shapes), size.max() + 2 * max(OFFSETS)), np.int64)
        for row, s in zip(grid, shapes):
            row[max(OFFSETS):max(OFFSETS) + len(s)] = s
        return grid, size

    def parts(self, grid: np.ndarray):
        m = max(OFFSETS)
        steps = grid.shape[1] - 2 * m
        at = [grid[:, m + o:m + o + steps] for o in OFFSETS]
        return at, at[m - 1] * SHAPES + at[m], at[m] * SHAPES + at[m + 1]

    def emissions(self, grid: np.ndarray) -> np.ndarray:
        at, left, right = self.parts(grid)
        return sum(w[x] for w, x in zip(self.near, at)) + self.left[left] + self.right[right]

    def viterbi(self, shapes: list[np.ndarray]) -> list[np.ndarray]:
        """Best label sequences, decoded together in groups of like length."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(shapes)
        order = sorted((i for i in range(len(shapes)) if len(shapes[i])), key=lambda i: len(shapes[i]))
        for at in range(0, len(order), 256):
            group = order[at:at + 256]
            grid, size = self.pad([shapes[i] for i in group])
            e = self.emissions(grid)
            rows = np.arange(len(group))
            now = e[:, 0] + self.first
            back = np.zeros(e.shape, np.int8)
            final = np.where((size == 1)[:, None], now, 0.0)
            for t in range(1, e.shape[1]):
                every = now[:, :, None] + self.move
                back[:, t] = every.argmax(axis=1)
                now = every.max(axis=1) + e[:, t]
                final = np.where((size == t + 1)[:, None], now, final)
            label = final.argmax(axis=1)
            path = np.zeros(e.shape[:2], np.int64)
            for t in range(e.shape[1] - 1, -1, -1):
                label = np.where(t == size - 1, final.argmax(axis=1), label)
                path[:, t] = label
                label = np.where(t < size, back[rows, t, label], label)
            for r, i in enumerate(group):
                out[i] = path[r, :size[r]]
        return out

    def fit(self, shapes: list[np.ndarray], labels: list[np.ndarray]) -> "Crf":
        """Maximise the likelihood less an L2 term by adaptive gradient steps over all sequences."""
        grid, size = self.pad(shapes)
        at, left, right = self.parts(grid)
        n, steps = at[0].shape
        gold = np.zeros((n, steps), np.int64)
        for row, y in zip(gold, labels):
            row[:len(y)] = y
        live = np.arange(steps)[None, :] < size[:, None]
        hot = np.eye(len(LABELS))[gold] * live[:, :, None]
        may_move, may_first = np.isfinite(self.move), np.isfinite(self.first)
        pairs = np.zeros_like(self.move)
        both = live[:, 1:]
        np.add.at(pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        tables = [self.near, self.left, self.right, self.move, self.first]
        memory = [np.full_like(x, 1e-6) for x in tables]

        def lse(x, axis):
            top = x.max(axis=axis, keepdims=True)
            top = np.where(np.isfinite(top), top, 0)
            with np.errstate(divide="ignore"):
                return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

        for _ in range(ROUNDS):
            e = self.emissions(grid)
            fwd, bwd = np.zeros(e.shape), np.zeros(e.shape)
            fwd[:, 0] = e[:, 0] + self.first
            for t in range(1, steps):
                fwd[:, t] = np.where(live[:, t, None], lse(fwd[:, t - 1, :, None] + self.move, 1) + e[:, t], fwd[:, t - 1])
            for t in range(steps - 2, -1, -1):
                bwd[:, t] = np.where(live[:, t + 1, None], lse(self.move + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2), 0.0)
            z = lse(fwd[:, -1], 1)
            p = np.exp(fwd + bwd - z[:, None, None]) * live[:, :, None]
            diff = hot - p
            flow = np.zeros_like(self.move)
            for t in range(1, steps):
                joint = np.exp(fwd[:, t - 1, :, None] + self.move + (e[:, t] + bwd[:, t])[:, None, :] - z[:, None, None])
                flow += joint[live[:, t]].sum(axis=0)
            flat = diff.reshape(-1, len(LABELS))

            def spread(index, rows):
                out = np.zeros((rows, len(LABELS)))
                np.add.at(out, index.ravel(), flat)
                return out

            grads = [np.stack([spread(x, SHAPES) for x in at]), spread(left, SHAPES**2), spread(right, SHAPES**2), pairs - flow, diff[:, 0].sum(axis=0)]
            for table, g, m in zip(tables, grads, memory):
                known = np.isfinite(table)
                g = np.where(known, g - DECAY * np.where(known, table, 0) * n, 0)
                m += g * g
                table += RATE * g / np.sqrt(m)
        self.move[~may_move] = -np.inf
        self.first[~may_first] = -np.inf
        return self


def added_spans(crf: Crf, texts: list[str], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """Spans that the field adds to the base spans of each text."""
    held = [(i, spans, shapes) for i, t in enumerate(texts) for spans, shapes in sequences(t) if spans]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    taken = [sorted(x[1:] for x in b) for b in base]
    for (i, spans, _), path in zip(held, crf.viterbi([s for _, _, s in held])):
        t = 0
        while t < len(path):
            name = LABELS[path[t]]
            if name == "O":
                t += 1
                continue
            stop = t + 1
            while stop < len(path) and LABELS[path[stop]] == "I-" + name[2:]:
                stop += 1
            a, b = spans[t][0], spans[stop - 1][1]
            if not any(x < b and a < y for x, y in taken[i]) and plausible(name[2:], texts[i][a:b]):
                out[i].append((name[2:], a, b))
            t = stop
    return out


def plausible(kind: str, s: str) -> bool:
    """Whether an added span has the form of its kind."""
    digits = _digits(s)
    if kind == "phone":
        return 7 <= len(digits) <= 15 and all(c.isdigit() or c in " ()-./+" for c in s) and any(c in " ()-./" for c in s)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and all(c.isdigit() or c in " -." for c in s)
    if kind == "ip":
        try:
            return s.count(":") > 1 and ipaddress.ip_address(s).version == 6
        except ValueError:
            return False
    return bool(re.fullmatch(r"[\w.%+-]+\s?(?:@|[(\[{]\s?at\s?[)\]}])\s?[\w-]+(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?[\w-]+)+", s, re.I))


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


# ---- the labelled table

def labelled_rows(n: int = 700, seed: int = 5) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Small labelled table, made by rule: invented sentences with one or two items, each with its spans; a third of the
    items are numbers that are no personal data."""
    rng = np.random.default_rng(seed)
    pick = lambda *x: x[rng.integers(len(x))]
    num = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    word = lambda: "".join(pick("er", "an", "th", "in", "on", "re", "ou", "st", "le", "de", "ch", "ie", "os", "qu") for _ in range(rng.integers(1, 4)))

    def card() -> str:
        d = "4" + num(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return pick(d, *(s.join(d[i:i + 4] for i in range(0, 16, 4)) for s in " -."))

    def email() -> str:
        at, dot = pick(("@", "."), ("@", "."), ("(at)", "."), (" [at] ", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"))
        return pick(word(), f"{word()}.{word()}", word() + num(2)) + at + pick(word(), word() + num(1)) + dot + pick("com", "org", "net", "example", "de")

    def phone() -> str:
        return pick(f"+{num(2)} {num(3)} {num(4)} {num(3)}", f"+1 ({num(3)}) {num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}",
                    f"00{num(2)} {num(3)} {num(6)}", f"0{num(2)} {num(4)} {num(4)}", f"0{num(3)}/{num(7)}")

    def ip() -> str:
        hexes = lambda: format(int(rng.integers(1, 65536)), "x")
        return pick(".".join(str(x) for x in rng.integers(0, 256, 4)), ":".join(hexes() for _ in range(8)), f"2001:db8::{hexes()}", f"fe80::{hexes()}:{hexes()}")

    def nothing() -> str:
        return pick(f"{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", f"{num(2)}:{num(2)}", f"{num(2)}.{num(2)}", f"{num(1)}.{num(1)}.{num(2)}", num(4), num(2),
                    f"no {num(5)}", num(8), f"{num(3)},{num(3)}", f"{num(2)}-{num(2)}", f"{num(3)} {word()}", f"page {num(3)}", f"= \"{num(4)}be{num(6)}ca{num(5)}\"", f"{num(2)}%", f"$ {num(3)}.{num(2)}",
                    f"isbn {num(3)}-{num(1)}-{num(4)}-{num(4)}-{num(1)}", f"{num(1)}, {num(2)}, {num(3)}, {num(3)}", f"{num(4)} - {num(4)}", num(16), f"@{word()}", f"{word()} at {word()}", f"{num(2)}/{num(2)}/{num(4)}")

    makers = {"email": email, "phone": phone, "card": card, "ip": ip}
    rows = []
    for _ in range(n):
        text, spans = " ".join(word() for _ in range(rng.integers(0, 7))), []
        for _ in range(rng.integers(1, 3)):
            kind = pick("email", "phone", "card", "ip", "none", "none")
            cue = pick("", "", word() + " ", *({"phone": ("tel ", "phone: ", "call "), "email": ("mail ", "contact: "), "card": ("card ", "visa "), "ip": ("ip ", "host ")}.get(kind, ("no ", "order ", "year "))))
            text += pick(" ", " ", ". ", " (", "### ") + cue
            item = makers.get(kind, nothing)()
            if kind != "none":
                spans.append((kind, len(text), len(text) + len(item)))
            text += item + pick(" ", " ", ". ", ", ", ") ", "$$$ ") + " ".join(word() for _ in range(rng.integers(0, 6)))
        rows.append((text, spans))
    return rows


def labelled_table(spark: SparkSession, n: int = 700, seed: int = 5) -> DataFrame:
    """The labelled table as a DataFrame (text, spans)."""
    rows = [(t, [{"kind": k, "start": a, "end": b} for k, a, b in s]) for t, s in labelled_rows(n, seed)]
    return spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:int,end:int>>")


def token_labels(spans: list[tuple[int, int]], gold: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(len(spans), np.int64)
    for kind, a, b in gold:
        inside = [i for i, (x, y) in enumerate(spans) if x >= a and y <= b]
        for i in inside:
            out[i] = LABELS.index(("B-" if i == inside[0] else "I-") + kind)
    return out


def fit_rows(rows: list[tuple[str, list[tuple[str, int, int]]]]) -> Crf:
    """Fit on labelled rows; the driver remembers the last tables it has fitted."""
    return _fit(tuple((text, tuple(map(tuple, gold))) for text, gold in rows))


@functools.lru_cache(maxsize=4)
def _fit(rows: tuple) -> Crf:
    pairs = [(shapes, token_labels(spans, gold)) for text, gold in rows for spans, shapes in sequences(text) if spans]
    return Crf().fit([s for s, _ in pairs], [y for _, y in pairs]) if pairs else Crf()


def train(table: DataFrame) -> Crf:
    """Fit on the labelled table (text, spans), at most MAX_ROWS rows of it in the order of their hashes."""
    rows = table.where("text is not null").orderBy(F.xxhash64("text"), "text").limit(MAX_ROWS).collect()
    return fit_rows([(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["spans"] or []]) for r in rows])


def personal_data(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 (of the base
    spans' text), spans (all spans' text), n_added."""
    spark = docs.sparkSession
    ready(spark)
    held = spark.sparkContext.broadcast(crf or train(labelled_table(spark)))

    def run(batches):
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            base = [base_spans(t) for t in texts]
            more = added_spans(held.value, texts, base)
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                **{f"n_{k}": np.array([sum(s[0] == k for s in b) for b in base], np.int64) for k in KINDS},
                "base_sha256": [hashlib.sha256(spans_text(b).encode()).hexdigest() for b in base],
                "spans": [spans_text(b + m) for b, m in zip(base, more)],
                "n_added": np.array([len(m) for m in more], np.int64)})

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    return keep_named(docs, {"doc_id": "long", "text": "string"}).mapInPandas(run, schema)
