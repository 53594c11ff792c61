"""Spelling variants and tokenizer alignment against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starforge.llm import alignment, spelling
from starforge.llm.common import stored
from starforge.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string"
CLASHES = ("word", "n", "rank", "nodes", "part", "key", "form", "root", "row", "pairs", "times", "pair", "best", "h", "at", "run", "doc")
A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def with_clashes(df):
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


# ---- 11 spelling

def forms_by_brute_force(rows, least_points=6, least_count=5, ratio=5, slip=199):
    n = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                w = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
                if h % slip == 0:
                    k = h % len(w)
                    w = w[:k] + w[k + 1:]
                if len(w) >= least_points:
                    n[w] += 1
            run = ""
    n = {w: k for w, k in n.items() if k >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, found = {}, {}
    for w in n:
        around = [v for v in n if near(w, v)]
        found[w] = len(around)
        top = min(around, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], found[w], n[form[w]] if form[w] else None))
    return out


def spelled(rng):
    words = ["spelling", "speling", "spellling", "speeling", "aaaaaa", "aaaaaaa", "aaabaaa", "ÄRGERÉ", "Ärgeré", "argeré", "×÷×÷×÷", "abcdefg", "bcdefg", "abcdef",
             "abcdxfg", "zzzzzz", "short", "word1word", "köpfen", "kopfen", "köpfenn"]
    rows = [(i if i % 11 else None, " ".join(rng.choices(words, weights=[3 ** (k % 5) for k in range(len(words))], k=40))) for i in range(60)]
    rows += [(500 + i, "chained " * 8 + "chaines " * (i % 7 == 0) + "chaimes" * (i % 90 == 0)) for i in range(450)]
    return rows + [(1000, None), (1001, ""), (1002, "...123"), (1003, "Y" * 3000 + " " + "Y" * 2999), (1003, "Y" * 3000)] + [(1004 + i, "y" * 3000) for i in range(5)]


@pytest.mark.parametrize("range_words", [3, 1000])
def test_variants_equal_brute_force(spark, range_words):
    rows = spelled(random.Random(range_words))
    docs = with_clashes(spark.createDataFrame([(*r, None) for r in rows], DOCS))
    got = spelling.variants(docs, slip=7, range_words=range_words).collect()
    expected = forms_by_brute_force(rows, slip=7)
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected
    assert any(r["form"] and r["root"] != r["form"] for r in got)


def test_trie_nodes_are_the_prefixes(spark):
    words = ["a", "ab", "abc", "abd", "b", "ba", "bab", "babc", "éa", "éb", "zz"]
    table = stored(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long"), "t")
    for k in (1, 2, 100):
        got = {r["word"]: r for r in spelling.trie_nodes(table, F.col("word"), "t", k).collect()}
        named = defaultdict(set)
        for w, r in got.items():
            assert len(r["nodes"]) == len(w) + 1
            for d, node in enumerate(r["nodes"]):
                named[node].add(w[:d])
        assert all(len(x) == 1 for x in named.values()) and len(named) == len({w[:d] for w in words for d in range(len(w) + 1)})
        assert [r["word"] for r in sorted(got.values(), key=lambda r: r["rank"])] == sorted(words)


def test_variants_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert spelling.variants(none).count() == 0
    assert spelling.variants(none.drop("text")).count() == 0
    assert spelling.variants(spark.createDataFrame([(None, None, None), (1, "no words", None)], DOCS)).count() == 0


# ---- 13 alignment

def aligned_by_brute_force(rows):
    both = alignment.Pair(A, B)
    a, b = both.a, both.b
    docs = []
    for doc_id, text in rows:
        ids_a = a.own.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.own.encode(text) if text else []
        whole = [b"".join(s.token_bytes[i] for i in x) for s, x in ((a, ids_a), (b, ids_b))]
        if not text or whole != [(" " + text).encode()] * 2:
            docs.append((doc_id, [], [], [], []))
            continue
        spans = []
        for s, ids in ((a, ids_a), (b, ids_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(s.token_bytes[i]), i))
                at = out[-1][1]
            spans.append(out)
        # every byte names its token on both sides
        owner = [[k for k, (x, y, _) in enumerate(side) for _ in range(y - x)] for side in spans]
        links = [(spans[0][i][2], spans[1][j][2]) for i, j in sorted(set(zip(*owner)))]
        groups = []
        edges = sorted({y for _, y, _ in spans[0]} & {y for _, y, _ in spans[1]})
        for low, high in zip([0, *edges], edges):
            groups.append("|".join(",".join(str(i) for x, y, i in side if low <= x and y <= high) for side in spans))
        docs.append((doc_id, ids_a, ids_b, links, groups))
    count = Counter(p for d in docs for p in set(d[3]))
    top = defaultdict(int)
    for (i, _), k in count.items():
        top[i] = max(top[i], k)
    return sorted(((d[0], len(d[1]), len(d[2]), len(d[4]), len(d[3]), sum(count[p] == top[p[0]] for p in d[3]), sum(count[p] for p in d[3]),
                    hashlib.sha256(";".join(d[4]).encode()).hexdigest() if d[1] else "") for d in docs), key=str)


ODD = ["", None, " ", "  ", "a  ", " a", "x▁y", "日本 😀 é", "\n\n  a\tb", "<s> <|endoftext|> </s>", "'s 't don't", "\x00", "é" * 300, " ▁ ", "a\n  b", "foo\n \nbar",
       "a \n b", "a\x85 b\xa0 \x1c c", "　a ɐ b  c", "a\r\n b", "tab \t tab", "x" * 5000, "word " * 20_000, "same text", "same text"]


def test_alignment_equals_brute_force(spark, monkeypatch):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(ODD + texts)] + [(3, "same text")]
    docs = with_clashes(spark.createDataFrame([(*r, None) for r in rows], DOCS))
    got = alignment.align_documents(docs, A, B)
    assert sorted((tuple(r) for r in got.collect()), key=str) == aligned_by_brute_force(rows)


def test_alignment_of_cold_pairs(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HOT_PAIRS", 1 / 20)  # most pairs take the shuffled way
    rows = [(i, f"the cat {i % 7} sat on mat {i}") for i in range(80)]
    docs = spark.createDataFrame([(*r, None) for r in rows], DOCS)
    assert sorted((tuple(r) for r in alignment.align_documents(docs, A, B).collect()), key=str) == aligned_by_brute_force(rows)


def test_alignment_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert alignment.align_documents(none, A, B).count() == 0
    got = alignment.align_documents(spark.createDataFrame([(5,)], "doc_id long"), A, B).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "")]


def test_words_are_cut_where_both_libraries_cut():
    both = alignment.Pair(A, B)
    assert both.by_words
    texts = [f.replace("%", chr(c)) for c in range(1, 0x250) for f in ("a%b", "a % b", "x %y", "z% w", "%", "1%2 %%3")]
    ids, count = alignment.align(texts, both), 0
    for k, t in enumerate(texts):
        a, b = both.a.own.encode(" " + t, add_special_tokens=False).ids, both.b.own.encode(t)
        whole = b"".join(both.b.token_bytes[i] for i in b) == (" " + t).encode()
        count += whole
        assert (ids["n_a"][k], ids["n_b"][k]) == ((len(a), len(b)) if whole else (0, 0))
    assert count > 3000
