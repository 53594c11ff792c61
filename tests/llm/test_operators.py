"""Each corpus operator against brute force on small tables, with nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns of clashing names."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_compare import compare
from starforge.llm import bpe, chat, decontaminate, exact_dedup, langid, licenses, pii, sharding, simhash, warc
from starforge.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


CLASHES = ("key", "norm", "fp", "sha", "score", "shard", "_block", "bucket", "words", "n", "lang_pred", "_language", "_hash", "_sha", "_points",
           "_id", "_key", "_least", "_keep", "_gone_id", "any", "text_sha256", "root")


def odd_rows(spark):
    """Nulls everywhere, blanks, ties, repeats, a long text, and columns whose names the operators use."""
    long = "wort und " * 30_000
    rows = [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", 0), (3, " \t\n", "en", "s", 3),
            (4, "Same text here", "en", "s", 1), (5, "Sametext  here", "en", "s", 1), (5, "Sametext  here", "en", "s", 1), (7, long, "de", "s", 9),
            (None, "Same text here", None, None, None), (8, "\x00 x\x1c<|endoftext|> ‍ Σ 😀", "en", "s", 2), (9, "12 + 3", "en", "s", 6)]
    df = spark.createDataFrame(rows, DOCS)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    ok, message = compare(QUERIES[name](spark, SF), con, ORACLE_SQL[name])
    assert ok, message


@pytest.mark.parametrize("name", ["op4_licenses", "op6_exact_dedup"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_operator_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names


# ---- 1 WARC

def test_warc_round_trip(spark):
    same = "same é\r\n\r\nbody"
    rows = [(1, "http://www.b.org/x?Q=1#f", "<p>one</p>"), (2, None, same), (3, "https://a.b.org:8443/", same), (4, "x y\nz", None),
            (5, "", ""), (None, "http://b.org/", same), (7, "http://[bad", "seven " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    least = {}
    for p, _, h in rows:
        body = (h or "").encode()
        least[body] = min(least.get(body, math.inf), math.inf if p is None else p)
    for p, _, h in rows:
        body, r = (h or "").encode(), got[p]
        first = least[body] == (math.inf if p is None else p)
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first else ("revisit", least[body]))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_index_finds_captures_and_prefixes(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.example.com/p/{i}", f"body {i}") for i in range(300)], "page_id long, url string, html string")
    folder, captures, _ = warc.archive(pages)
    directory = warc.build_index(captures, folder, block_lines=16)
    assert directory.count() >= 300 // 16
    one = warc.look_up(captures.where("page_id in (3, 77)"), directory, folder)
    assert sorted(r["page_id"] for r in warc.read_records(one, folder).collect()) == [3, 77]
    assert warc.look_up(captures.limit(1).withColumn("key", F.lit("com,none)/ 0")), directory, folder).count() == 0
    assert len(warc.find_prefix("com,example,h3)", warc.load_directory(directory), folder)) == sum(i % 7 == 3 for i in range(300))
    assert warc.surt("HTTP://www.Example.com:80/A?b=C#z") == "com,example,www)/a?b=c"


def test_warc_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "a.org", "ab"), (2, "b.org", "ab")], "page_id long, url string, html string")
    assert {r["record_type"] for r in warc.round_trip(pages, least_bytes=3).collect()} == {"response"}


# ---- 2 chat

def test_chat_escapes_and_masks(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    for s in ("<|im_end|>", "<\\|x", "<\\\\|", "<||", "a\nb\\", "<|endoftext|>", "\\n<|", ""):
        assert chat.unescape(chat.escape(s)) == s and chat.unescape_role(chat.escape_role(s)) == s and "<|" not in chat.escape(s)
    turns = [(1, 0, "user", "<|im_start|>system"), (1, 1, "assistant", "ok <|im_end|>"), (1, 1, "assistant", "ok <|im_end|>"), (1, 3, "assistant", None),
             (2, None, None, None), (None, 0, "a\nb", "é😀"), (3, 0, "assistant", "long " * 20_000)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("clash"))
    made = chat.format_turns(rows, path)
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.read_turns(made, path)).collect()}
    for conv in (1, 2, None, 3):
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] or 0, t[2] or "", t[3] or ""))
        said = "".join(t[3] or "" for t in own if t[2] == "assistant")
        text = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[conv]["n_turns"] == len(own)
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.conversation_digests(chat.read_turns(chat.format_turns(rows.limit(0), path), path)).count() == 0


# ---- 3 BPE

def test_bpe_equals_the_library(docs):
    from tokenizers import Tokenizer
    library, own = Tokenizer.from_file(WORD), bpe.Bpe(WORD)
    rng = np.random.default_rng(1)
    pool = ["a", "aaa", "A", "the", "'s", "'LL", " ", "\n", "\x1c", "\x85", " ", "​", "é", "é", "ſ", "İ", "Σ", "<|endoftext|>", "<|", "٣", "你好", "😀", "!!!", "\0", "Ⅷ", "²", "ª", "_"]
    texts = ["".join(rng.choice(pool, rng.integers(0, 30))) for _ in range(1500)] + ["a" * 3000, "ab" * 2000 + "!" * 3000, ""]
    texts += [r["text"] for r in docs.select("text").collect()]
    for text, ids in zip(texts, own.encode_batch(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and own.decode(ids) == library.decode(want, skip_special_tokens=False), text[:80]


def test_bpe_merges_one_at_a_time_where_order_matters():
    own = bpe.Bpe(WORD)
    words = [b"banana", b"aaaaaaa", "été".encode(), b"x"]
    at_once = own.merge(words)
    own.at_once = np.zeros_like(own.at_once)
    for x, y in zip(at_once, own.merge(words)):
        assert x.tolist() == y.tolist()


def test_bpe_query_rows(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORD)
    got = bpe.token_digests(odd_rows(spark), WORD).collect()
    want = Counter()
    for r in odd_rows(spark).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want[(r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
              hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in got) == want
    assert bpe.token_digests(empty(spark), WORD).count() == 0


# ---- 4 licences

def test_licences(spark):
    notice = "Permission to use, copy, modify, and/or distribute this software for any purpose\nwith or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    rows = [(1, "word. Released under the MIT license! more", None, None, None), (2, notice, None, None, None), (3, "released under mit", None, None, None),
            (4, "x" * 100_000, None, None, None), (4, None, None, None, None)]
    both = spark.createDataFrame(rows, DOCS).unionByName(odd_rows(spark), allowMissingColumns=True)
    got = {(r["doc_id"], r["license"], r["dice"], r["level"]) for r in licenses.scan(both).collect()}
    assert got == {(1, "MIT", 1.0, 1), (2, "ISC", 1.0, 2)}
    assert licenses.scan(empty(spark)).count() == 0


def licences_of(spark, texts):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = licenses.scan(spark.createDataFrame(rows, DOCS)).collect()
    return [sorted((r["license"], r["n_units"]) for r in got if r["doc_id"] == i) for i in range(len(texts))]


def test_notices_that_are_no_units(spark):
    import textwrap
    body = {k: [t for a, t in licenses.TEMPLATES if a == k] for k, _ in licenses.TEMPLATES}
    comment = lambda *x: "import os\n" + "\n#\n".join("\n".join("# " + y for y in textwrap.wrap(t, 60)) for t in x) + "\ncode = 1\n" * 90
    bsd = "\n".join(textwrap.wrap(body["BSD"][0], 60)) + "\n1. Source code must keep the notice above, this list and the text below.\n2. Binaries must too."
    got = licences_of(spark, [comment(body["GPL-3.0"][1], body["GPL-warranty"][0]), comment(*body["MIT"][2:]), bsd,
                              "See the file: it is distributed under the MIT License. " + "word " * 200, "we say that all is licensed under the Apache License 2.0 here",
                              "permission to use the software " * 60, "a b c"])
    assert [[k for k, _ in g] for g in got] == [["GPL-3.0", "GPL-warranty"], ["MIT"], ["BSD"], ["MIT"], ["Apache-2.0"], [], []]
    assert got[1] == [("MIT", 2)] and got[0][0][1] == 1


def test_a_unit_counts_for_its_nearest_licence(spark):
    gnu = [(k, t) for k, t in licenses.TEMPLATES + licenses.WORDINGS if k != "Unlicense" and "is free software" in t]
    assert {k for k, _ in gnu} == {"GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-3.0", "LGPL-2.1"}
    got = licences_of(spark, [f"some words here\n{t}\n" + "more words and code follow " * 50 for _, t in gnu])
    assert got == [[(k, 1)] for k, _ in gnu]


def test_anchors_are_in_every_window():
    every = licenses.TEMPLATES + licenses.WORDINGS
    found = set(licenses.anchors(every))
    for _, text in every:
        words = re.sub(r"[\W_]+", " ", text.lower()).split()
        t, free = len(words) - 1, sum(not {x, y} & found for x, y in zip(words, words[1:]))
        assert 2 * free / (free + t) < licenses.THRESHOLD


def test_phrases_are_in_every_match(spark):
    index = licenses.template_bigrams(spark, licenses.TEMPLATES + licenses.WORDINGS).collect()
    held = licenses.phrases(index)
    for k in {r["template"] for r in index}:
        t, free = next(r["t"] for r in index if r["template"] == k), sum(r["t_count"] for r in index if r["template"] == k and r["bigram"] not in held)
        assert 2 * free / (free + t) < licenses.THRESHOLD
    assert licenses.phrases([]) == []


def test_texts_are_read_once_and_cut_only_with_a_phrase(spark):
    plan = QUERIES["op4_licenses"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    rows = [(1, "a file\nlicensed by us, UNDER license"), (2, "so Licensed -- under\nit"), (3, "all rights are reserved"), (4, "x. All Rights\n# Reserved"), (5, None), (6, "")]
    cut = licenses.units(spark.createDataFrame(rows, "doc_id long, text string"), ["licensed under", "rights reserved"]).collect()
    assert sorted({r["doc_id"] for r in cut}) == [2, 4]
    assert [r["words"] for r in cut if r["doc_id"] == 4 and r["level"] > 2] == [["x", "all", "rights", "reserved"]] * 2


def test_phrases_lose_no_notice(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(160):
        parts = []
        for _ in range(rng.integers(1, 4)):
            _, text = (licenses.TEMPLATES + licenses.WORDINGS)[rng.integers(len(licenses.TEMPLATES + licenses.WORDINGS))]
            words = text.split()
            for _ in range(rng.integers(0, 1 + len(words) // 6)):  # words lost, changed or added
                j = rng.integers(len(words))
                words[j:j + 1] = [[], ["other"], [words[j], "of the"]][rng.integers(3)]
            parts += ["word " * rng.integers(0, 9), [" ", "\n# "][rng.integers(2)].join(words), ["", "\n", ". Then\n\n", " and "][rng.integers(4)]]
        rows.append((None if i % 23 == 0 else i, "".join(parts)))
    docs = spark.createDataFrame(rows + rows[::9], "doc_id long, text string")
    result = lambda: sorted((tuple(r) for r in licenses.scan(docs).collect()), key=str)
    got = result()
    monkeypatch.setattr(licenses, "phrases", lambda index, threshold: sorted({r["bigram"] for r in index}))
    assert got == result() and len(got) > 100 and {r[3] for r in got} >= {1, 2, 4}


# ---- 5 decontamination

def sellers(pattern: bytes, text: bytes) -> int:
    row, cost, data = np.zeros(len(text) + 1, int), np.arange(len(text) + 1), np.frombuffer(text, np.uint8)
    for i, x in enumerate(pattern):
        new = np.empty_like(row)
        new[0], new[1:] = i + 1, np.minimum(row[:-1] + (data != x), row[1:] + 1)
        row = np.minimum.accumulate(new - cost) + cost
    return row.min()


def test_leaks_equal_brute_force(spark, docs):
    rng = np.random.default_rng(3)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:20] + [(101, "twenty chars of text."), (103, "short"), (104, "")]
    block = decontaminate.make_block(items)
    texts = [r["text"] for r in docs.select("text").limit(40).collect()]
    found = 0
    for _ in range(150):
        _, item = items[rng.integers(len(items) - 1)]
        a = rng.integers(max(1, len(item) - 70))
        piece = list(item[a:a + rng.choice([64, 80, 400])])
        for _ in range(rng.integers(0, 11)):
            j = rng.integers(len(piece))
            piece[j:j + 1] = [["q"], [], ["q", piece[j]]][rng.integers(3)]
            piece = piece or ["q"]
        text = texts[rng.integers(len(texts))][:200] + " " + "".join(piece) + " " + texts[rng.integers(len(texts))][:200]
        flat = decontaminate.normalise([text])[0]
        plain = flat[flat != 0].tobytes()
        want = {block.items[w] for w, t in enumerate(block.text) if sellers(t, plain) <= decontaminate.budget(len(t))}
        want |= {i for i, s in block.short if b" " + s + b" " in b" " + plain + b" "}
        assert {x[0] for x in decontaminate.find_leaks(block, [text])[0]} == want
        found += len(want)
    assert found > 50


def test_every_passage_of_a_span_is_a_leak(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:8]
    block = decontaminate.make_block(items)
    before, after, passages = "0123456789 " * 12, " 9876543210" * 12, []
    for item, text in items:
        flat = decontaminate.normalise([text])[0]
        norm = flat[flat != 0].tobytes().strip()
        cuts = [norm[a:a + decontaminate.SPAN] for a in range(len(norm) - decontaminate.SPAN + 1)]
        passages += [(item, c.decode()) for c in cuts if c.decode("utf-8", "ignore").encode() == c]
    found = decontaminate.find_leaks(block, [before + c + after for _, c in passages])
    assert len(passages) > 500 and all(item in {x[0] for x in f} for (item, _), f in zip(passages, found))


def test_leaks_of_tables(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    texts, items = [(r["doc_id"], r["text"].lower()) for r in docs.collect()], [(r["item_id"], r["text"].lower()) for r in bench.collect()]
    assert got >= {(d, i) for d, t in texts for i, s in items if s in t}
    odd = odd_rows(spark)
    assert decontaminate.leaks(odd, bench).count() == 0 and decontaminate.keep_clean(odd, bench).columns == odd.columns
    assert decontaminate.keep_clean(odd, bench).count() == odd.count()
    long = "a passage of a benchmark item that no other text holds word for word"
    items = spark.createDataFrame([(None, long), (8, "yes"), (9, "the capital of France")], "item_id long, text string")
    some = spark.createDataFrame([(1, f"before {long} after"), (2, "well yes it is"), (3, "Paris is the capital of France"), (4, "clean")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(some, items).collect()} == {(1, None), (2, 8), (3, 9)}
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(some, items).collect()) == [2, 3, 4]
    assert decontaminate.leaks(odd, bench.limit(0)).count() == 0 and decontaminate.leaks(empty(spark), bench).count() == 0


# ---- 6 exact dedup

@pytest.mark.parametrize("capacity", [exact_dedup.CAPACITY, 9])
def test_exact_dedup(spark, docs, capacity):
    odd = odd_rows(spark)
    rows = docs.unionByName(odd.select(*docs.columns)).unionByName(docs.limit(60))
    got = exact_dedup.deduplicate(rows, capacity).collect()
    groups = {}
    for r in rows.collect():
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", r["text"] or ""), []).append((-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"]))
    want = {hashlib.sha256(k.encode()).hexdigest(): (min(v, key=lambda x: (x[0], x[1], x[2] or 0))[2], len(v)) for k, v in groups.items()}
    assert len(got) == rows.count() and all(want[r["text_sha256"]] == (r["keep_id"], r["group_size"]) for r in got)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(want.keys())
    kept = exact_dedup.keep_one(odd, capacity)
    assert kept.columns == odd.columns and kept.count() == len({re.sub(r"[\x20\x09-\x0d]", "", r["text"] or "") for r in odd.collect()})
    assert exact_dedup.deduplicate(empty(spark), capacity).count() == 0


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda t: F.length(t).cast("long") % 5 * F.lit(2**60)])
@pytest.mark.parametrize("hot_bytes", [exact_dedup.HOT_BYTES, 0])
def test_exact_dedup_with_colliding_and_hot_keys(spark, docs, hashed, hot_bytes):
    """Texts that share a key are told apart by their bytes, in the owner and where hot texts are combined."""
    rows = docs.limit(150).unionByName(odd_rows(spark).select(*docs.columns)).cache()
    want = Counter(re.sub("[\x20\x09-\x0d]", "", r["text"] or "") for r in rows.collect())
    sizes = {hashlib.sha256(k.encode()).hexdigest(): n for k, n in want.items()}
    got = exact_dedup.deduplicate(rows, 3, hashed, hot_bytes).collect()
    assert len(got) == sum(want.values()) and all(sizes[r["text_sha256"]] == r["group_size"] for r in got)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(sizes.keys())
    places = {(r["key"], r["chain"]) for r in got}
    chains = Counter(k for k, _ in places)
    assert len(places) == len(sizes) and all((k, n) in places for k, n in chains.items())  # chains are numbered from 1 without gaps
    kept = exact_dedup.keep_one(rows, 3, hashed, hot_bytes)
    assert kept.columns == rows.columns
    assert Counter(re.sub("[\x20\x09-\x0d]", "", r["text"] or "") for r in kept.collect()) == Counter(want.keys())


def test_an_owner_holds_whole_buckets(spark, docs):
    """The files of the index hold runs of buckets: no bucket is in two files, and no key in two buckets."""
    got = exact_dedup.deduplicate(docs.limit(400), 9)
    files = got.select("bucket", F.input_file_name().alias("file")).distinct().groupBy("bucket").count()
    assert files.count() > 8 and files.agg(F.max("count")).first()[0] == 1
    assert got.select("key", "bucket").distinct().groupBy("key").count().agg(F.max("count")).first()[0] == 1


def test_directory_buckets_hold_their_capacity(spark):
    index = spark.range(2000).select(F.xxhash64("id").alias("key"))
    slots, depth = exact_dedup.directory(index, 50)
    assert slots.count() == 2**depth and slots.select("slot").distinct().count() == 2**depth
    placed = index.withColumn("slot", exact_dedup.leading("key", depth)).join(slots, "slot").groupBy("bucket").count()
    assert placed.agg(F.max("count")).first()[0] <= 50 and placed.agg(F.sum("count")).first()[0] == 2000


# ---- 7 sharding

@pytest.mark.parametrize("block_rows", [sharding.BLOCK_ROWS, 2])
def test_shards_are_exact(spark, docs, block_rows):
    rows = docs.unionByName(odd_rows(spark).select(*docs.columns)).withColumn("slot", F.lit("clash"))
    got = sharding.shuffle_to_shards(rows, 7, block_rows=block_rows).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r["doc_id"], r["text"]) for r in rows.collect())
    slots = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(7)}
    assert all(x == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shuffle_to_shards(empty(spark), 7).count() == 0


def test_matrix_follows_the_hypergeometric_law():
    seen = Counter()
    for s in range(3000):
        m = np.array(list(sharding.communication_matrix([3, 2, 1], [2, 2, 2], s)))
        assert (m.sum(axis=1) == [3, 2, 1]).all() and (m.sum(axis=0) == 2).all()
        seen[tuple(m[0])] += 1
    want = {k: 3000 * math.prod(math.comb(2, x) for x in k) / math.comb(6, 3) for k in seen}
    assert len(seen) == 7 and sum((seen[k] - want[k])**2 / want[k] for k in seen) < 22.5  # 0.1 % of chi-square with 6 degrees


def test_large_hypergeometric_draws(monkeypatch):
    """Beyond numpy's range: the law's mean, variance and bounds, and at a small size the same law as numpy's."""
    rng = np.random.default_rng(5)
    for good, bad, sample in ((10**9, 10**9, 1000), (3 * 10**11, 7 * 10**11, 10**6), (2 * 10**12, 10**9, 10**12), (10**9, 10, 10**9 - 5), (40, 10**10, 10**9)):
        n = good + bad
        x = np.array([sharding._draw(rng, good, bad, sample) for _ in range(4000)], float)
        mean, var = sample * good / n, sample * (good / n) * (bad / n) * ((n - sample) / (n - 1))
        assert x.min() >= max(0, sample - bad) and x.max() <= min(good, sample)
        assert abs(x.mean() - mean) < 5 * math.sqrt(var / 4000)
        assert var < 1 or abs(x.var() / var - 1) < 0.15
    few = [sharding._draw(rng, 10**9, 10**9, 5) for _ in range(20_000)]
    assert abs(few.count(0) / 20_000 - 1 / 32) < 0.006
    monkeypatch.setattr(sharding, "LARGE", 0)
    own = Counter(sharding._draw(rng, 300, 500, 100) for _ in range(20_000))
    theirs = Counter(rng.hypergeometric(300, 500, 100, 20_000).tolist())
    assert all(abs(own[k] - theirs[k]) < 5 * math.sqrt(own[k] + theirs[k] + 10) for k in range(101))


# ---- 8 personal data

def test_base_patterns_equal_the_contract():
    mail, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda s: re.sub("[^0-9]", "", s)

    def brute(t):
        out = [("email", *m.span()) for m in mail.finditer(t)]
        out += [("ip", *m.span()) for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in card.finditer(t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
        return out + [("phone", *m.span()) for m in phone.finditer(t) if 9 <= len(digits(m[0])) <= 15]

    rng = np.random.default_rng(2)
    for _ in range(8000):
        t = "".join(rng.choice(list("a@.-+_1 2(09)é@..00"), rng.integers(0, 30)))
        assert pii.base_spans(t) == brute(t)
    assert pii.base_spans("x 4111 1111 1111 1111, a.b@c-d.org +49 (30) 1234-567 x 10.0.0.255 10.0.0.256") == [
        ("email", 23, 34), ("ip", 55, 65), ("card", 2, 21), ("phone", 35, 52)]
    assert pii.base_spans("1" * 50_000 + "a" * 100_000) == []


def test_random_field_on_held_out_rows():
    field = pii.fit_rows(pii.labelled_rows())
    right = wrong = missed = 0
    for text, gold in pii.labelled_rows(150, seed=99):
        base = pii.base_spans(text)
        got = set(pii.added_spans(field, [text], [base])[0]) | {s for s in base}
        right, wrong, missed = right + len(got & set(gold)), wrong + len(got - set(gold)), missed + len(set(gold) - got)
    assert 2 * right / (2 * right + wrong + missed) > 0.9


def test_viterbi_finds_the_best_path():
    field, rng = pii.Crf(), np.random.default_rng(0)
    for table in (field.near, field.left, field.right):
        table += rng.normal(size=table.shape)
    shapes = [rng.integers(1, pii.SHAPES, n) for n in (1, 2, 4)]
    import itertools
    for s, path in zip(shapes, field.viterbi(shapes)):
        e = field.emissions(field.pad([s])[0])[0]
        score = lambda y: field.first[y[0]] + sum(e[t, k] for t, k in enumerate(y)) + sum(field.move[a, b] for a, b in zip(y, y[1:]))
        assert score(path) == pytest.approx(max(map(score, itertools.product(range(len(pii.LABELS)), repeat=len(s)))))


def test_long_runs_of_digits():
    assert pii.base_spans("0" * 5000 + ".1.2.3") == [("ip", 0, 5006)]
    assert pii.base_spans("1" * 5000 + ".1.2.3") == []


def test_personal_data_rows(spark):
    got = pii.personal_data(odd_rows(spark), pii.fit_rows(pii.labelled_rows())).collect()
    assert len(got) == odd_rows(spark).count() and all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in got)
    assert pii.personal_data(empty(spark), pii.fit_rows(pii.labelled_rows())).count() == 0


# ---- 9 SimHash

def test_trie_join_equals_all_pairs():
    rng = np.random.default_rng(1)
    values = list(rng.integers(0, 2**63, 150, dtype=np.uint64))
    for b in values[:40]:
        for _ in range(25):
            v = int(b)
            for k in rng.integers(0, 64, rng.integers(1, 6)):
                v ^= 1 << int(k)
            values.append(np.uint64(v))
    a = np.unique(np.array(values, np.uint64))
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2, 1)))))
    got = [(int(i), int(j)) for x, y in simhash.trie_join(a, a, True, 2) for i, j in zip(x, y)]
    assert len(got) == len(set(got)) and set(got) == want
    cells = [(p, 5) for p in range(32)]
    assert simhash.cell_pairs(cells, 2) == [(i, j) for i in range(32) for j in range(i, 32) if (i ^ j).bit_count() <= 2]


@pytest.mark.parametrize("leaf", [simhash.LEAF, 6])
def test_simhash_components(spark, docs, leaf):
    rows = docs.unionByName(odd_rows(spark).select(*docs.columns))
    got = simhash.near_duplicates(rows, leaf=leaf).toPandas()
    fp = np.array([int(x, 16) for x in got["fingerprint"]], np.uint64)
    ids = got["doc_id"].fillna(10**9).to_numpy(np.int64)
    near, label = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2, ids.copy()
    while not (next_ := np.where(near, label[None, :], 10**9).min(axis=1)).tolist() == label.tolist():
        label = next_
    assert got["component_id"].to_numpy(np.int64).tolist() == label.tolist() and len(got) == rows.count()


def test_fingerprint_equals_its_definition(spark):
    for text in ("One two\tTHREE four five ONE two three", "only two", "é É x Y z", "a"):
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
        shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
        h = [r[0] % 2**64 for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("stage", ["langid", "exact", "simhash", "clean", "shards"])
def test_clashing_columns_keep_their_values(spark, stage):
    odd = odd_rows(spark)
    bench = spark.createDataFrame([(1, "no document holds this passage of a test")], "item_id long, text string")
    out = {"langid": lambda: langid.identify_and_keep(odd), "exact": lambda: exact_dedup.keep_one(odd), "simhash": lambda: simhash.keep_one(odd),
           "clean": lambda: decontaminate.keep_clean(odd, bench), "shards": lambda: sharding.shuffle_to_shards(odd, 3)}[stage]()
    rows = out.collect()
    assert rows and all(r[c] == "clash" for r in rows for c in CLASHES if (stage, c) != ("shards", "shard"))
    assert stage == "shards" or out.columns == odd.columns


def test_simhash_keep_one(spark):
    odd = odd_rows(spark)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [1, 4, 5, 7, 8, 9]  # a null id stays only where its group has no other
    assert simhash.keep_one(empty(spark)).count() == 0
    shared = [(1, "one two three four five"), (1, "quite another text with words"), (None, "no id here at all"), (None, "no id here at all"), (2, "no relation to any"),
              (2, "no relation to any"), (None, "one two three four five")]
    kept = simhash.keep_one(spark.createDataFrame([(*r, None, None, None) for r in shared], DOCS)).collect()
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in kept) == [
        (0, "no id here at all"), (1, "one two three four five"), (1, "quite another text with words"), (2, "no relation to any")]


# ---- 10 language ID

def test_language_paths_are_the_best():
    rng = np.random.default_rng(0)
    for k in range(400):
        sizes, n = rng.integers(0, 30, rng.integers(1, 5)), rng.integers(2, 5)
        edge = np.concatenate([[0], np.cumsum(sizes)])
        s = np.clip(rng.normal(0, 3, (edge[-1], n)), -6, 6).astype(np.float32).astype(float)
        label = langid.label_words(s, edge)
        for a, b in zip(edge[:-1], edge[1:]):
            if a < b:
                now = s[a].copy()
                for t in range(a + 1, b):
                    now = np.maximum(now, now.max() - langid.SWITCH) + s[t]
                own = label[a:b]
                assert s[np.arange(a, b), own].sum() - langid.SWITCH * (own[1:] != own[:-1]).sum() == pytest.approx(now.max())


def test_language_of_held_out_documents(spark, docs):
    model = langid.train(docs)
    found = langid.identify(docs, model).where(langid.held_out(F.col("doc_id"))).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.95
    by = {r["lang"]: r["text"] for r in docs.where("n_chars > 800").collect()}
    mixed = by["de"][:700] + " " + by["fr"][:700]
    lang, _, spans = langid.predict_batch(model, [mixed], spans=True)[0]
    assert [s[0] for s in spans] == ["de", "fr"] and spans[0][1] == 0 and spans[-1][2] == len(mixed) and abs(spans[0][2] - 700) < 40
    odd = {r["text"]: r for r in langid.identify(odd_rows(spark), model).collect()}
    assert all(odd[t]["lang_pred"] == "und" and odd[t]["score"] == 0 for t in (None, "", " \t\n", "12 + 3"))
    assert odd["Same text here"]["lang_pred"] in model.langs
    assert langid.identify(empty(spark), model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(empty(spark))).collect()} == {"und"}


def test_language_scripts_narrow(spark):
    rows = [(i, t, l, None, None) for i, (t, l) in enumerate([("привет мир как дела", "ru"), ("γεια σου κόσμε", "el"), ("hello world and you", "en")] * 12)]
    model = langid.train(spark.createDataFrame(rows, DOCS))
    assert [langid.predict_batch(model, [t])[0][0] for t in ("дом", "κόσμος", "you")] == ["ru", "el", "en"]


def test_stage_drops_texts_without_a_leading_language(spark):
    thai = "ภาษาไทยเป็นภาษาราชการ "
    own = [("hello world and you", "en"), ("bonjour le monde et vous", "fr")] * 12
    other = [(thai * 5, None), (thai * 20 + "hello", None), ("hello world", None)]
    rows = lambda x: spark.createDataFrame([(i, t, l, None, None) for i, (t, l) in enumerate(x)], DOCS)
    model = langid.Model(["aa", "bb"], np.zeros((1 << langid.BUCKET_BITS, 2), np.float32), np.ones((langid.OTHER + 1, 2), bool))
    assert langid.predict_proof(model, ["wort und wort"])[0][1:] == (0.5, [], 0.0)
    kept = Counter(r["text"] for r in langid.identify_and_keep(rows(own + other)).collect())
    assert kept == Counter([t for t, _ in own] + ["hello world"])


# ---- pipeline

def test_pipeline_equals_its_stages(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    model = langid.train(docs)
    left = {d: t for d, t in rows.items() if (p := langid.predict_batch(model, [t])[0])[0] != "und" and p[1] >= 0.3}
    norm = {}
    for d, t in sorted(left.items(), key=lambda x: (-len(x[1]), x[0])):
        norm.setdefault(re.sub("[\x20\x09-\x0d]", "", t), d)
    left = {d: rows[d] for d in norm.values()}
    fp = {d: simhash.fingerprint(t) for d, t in left.items()}
    label = {d: d for d in left}
    changed = True
    while changed:
        changed = False
        for a in left:
            for b in left:
                if (fp[a] ^ fp[b]).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    left = {d: t for d, t in left.items() if label[d] == d}
    block = decontaminate.make_block([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    left = {d: t for d, t in left.items() if not decontaminate.find_leaks(block, [t])[0]}
    library = Tokenizer.from_file(WORD)
    assert set(got) == set(left)
    assert all(got[d]["n_tokens"] == len(library.encode(t, add_special_tokens=False).ids) for d, t in left.items())


def test_archives_are_gzip_members(spark):
    data = warc.record(5, "http://x.org/", b"payload", warc.digest32(b"payload"))
    assert zlib.decompress(data, 31).startswith(b"WARC/1.1\r\nWARC-Type: response")
    assert warc.parse(data)["payload"] == b"payload"


def test_leaks_do_not_depend_on_the_pieces(monkeypatch):
    """Texts searched in small pieces, and places in short runs, give the leaks of one search."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    items = [(i, " ".join(rng.choice(words, 40))) for i in range(12)] + [(99, "yes")]
    texts = [" ".join(rng.choice(words, n)) + (" " + items[n % 12][1][7:160] if n % 3 else "") + " and yes " for n in range(1, 60)] + ["", "yes"]
    block = decontaminate.make_block(items)
    whole = decontaminate.find_leaks(block, texts)
    assert sum(map(len, whole)) > 60
    monkeypatch.setattr(decontaminate, "PIECE", 300)
    monkeypatch.setattr(decontaminate, "PLACES", 17)
    monkeypatch.setattr(decontaminate, "ALIGN", 2)
    assert [x for part in decontaminate.pieces(texts) for x in decontaminate.find_leaks(block, part)] == whole
    assert [t for part in decontaminate.pieces(texts) for t in part] == texts
