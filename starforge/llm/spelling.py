"""Spelling variants: words one edit apart, found by pairs of trie nodes, and the common form of each.

The words of the corpus make two tries, one read forward and one read backward, whose nodes are numbered. A word cut
at a place is then a pair of integers (node of what stands before, node of what stands after), and so is a word with
one letter skipped. Two words of equal length that differ in one letter share the pair of that skipped letter, and a
word with a letter too many has, skipping it, the pair of the other word's cut. One grouping by pairs finds all of
them exactly, without comparing words and without a string leaving its row.

Sizes: a pair's group holds the words that agree but for one letter, so at most one per letter of the alphabet (90)
and one cut word; no group is hot, however often a word occurs. The number of rows is the number of letters of the
distinct words, not of the texts. A trie is numbered in ranges of sorted words: a task numbers its range, and the
ranges are fitted together by their first and last words (one row a range of ``RANGE_WORDS`` words on the driver).

Defined results: null and empty texts have no words, nor has a table without rows; a null ``doc_id`` counts as the
empty string in the hash that deletes letters; equal rows count each. Missing columns are null, all others are
ignored, whatever their names. A very long run of letters is one word: it costs a few integers a letter.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import keep_named, ready, stored

#: Words of one range of the sorted dictionary, numbered by one task.
RANGE_WORDS = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, least_points: int, least_count: int, slip: int) -> DataFrame:
    """(word, n): lower-cased runs of letters, one letter deleted where ``slip`` divides the hash of document and run."""
    d = keep_named(docs, {"doc_id": "string", "text": "string"})
    low = F.translate("text", UPPER, LOWER)
    runs = d.select(F.coalesce("doc_id", F.lit("")).alias("doc"), F.explode(
        F.regexp_extract_all(low, F.lit(f"([a-zÀ-ÿ]{{{least_points},}})"))).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = F.col("h") % F.length("run")
    cut = F.concat(F.expr("substring(run, 1, int(at))"), F.expr("substring(run, int(at) + 2)"))
    words = runs.withColumn("h", h).withColumn("at", at).select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_points).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Letters that two words have in common at their start."""
    top = min(len(a), len(b))
    return next((k for k in range(top) if a[k] != b[k]), top)


def _number_range(rows: pd.DataFrame) -> pd.DataFrame:
    """Number the nodes of one sorted range as if no other existed; the first word's nodes are 0, 1, 2, ..."""
    rows = rows.sort_values("key", ignore_index=True)
    nodes, path, made, before = [], [], 0, ""
    for key in rows["key"]:
        k = _shared(before, key)
        path = path[:k] + list(range(made, made + len(key) - k))
        made, before = made + len(key) - k, key
        nodes.append(path)
    out = rows[["part", "word", "key", "n"]].copy()
    out["place"], out["nodes"], out["made"] = range(len(rows)), nodes, made
    return out


def trie_nodes(words: DataFrame, key: Column, name: str, range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, n, rank, nodes): nodes[d] numbers the trie node of the first d letters of ``key`` (0 is the root);
    rank ascends in the code-point order of ``key``. ``words`` must be a stored table of distinct words."""
    ready(words.sparkSession)
    ranges = -(-max(1, words.count()) // range_words)
    dealt = stored(words.select("word", "n", key.alias("key")).repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id()), f"{name}-range")
    local = stored(dealt.groupBy("part").applyInPandas(
        _number_range, "part int, word string, key string, n long, place long, nodes array<long>, made long"), f"{name}-local")
    ends = local.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("nodes", "key").alias("nodes"),
                                     F.max("made").alias("made")).orderBy("part").collect()  # one row a range
    base, before, path, fits = 1, "", [], []
    for e in ends:
        known = path[:_shared(before, e["first"])]  # nodes that an earlier range has made
        fits.append((e["part"], known, base))
        path = [known[k] if k < len(known) else base + k - len(known) for k in e["nodes"]]
        base, before = base + e["made"] - len(known), e["last"]
    fit = words.sparkSession.createDataFrame(fits, "part int, known array<long>, base long")
    return local.join(fit, "part").select("word", "n", (F.col("part").cast("long") * F.lit(1 << 32) + F.col("place")).alias("rank"), F.expr(
        "concat(array(0L), transform(nodes, k -> if(k < size(known), known[int(k)], base + k - size(known))))").alias("nodes"))


def near_words(words: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, n, rank, n_near, best): per word how many words are one edit away, and the most frequent of them as
    (n, -rank). ``words`` is a stored table (word, n) of distinct words."""
    ahead = trie_nodes(words, F.col("word"), "trie", range_words)
    back = trie_nodes(words, F.reverse("word"), "reversed", range_words).select("word", F.col("nodes").alias("after"))
    both = stored(ahead.join(back, "word"), "tries")
    # Skipping any letter of a run of equal letters gives the same word: for insertions the run's first one counts.
    cuts = both.select("rank", "n", "nodes", "after", F.size("nodes").alias("m"), F.split("word", "").alias("letter")).select("rank", "n", F.expr("""
        inline(concat(
          transform(sequence(0, m - 1), i -> struct(nodes[i] AS p, after[m - 1 - i] AS s, false AS skip, false AS lead)),
          transform(sequence(0, m - 2), i -> struct(nodes[i] AS p, after[m - 2 - i] AS s, true AS skip,
                                                   if(i = 0, true, letter[i] != letter[i - 1]) AS lead))))"""))
    groups = cuts.groupBy("p", "s").agg(F.collect_list(F.struct("rank", "n", "skip", "lead")).alias("g")).where("size(g) > 1")
    others = "filter(g, y -> if(x.skip, if(y.skip, y.rank != x.rank, x.lead), y.skip AND y.lead))"
    seen = groups.select(F.expr(f"""inline(transform(g, x -> struct(x.rank AS rank, size({others}) AS found,
        array_max(transform({others}, y -> struct(y.n AS n, -y.rank AS back))) AS best)))"""))
    near = seen.groupBy("rank").agg(F.sum("found").alias("n_near"), F.max("best").alias("best"))
    return both.select("word", "n", "rank").join(near, "rank", "left")


def last_forms(links: DataFrame) -> DataFrame:
    """(rank, root): follow (rank, to) to the end by doubling the step. A link multiplies n, so chains are short."""
    step = stored(links, "forms")
    while True:
        there = step.select(F.col("rank").alias("to"), F.col("to").alias("further"))
        step = stored(step.join(there, "to", "left").select("rank", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "forms")
        if not step.where("moved").limit(1).count():
            return step.select("rank", F.col("to").alias("root"))
        step = step.drop("moved")


def variants(docs: DataFrame, least_points: int = 6, least_count: int = 5, ratio: int = 5, slip: int = 199, range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word with ``least_points`` letters and ``least_count`` occurrences.

    Words are near if one inserted, deleted or replaced letter turns one into the other. ``form`` is the near word
    with the largest n (ties: the first in code-point order) where that is ``ratio`` times the word's, else null;
    ``root`` follows forms to the last; ``slip`` is the divisor of the hash that deletes a letter of a run.
    """
    words = stored(word_counts(docs, least_points, least_count, slip), "words")
    near = stored(near_words(words, range_words), "near")
    formed = near.withColumn("to", F.expr(f"if(best.n >= {ratio} * n, -best.back, null)"))
    roots = last_forms(formed.where("`to` IS NOT NULL").select("rank", "to"))
    named = near.select(F.col("rank").alias("to"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    last = near.select(F.col("rank").alias("root_rank"), F.col("word").alias("root"))
    out = formed.join(roots.withColumnRenamed("root", "root_rank"), "rank", "left").join(named, "to", "left").join(last, "root_rank", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def variants_sql(least_points: int = 6, least_count: int = 5, ratio: int = 5, slip: int = 199) -> str:
    """DuckDB SQL of ``variants`` over ``documents``: CRC-32 from its polynomial, words joined on their texts less one letter."""
    return f"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents),
per AS (
  SELECT run, hex(encode(doc || ':' || run)) AS x, count(*) AS m FROM runs WHERE length(run) >= {least_points} GROUP BY doc, run),
hashed AS (
  SELECT run, m, xor(list_reduce(
    list_prepend(4294967295::BIGINT, [('0x' || substr(x, (2 * j + 1)::INT, 2))::BIGINT for j in range(length(x) // 2)]),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM per, crc),
slipped AS (
  SELECT CASE WHEN h % {slip} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, m FROM hashed),
words AS (
  SELECT word, sum(m)::BIGINT AS n FROM slipped WHERE length(word) >= {least_points} GROUP BY word HAVING sum(m) >= {least_count}),
less AS (
  SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.rest FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT a.rest, a.word FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT near.word, count(*) AS n_near, first(near.other ORDER BY o.n DESC, o.word) AS other, max(o.n) AS other_n
  FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
formed AS (
  SELECT w.word, CASE WHEN other_n >= {ratio} * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= {ratio} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
walk(word, here, k) AS (
  SELECT word, word, 0 FROM formed UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN formed f ON f.word = walk.here WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, max_by(here, k) AS root FROM walk GROUP BY word) r USING (word)"""
