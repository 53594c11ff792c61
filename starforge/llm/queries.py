"""Registered queries of the corpus operators, each over its whole table with production parameters, and their SQL.

A query only derives the columns of its contract from its operator's output. Queries without SQL (no byte-pair
merges, shingle hashes, random fields, random draws or archives there) are held against brute force in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm import alignment, bpe, chat, decontaminate, exact_dedup, extraction, langid, licenses, pii, sharding, simhash, spelling, warc
from starforge.llm.common import table

SHARDS = 40
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages with their capture index, then fetch every page through the index."""
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations as tokens, and conversation -1 of control strings; digests read back from the tokens."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(CONTROL_TEXT).alias("text"))
        for i, r in enumerate(("user", "assistant"))])))
    path = tokenizer_path("byte_bpe_50k.json")
    return chat.conversation_digests(chat.read_turns(chat.format_turns(rows.unionByName(extra), path), path))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; digests of ids and decoded texts."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices found in every text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents leak."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row that stays."""
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffle all documents, texts included, into 40 shards whose rows differ by one at most."""
    rows = sharding.shuffle_to_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text; counts and digest of the base patterns' spans, and all spans."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, budget=2)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a model that learns from documents that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all texts, the words one edit away, and the common form of each."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages, by the wrapper of their host."""
    return extraction.extract(table(spark, sf_dir, "pages"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of the tokens of two public tokenizers in every text, and how common the linked id pairs are."""
    return alignment.align_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc, op2_chat, op3_bpe, op4_licenses, op5_decontaminate, op6_exact_dedup, op7_sharding, op8_pii, op9_simhash, op10_langid,
    op11_spelling, op12_extraction, op13_alignment)}

_CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
made AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS body,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') AS head FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM made GROUP BY conv_id"""

_DEDUP_SQL = """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST)"""

ORACLE_SQL: dict[str, str] = {"op2_chat": _CHAT_SQL, "op4_licenses": licenses.scan_sql(), "op6_exact_dedup": _DEDUP_SQL, "op11_spelling": spelling.variants_sql()}
