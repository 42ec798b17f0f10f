"""Registered queries of this subpackage, each over its whole table with production settings, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm import byte_bpe
from tillstream.llm.chat_format import format_conversations, probe, read_back
from tillstream.llm.embedding_dedup import link_vectors
from tillstream.llm.language_id import identify
from tillstream.llm.line_dedup import dedup_lines
from tillstream.llm.lm_scoring import score_documents
from tillstream.llm.simhash import simhash_groups
from tillstream.llm.source_mixing import DIMENSIONS, mixed
from tillstream.llm.spelling import spelling_forms
from tillstream.llm.spotsigs import fingerprint_table, likeness, rendered
from tillstream.llm.url_templates import document_labels, judge
from tillstream.llm.whitening import integer_vectors, whitened_rows
from tillstream.llm.window_dedup import remove_repeated_windows

# What both speakers of conversation -1 say: strings that mark turns.
PROBE = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return link_vectors(_table(spark, folder, "embeddings"))


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(_table(spark, folder, "documents"))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = file.read()
    ids = byte_bpe.encode(_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    back = byte_bpe.decode(ids, ranks, public_tokenizers.PATTERN)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    signed = fingerprint_table(_table(spark, folder, "documents"))
    return signed.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        rendered(F.col("signs")).alias("fingerprint"), rendered(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
    )


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_groups(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return judge(pages, document_labels(pages, _table(spark, folder, "labels")))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(_table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = dedup_lines(_table(spark, folder, "documents"))
    return left.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), "text")


def op9_window_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = remove_repeated_windows(_table(spark, folder, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixed(_table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.col("_weight").alias("weight"), F.col("_probability").alias("probability"), F.col("_kept").alias("kept"),
        *[F.col(f"_off_{d}").alias(f"off_{d}") for d in DIMENSIONS],
    )


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    white = whitened_rows(integer_vectors(_table(spark, folder, "embeddings")))
    return white.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_forms(_table(spark, folder, "documents"))


def op13_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(conversations.unionByName(probe(spark, PROBE))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_spotsigs": op4_spotsigs,
    "op5_simhash": op5_simhash,
    "op6_url_templates": op6_url_templates,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_window_dedup": op9_window_dedup,
    "op10_source_mixing": op10_source_mixing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_chat_format": op13_chat_format,
}

# Lines of two or more characters are near if, without one character of the longer (or of each), they are the same. Such
# two have an equal half, cut in the middle of the shorter one.
LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents
), counted AS (SELECT * FROM lines WHERE regexp_matches(line, '[^\\s]')
), distinct_lines AS (SELECT line, length(line) AS n, min((doc_id, no)) AS place FROM counted GROUP BY line
), keys AS (
  SELECT line, place, n, n - j AS short, unnest([left(line, (n - j) // 2), right(line, n - j - (n - j) // 2)]) AS half, unnest([1, 2]) AS side
  FROM distinct_lines, (VALUES (0), (1)) v(j) WHERE n >= 2
), pairs AS (
  SELECT DISTINCT b.line, b.n, a.line AS other, a.n AS m FROM keys a JOIN keys b USING (short, half, side)
  WHERE a.place < b.place AND abs(a.n - b.n) <= 1 AND a.line <> b.line
), near AS (
  SELECT DISTINCT line FROM pairs WHERE len(list_filter(range(greatest(n, m)), lambda k: left(line, k) = left(other, k)
    AND substr(line, k + 1 + (n >= m)::INTEGER) = substr(other, k + 1 + (m >= n)::INTEGER))) > 0
), gone AS (
  SELECT c.doc_id, c.no FROM counted c JOIN distinct_lines d USING (line)
  WHERE (c.doc_id, c.no) > d.place OR c.line IN (SELECT line FROM near)
)
SELECT doc_id, count(l.no) AS n_lines, count(g.no) AS n_removed,
  coalesce(string_agg(l.line, chr(10) ORDER BY l.no) FILTER (WHERE g.no IS NULL), '') AS text
FROM lines l LEFT JOIN gone g USING (doc_id, no) GROUP BY doc_id
"""

EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = vec_id) AS n_links, min(other) AS component_id,
  min(other) = vec_id AS kept
FROM reached GROUP BY vec_id
"""

ORACLE: dict[str, str] = {
    "op1_embedding_dedup": EMBEDDING_SQL,
    "op8_line_dedup": LINE_DEDUP_SQL,
}
