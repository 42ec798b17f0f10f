"""A corpus from raw documents: languages known, lines and documents deduplicated, sources mixed, tokens encoded.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept. Rows without an id pass the deduplication
stages unchanged; see the operators for nulls, ties and repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm import byte_bpe
from tillstream.llm.language_id import keep_identified
from tillstream.llm.line_dedup import dedup_lines
from tillstream.llm.simhash import keep_one
from tillstream.llm.source_mixing import sample
from tillstream.llm.tables import stored


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters or far from every language go."""
    return keep_identified(docs)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier; `n_chars` follows the text."""
    left = dedup_lines(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else left


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of texts whose fingerprints, of three-word shingles, link at three or fewer bits."""
    return keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens by source, language and topic are flattened."""
    return sample(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, n_tokens, ids, text`: token ids, and the text that they decode to. The ids are written between, so that
    no task holds an encoder and a decoder at once."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = file.read()
    ids = stored(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN), "ids")
    back = byte_bpe.decode(ids, ranks, public_tokenizers.PATTERN)
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_languages),
    ("line_dedup", distinct_lines),
    ("simhash_dedup", distinct_documents),
    ("source_mixing", mixed_sources),
    ("byte_bpe", encoded),
]

# Centroids and a tokenizer are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
