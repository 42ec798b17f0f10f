"""Search over keyed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions.text import any_token_pattern
from tillstream.operators.records import CARRIED, one_object, parse_once

_DOCUMENT_JSON = (
    "id STRING, name STRING, doubanScore STRING, actorList ARRAY<STRUCT<id: STRING, name: STRING>>, _corrupt_record STRING"
)


def parse_documents(records: DataFrame) -> DataFrame:
    """Document JSON -> `id, name, doubanScore, actorList`, the carried record columns and `reason`."""
    def actor(a):
        return F.struct(a["id"].try_cast("bigint").alias("id"), a["name"].alias("name"))

    parsed = parse_once(records.select(*CARRIED), one_object(F.col("value"), _DOCUMENT_JSON), "_j")
    bad = F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull()
    return parsed.select(
        *CARRIED,
        F.col("_j.id").try_cast("bigint").alias("id"),
        F.col("_j.name").alias("name"),
        F.col("_j.doubanScore").try_cast("float").alias("doubanScore"),
        F.transform("_j.actorList", actor).alias("actorList"),
        F.when(bad, "bad_json").when(F.col("_j.id").try_cast("bigint").isNull(), "missing:id").alias("reason"),
    )


def doc_match(docs: DataFrame, query: str, column: str = "name") -> DataFrame:
    """Documents with any word of the query in a text column."""
    return docs.filter(F.regexp_like(F.col(column), any_token_pattern(query)))


def doc_term_nested(docs: DataFrame, value: str, column: str = "actorList", field: str = "name") -> DataFrame:
    """Documents with an array element whose field is exactly the value."""
    return docs.filter(F.exists(F.col(column), lambda element: element[field] == value))


def doc_top_n(docs: DataFrame, size: int = 10, start: int = 0, score: str = "doubanScore", key: str = "id") -> DataFrame:
    """A page of documents by falling score, then key; every task keeps only `start + size` rows."""
    return docs.orderBy(F.col(score).desc_nulls_last(), key).offset(start).limit(size)


def doc_highlight(docs: DataFrame, query: str, column: str = "name") -> DataFrame:
    """Adds `highlight`: the text with each query word in `<em>` tags."""
    marked = F.regexp_replace(F.col(column), any_token_pattern(query), F.lit("<em>$1</em>"))
    return docs.withColumn("highlight", F.coalesce(marked, F.col(column)))


def search(docs: DataFrame, query: str, term: str, size: int = 10, start: int = 0) -> DataFrame:
    """Match on the name, exact nested term, page by score, highlight."""
    hits = doc_term_nested(doc_match(docs, query), term)
    return doc_highlight(doc_top_n(hits, size, start), query)
