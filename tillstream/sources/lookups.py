"""Lookups in dimension and state stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def lookup_rows(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Run SQL over the given frames (named in braces: `FROM {users}`); one JSON object per row.

    Objects are keyed by column name.
    """
    return spark.sql(sql, **views).select(F.to_json(F.struct("*")).alias("row_json"))


def jdbc_lookup(spark: SparkSession, url: str, sql: str, **options: str) -> DataFrame:
    """The same for an outside store: the store runs the SQL, Spark reads its result."""
    return spark.read.format("jdbc").options(url=url, query=sql, **options).load()


def write_clustered(docs: DataFrame, path: str, id_column: str = "id", files: int | None = None) -> None:
    """Write documents so that one id is in one file: in ranges of ids, sorted, with a Bloom filter of the ids in every
    row group. Statistics of the files and row groups rule out all others, the filter an id that is in none."""
    ranges = [files] if files else []
    dealt = docs.repartitionByRange(*ranges, id_column).sortWithinPartitions(id_column)
    dealt.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{id_column}", "true").parquet(path)


def point_get(docs: DataFrame, doc_id, id_column: str = "id") -> DataFrame:
    """The document with one id. The equality reaches the scan as a pushed filter."""
    return docs.filter(F.col(id_column) == F.lit(doc_id))
