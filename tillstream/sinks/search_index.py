"""An inverted index of documents: postings of words, hashed into buckets by word.

`batch_id=<n>/bucket=<b>` holds a row for each word of each document that batch n brought. Postings are only added: one of
a text that has changed since is stale, and the search, which checks every document that it finds on its text, drops it.
A repeated batch replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream import fs
from tillstream.functions.text import folded_tokens
from tillstream.operators.docs import doc_match
from tillstream.operators.joins import checked_semi_join


@dataclass(frozen=True)
class SearchIndex:
    root: str
    key: str = "id"
    column: str = "name"
    buckets: int = 64

    def _bucket(self, word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(self.buckets)).cast("int")

    def add(self, docs: DataFrame, batch_id: int) -> None:
        """Post the words of new and changed documents."""
        words = docs.select(F.col(self.key).cast("string").alias("doc"), F.explode(folded_tokens(F.col(self.column))).alias("word"))
        rows = words.withColumn("bucket", self._bucket(F.col("word"))).hint("rebalance", "bucket")
        rows.sortWithinPartitions("bucket", "word").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/batch_id={batch_id}")

    def postings(self, spark: SparkSession, words: Iterable[str]) -> DataFrame:
        """`doc, word` of the given words. Only their buckets are read, and of these the row groups that hold them."""
        wanted = sorted(set(words))
        batches = fs.complete_batches(spark, self.root)
        schema = "doc STRING, word STRING, batch_id BIGINT, bucket INT"
        if not wanted or not batches:
            return spark.createDataFrame([], schema).select("doc", "word")
        rows = spark.read.schema(schema).option("basePath", self.root).parquet(*[f"{self.root}/batch_id={b}" for b in batches])
        numbers = spark.range(1).select(F.array(*[self._bucket(F.lit(w)) for w in wanted]).alias("b")).first()["b"]
        return rows.filter(F.col("bucket").isin(sorted(set(numbers))) & F.col("word").isin(wanted)).select("doc", "word")

    def match(self, docs: DataFrame, query: str) -> DataFrame:
        """What `doc_match` finds in the documents that were added, in their present state, by the postings of the query's
        words: texts are read of the documents posted under one of them, and checked."""
        spark = docs.sparkSession
        words = spark.range(1).select(folded_tokens(F.lit(query)).alias("w")).first()["w"]
        found = self.postings(spark, words).select(F.col("doc").alias("_doc")).distinct()
        return doc_match(checked_semi_join(docs, found, F.col(self.key).cast("string"), "_doc"), query, self.column)
