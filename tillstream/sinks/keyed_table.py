"""A table upserted by key from a stream, kept as Parquet folders and hashed into buckets by key.

`changes/batch_id=<n>/bucket=<b>` holds the rows batch n upserted, one per key; `snapshots/batch_id=<n>/bucket=<b>` a whole
bucket as of batch n. A snapshot writes only the buckets that have changed since the one before; of each bucket the
newest counts. A repeated batch rewrites its own folder and reads only what lies before it, so repeating it changes
nothing. A table belongs to one stream and its checkpoint, whose batch ids it is ordered by; rows from before the
stream go in as batch -1. A table keeps the number of buckets that it was begun with.

With a `day`, one of the keys, every day has buckets of its own: rows of a batch are looked up among those of their days
only, and buckets of days gone by are not written again.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream import fs
from tillstream.operators.joins import in_list_lookup
from tillstream.operators.keyed import latest_per_key, overlay


@dataclass(frozen=True)
class KeyedTable:
    root: str
    schema: str
    keys: tuple[str, ...]
    buckets: int = 64
    day: str | None = None

    @property
    def _changes(self) -> str:
        return f"{self.root}/changes"

    @property
    def _snapshots(self) -> str:
        return f"{self.root}/snapshots"

    def _columns(self, spark: SparkSession) -> list[str]:
        return spark.createDataFrame([], self.schema).columns

    def bucket(self, *keys: Column) -> Column:
        """Bucket of a key, of the table's key columns by default. Keys are hashed as text, so that they may come in
        another type."""
        columns = keys or tuple(F.col(k) for k in self.keys)
        hashed = F.pmod(F.xxhash64(*[c.cast("string") for c in columns]), F.lit(self.buckets)).cast("int")
        if self.day is None:
            return hashed
        return F.unix_date(F.to_date(columns[self.keys.index(self.day)])) * F.lit(self.buckets) + hashed

    def read_days(self, spark: SparkSession, dates: Sequence[str], before: int | None = None) -> DataFrame:
        """The rows of these days. Only their buckets are read."""
        firsts = [(datetime.date.fromisoformat(d) - datetime.date(1970, 1, 1)).days * self.buckets for d in dates]
        return self.read(spark, before, [first + i for first in firsts for i in range(self.buckets)])

    def buckets_of(self, rows: DataFrame, *keys: Column) -> list[int]:
        """The buckets that rows fall into: at most as many numbers as the table has buckets."""
        return sorted(r["b"] for r in rows.select(self.bucket(*keys).alias("b")).distinct().collect())

    def read(self, spark: SparkSession, before: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Latest row per key, of batches before the given one, of the given buckets or of all. Other buckets' files are
        not listed."""
        def usable(batch: int) -> bool:
            return before is None or batch < before

        wanted = None if buckets is None else list(buckets)
        snapshots = [b for b in fs.complete_batches(spark, self._snapshots) if usable(b)]
        later = [b for b in fs.complete_batches(spark, self._changes) if usable(b) and (not snapshots or b > snapshots[-1])]
        newest = {bucket: batch for batch in snapshots for bucket in self._written(spark, self._snapshots, batch)}
        base = self._load(spark, self._snapshots, sorted((batch, bucket) for bucket, batch in newest.items()), wanted)
        places = [(batch, bucket) for batch in later for bucket in self._written(spark, self._changes, batch)]
        changes = self._load(spark, self._changes, places, wanted)
        if changes is not None:
            changes = latest_per_key(changes, self.keys, ["batch_id"]) if len(later) > 1 else changes
            changes = changes.drop("batch_id")
        if base is None or changes is None:
            found = base if changes is None else changes
            return spark.createDataFrame([], self.schema) if found is None else found.select(*self._columns(spark))
        return overlay(base.drop("batch_id"), changes, ["bucket", *self.keys]).select(*self._columns(spark))

    def _written(self, spark: SparkSession, root: str, batch: int) -> list[int]:
        return fs.numbered(spark, f"{root}/batch_id={batch}", "bucket")

    def _load(self, spark: SparkSession, root: str, places: list[tuple[int, int]], wanted: list[int] | None) -> DataFrame | None:
        kept = [(batch, bucket) for batch, bucket in places if wanted is None or bucket in wanted]
        if not kept:
            return None
        reader = spark.read.schema(f"{self.schema}, batch_id BIGINT, bucket INT").option("basePath", root)
        rows = reader.parquet(*[f"{root}/batch_id={batch}/bucket={bucket}" for batch, bucket in kept])
        return rows if wanted is None else rows.filter(F.col("bucket").isin(wanted))

    def lookup(self, rows: DataFrame, keys: Sequence[Column], before: int | None = None) -> DataFrame:
        """The table's rows whose key occurs in `rows`, where `keys` are its columns.

        Two steps: only the buckets of those keys are read, and of them what a Bloom filter of the keys lets pass is
        joined exactly.
        """
        wanted = rows.select(*[k.cast("string").alias(name) for k, name in zip(keys, self.keys)]).distinct()
        found = self.read(rows.sparkSession, before, self.buckets_of(wanted))
        if len(self.keys) == 1:
            return in_list_lookup(found, wanted, self.keys[0], self.keys[0])
        return found.join(wanted, list(self.keys), "left_semi")

    def _write(self, rows: DataFrame, root: str, batch_id: int) -> None:
        """To `root/batch_id=<n>/bucket=<b>/`, replacing the batch's folder."""
        bucketed = rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/batch_id={batch_id}")

    def upsert(self, rows: DataFrame, batch_id: int, versions: Sequence[str] = ()) -> None:
        """Upsert a batch. Of several rows of a key the last by `versions` wins; without `versions`
        rows must be unique by key."""
        latest = latest_per_key(rows, self.keys, versions) if versions else rows
        self._write(latest.select(*self._columns(rows.sparkSession)), self._changes, batch_id)

    def snapshot(self, spark: SparkSession, as_of: int, keep: int = 2) -> None:
        """Fold the changes up to a batch into their buckets; later reads start from there. Other buckets stay as they are.

        The newest `keep` snapshots stay, with all changes since the oldest of them, so readers and
        a repeated batch still find what they need. What newer ones replace goes.
        """
        done = fs.complete_batches(spark, self._snapshots)
        if as_of not in done:
            last = max((b for b in done if b < as_of), default=None)
            changed = [b for b in fs.complete_batches(spark, self._changes) if b <= as_of and (last is None or b > last)]
            touched = sorted({bucket for batch in changed for bucket in self._written(spark, self._changes, batch)})
            self._write(self.read(spark, before=as_of + 1, buckets=touched), self._snapshots, as_of)
        done = fs.complete_batches(spark, self._snapshots)
        oldest = done[-keep:][0]
        replaced: set[int] = set()
        for batch in sorted((b for b in done if b <= oldest), reverse=True):
            here = self._written(spark, self._snapshots, batch)
            gone = [bucket for bucket in here if bucket in replaced]
            for bucket in gone:
                fs.delete_dir(spark, f"{self._snapshots}/batch_id={batch}/bucket={bucket}")
            if batch != oldest and len(gone) == len(here):
                fs.delete_dir(spark, f"{self._snapshots}/batch_id={batch}")
            replaced.update(here)
        for batch in fs.complete_batches(spark, self._changes):
            if batch <= oldest:
                fs.delete_dir(spark, f"{self._changes}/batch_id={batch}")
