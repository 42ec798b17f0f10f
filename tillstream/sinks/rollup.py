"""Counts of daily actives per day and hour, kept up to date batch by batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream import schemas
from tillstream.operators.keyed import first_per_key
from tillstream.operators.serving import earlier_opens, hourly_changes
from tillstream.sinks.keyed_table import KeyedTable

# Which open of a device on a day is its first, as in the batch operator.
FIRST = ("ts", "partition", "offset")


@dataclass(frozen=True)
class HourlyActives:
    """Each device's first open of each day in `devices`, and how many there are per hour in `hours`.

    Whatever the order of arrival, the counts are those of all opens seen so far counted at once: a repeat changes
    nothing, an earlier open of a device already counted moves it from one hour to the other. A batch reads and writes
    the buckets of its own days; a report reads the day's one bucket of counts. A repeated batch sees what lies before
    it only, and writes the same again. Hours that lost all their devices stay with 0 and are not read.
    """

    root: str
    buckets: int = 64

    @property
    def devices(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/devices", schemas.FIRST_OPEN, ("dt", "mid"), self.buckets, day="dt")

    @property
    def hours(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/hours", schemas.HOURLY, ("dt", "hr"), 1, day="dt")

    def update(self, opens: DataFrame, batch_id: int) -> None:
        """Count a batch of opens (`dt, mid, hr, ts, partition, offset`), repeats allowed."""
        key = [F.col("dt"), F.col("mid")]
        batch = first_per_key(opens, ["dt", "mid"], FIRST).persist()
        moved = earlier_opens(batch, self.devices.lookup(batch, key, before=batch_id), FIRST).persist()
        try:
            self.devices.upsert(moved, batch_id)
            add_counts(self.hours, hourly_changes(moved), batch_id)
        finally:
            moved.unpersist()
            batch.unpersist()

    def snapshot(self, spark: SparkSession, as_of: int) -> None:
        self.devices.snapshot(spark, as_of)
        self.hours.snapshot(spark, as_of)

    def read(self, spark: SparkSession, dates: Sequence[str] | None = None) -> DataFrame:
        """`dt, hr, n` of these days, or of all."""
        counts = self.hours.read(spark) if dates is None else self.hours.read_days(spark, dates)
        return counts.filter("n > 0")


def add_counts(table: KeyedTable, changes: DataFrame, batch_id: int) -> None:
    """Add `change` to the counts `n` of a table with the same keys, which start at 0."""
    changes = changes.persist()
    try:
        keys = list(table.keys)
        known = table.lookup(changes, [F.col(k) for k in keys], before=batch_id)
        total = (F.coalesce("n", F.lit(0)) + F.col("change")).alias("n")
        table.upsert(changes.join(known, keys, "left").select(*keys, total), batch_id)
    finally:
        changes.unpersist()
