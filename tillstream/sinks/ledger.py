"""Offsets saved while a stream runs."""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tillstream import schemas
from tillstream.operators.offsets import observed_ranges, progress_ranges
from tillstream.sinks.keyed_table import KeyedTable


def offset_ledger(root: str) -> KeyedTable:
    """The ledger `topic, group, partition, until_offset` of one stream: some bytes per partition, in one bucket."""
    return KeyedTable(root, schemas.LEDGER, ("topic", "group", "partition"), 1)


class SavesOffsets(StreamingQueryListener):
    """Saves the ends of a query's offset ranges at every progress report, that is after the batch's output.

    Reports come after the commit. A driver that dies between the two leaves the ledger a batch behind, never ahead;
    the next batch with rows of a partition sets it right. With `topic`, ranges are those of `observed_offsets`, else
    the source's own. A batch reported twice is saved once. An error ends the saving, not the query; `error` has it.

    Register it with `spark.streams.addListener` before the query starts; it minds the query with its `query_name`.
    """

    def __init__(
        self, spark: SparkSession, ledger: KeyedTable, group: str, query_name: str, topic: str | None = None,
        metric: str = "offsets", snapshot_every: int = 200,
    ):
        self.spark, self.ledger, self.group, self.query_name = spark, ledger, group, query_name
        self.topic, self.metric, self.snapshot_every = topic, metric, snapshot_every
        self.error: Exception | None = None
        self.run_id: str | None = None
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.query_name:
            self.run_id = str(event.runId)
            self.ended.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) != self.run_id or self.error:
            return
        try:
            if self.topic is None:
                sources = [{"startOffset": s.startOffset, "endOffset": s.endOffset} for s in progress.sources]
                self.save(progress_ranges(self.spark, {"sources": sources}), progress.batchId)
            elif (observed := progress.observedMetrics.get(self.metric)) is not None:
                self.save_observed(observed.asDict(), progress.batchId)
        except Exception as error:  # raised here it would only be logged
            self.error = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.ended.set()

    def save_observed(self, observed: Mapping, batch_id: int) -> None:
        if observed["other"]:
            raise ValueError(f"{observed['other']} rows are of no known partition of {self.topic}")
        ranges = observed_ranges(self.spark, observed, self.topic)
        if not ranges.isEmpty():
            self.save(ranges, batch_id)

    def save(self, ranges: DataFrame, batch_id: int) -> None:
        ends = ranges.select("topic", F.lit(self.group).alias("group"), "partition", "until_offset")
        if batch_id and batch_id % self.snapshot_every == 0:
            self.ledger.snapshot(self.spark, as_of=batch_id - 1)
        self.ledger.upsert(ends, batch_id)

    def wait(self, seconds: float = 60) -> None:
        """Until the reports of the query, which has ended, are all saved."""
        if not self.ended.wait(seconds):
            raise TimeoutError(f"no end of {self.query_name} was reported")
        if self.error:
            raise self.error
