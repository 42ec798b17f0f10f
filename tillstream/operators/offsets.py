"""Offset ranges and the ledger of offsets read per topic and consumer group.

Streams resume from their checkpoints; the ledger serves replays in batch and starting a new
stream where another consumer stopped.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.operators.joins import MAX_BROADCAST_ROWS
from tillstream.operators.keyed import overlay


def offsets_range(records: DataFrame) -> DataFrame:
    """`[from_offset, until_offset)` per topic and partition."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def progress_ranges(spark: SparkSession, progress: Mapping) -> DataFrame:
    """The same of one batch of a running broker stream, from its progress report.

    The report holds an entry per partition, so nothing is read again to find them. A stream's
    first report does not say where it began: `from_offset` is null there.
    """
    ranges = []
    for source in progress["sources"]:
        start, end = (json.loads(source[side] or "{}") for side in ("startOffset", "endOffset"))
        for topic, partitions in end.items():
            for partition, until in partitions.items():
                begin = start.get(topic, {}).get(partition, 0) if start else None
                ranges.append((topic, int(partition), begin, until))
    return spark.createDataFrame(ranges, "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT")


def offsets_save(ledger: DataFrame, ranges: DataFrame, group: str) -> DataFrame:
    """The ledger with the ranges' ends set for the group; other entries stay."""
    ends = ranges.select("topic", F.lit(group).alias("group"), "partition", "until_offset")
    return overlay(ledger, ends, ["topic", "group", "partition"])


def offsets_read(ledger: DataFrame, topic: str, group: str) -> DataFrame:
    """Saved `partition, until_offset` of a topic and group."""
    mine = (F.col("topic") == topic) & (F.col("group") == group)
    return ledger.filter(mine).select("partition", "until_offset")


def offsets_map(ledger: DataFrame, topic: str, group: str) -> dict[int, int]:
    """The same as reader argument; a row per partition of one topic."""
    return {row["partition"]: row["until_offset"] for row in offsets_read(ledger, topic, group).collect()}


def resume(records: DataFrame, saved: DataFrame, starting: str = "latest") -> DataFrame:
    """Records of one topic not yet read, for a replay in batch.

    A partition with a saved offset goes on from it. With no offset saved at all, `earliest`
    reads everything and `latest` nothing. A partition new since the save is read from its start.
    """
    known = saved.select("partition", F.col("until_offset").alias("_from"))
    partitions = known.count()
    if partitions == 0:
        return records if starting == "earliest" else records.limit(0)
    if partitions <= MAX_BROADCAST_ROWS:
        known = F.broadcast(known)
    joined = records.join(known, "partition", "left")
    return joined.filter(F.col("offset") >= F.coalesce("_from", F.lit(0))).drop("_from").select(*records.columns)


def observed_offsets(records: DataFrame, topic: str, partitions: Iterable[int], name: str = "offsets") -> DataFrame:
    """The same stream, with the range of offsets of each partition reported in every batch as metric `name`.

    It is for sources whose own progress is not in offsets of the topic, such as files. One number each way for each of
    the topic's partitions, taken on the way; rows of other partitions or topics are counted as `other`.
    """
    known = sorted(set(partitions))
    here = F.coalesce((F.col("topic") == topic) & F.col("partition").isin(known), F.lit(False))
    ends = [
        end(F.when(here & (F.col("partition") == p), F.col("offset"))).alias(f"{label}_{p}")
        for p in known for label, end in (("first", F.min), ("last", F.max))
    ]
    return records.observe(name, F.count_if(~here).alias("other"), *ends)


def observed_ranges(spark: SparkSession, observed: Mapping, topic: str) -> DataFrame:
    """Ranges of one batch from that metric; partitions without rows are absent."""
    ranges = [
        (topic, int(label.removeprefix("first_")), first, observed[f"last_{label.removeprefix('first_')}"] + 1)
        for label, first in observed.items() if label.startswith("first_") and first is not None
    ]
    return spark.createDataFrame(ranges, "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT")
