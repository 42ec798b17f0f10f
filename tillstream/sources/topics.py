"""Message topics: the broker itself, and files with the same columns."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream import fs
from tillstream.schemas import TOPIC


def kafka_read_options(
    servers: str,
    topic: str,
    group_id: str | None = None,
    offsets: Mapping[int, int] | None = None,
    partitions: Iterable[int] = (),
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options: default group, named group, or named group from given offsets.

    `offsets` maps partition to the next offset to read; without it reading starts at
    `starting` (`latest` or `earliest`). The broker source wants a start for every partition, so give the topic's
    `partitions`: those without a saved offset, new ones for instance, start at `starting`. A stream with a checkpoint
    goes on from there anyway.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if offsets:
        starts = {p: {"earliest": -2, "latest": -1}[starting] for p in partitions} | dict(offsets)
        options["startingOffsets"] = json.dumps({topic: {str(p): o for p, o in sorted(starts.items())}})
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_topic(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Stream of a broker topic, text key and value. Needs Spark's Kafka package on the class path."""
    options = kafka_read_options(servers, topic, **kwargs)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def file_topic(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of a topic kept as Parquet files, e.g. one written by `sinks.topics.start_topic_files`."""
    reader = spark.readStream.schema(TOPIC)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream of `<folder>/<name>.parquet`, be it one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if fs.is_dir(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
