from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.cdc import canal_route, maxwell_route
from tillstream.sinks.topics import start_topic_files

# `start_sink` is what writes the messages: files under `target`, or `start_kafka_topics` with servers as `target`.


def start_cdc_canal(
    records: DataFrame, target: str, checkpoint: str, trigger: dict | None = None, start_sink=start_topic_files
) -> StreamingQuery:
    return start_sink(canal_route(records), target, checkpoint, trigger)


def start_cdc_maxwell(
    records: DataFrame, target: str, checkpoint: str, trigger: dict | None = None, drop_deletes: bool = False,
    start_sink=start_topic_files,
) -> StreamingQuery:
    return start_sink(maxwell_route(records, drop_deletes), target, checkpoint, trigger)
