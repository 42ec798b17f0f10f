from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.logs import route_app_log
from tillstream.sinks.batches import landing_lines
from tillstream.sinks.topics import EVERY_5_SECONDS, start_topic_files


def start_log_landing(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append every raw log line to text files, a folder per day of arrival."""
    return (
        landing_lines(records).writeStream.format("text")
        .partitionBy("dt")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_5_SECONDS))
        .start()
    )


def start_log_split(
    records: DataFrame, target: str, checkpoint: str, trigger: dict | None = None, start_sink=start_topic_files
) -> StreamingQuery:
    """Split app logs to the start, event and rejects topics: files under `target`, or, with `start_kafka_topics` as
    `start_sink`, the broker whose servers `target` names."""
    return start_sink(route_app_log(records), target, checkpoint, trigger)
