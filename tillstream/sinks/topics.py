"""Writing messages to the topic named in each row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

EVERY_5_SECONDS = {"processingTime": "5 seconds"}


def kafka_write_options(servers: str, checkpoint: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.enable.idempotence": "true",
        "checkpointLocation": checkpoint,
    }


def start_kafka_topics(
    messages: DataFrame, servers: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Stream `topic, key, value` to the broker; a null key sends unkeyed. Needs the Kafka package."""
    writer = messages.select("topic", "key", "value").writeStream.format("kafka")
    return writer.options(**kafka_write_options(servers, checkpoint)).trigger(**(trigger or EVERY_5_SECONDS)).start()


def start_topic_files(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """The same to Parquet files, a folder per topic, each row written exactly once."""
    writer = messages.writeStream.format("parquet").partitionBy("topic")
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_5_SECONDS))
        .start()
    )
