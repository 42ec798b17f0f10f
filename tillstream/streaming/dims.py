from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.dims import enrich_users, parse_provinces, parse_users
from tillstream.operators.records import accepted, rejected, text_of_rejects_only
from tillstream.sinks.batches import write_rejects
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sinks.topics import EVERY_5_SECONDS

# Of several rows of one key in a batch, the one that arrived last.
ARRIVAL = ["timestamp", "partition", "offset"]


def _start(records, parse, enrich, table, rejects_path, checkpoint, snapshot_every, trigger) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = text_of_rejects_only(parse(batch)).persist()
        try:
            if batch_id and batch_id % snapshot_every == 0:
                table.snapshot(batch.sparkSession, as_of=batch_id - 1)
            table.upsert(enrich(accepted(parsed)), batch_id, versions=ARRIVAL)
            write_rejects(rejected(parsed), rejects_path, batch_id)
        finally:
            parsed.unpersist()

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_5_SECONDS))
        .start()
    )


def start_dim_province(
    records: DataFrame, table: KeyedTable, rejects_path: str, checkpoint: str,
    snapshot_every: int = 200, trigger: dict | None = None,
) -> StreamingQuery:
    return _start(records, parse_provinces, lambda df: df, table, rejects_path, checkpoint, snapshot_every, trigger)


def start_dim_user(
    records: DataFrame, table: KeyedTable, rejects_path: str, checkpoint: str,
    as_of: Column | None = None, snapshot_every: int = 200, trigger: dict | None = None,
) -> StreamingQuery:
    """Ages are as of `as_of`, by default the time of the batch."""
    return _start(
        records, parse_users, lambda df: enrich_users(df, as_of), table, rejects_path, checkpoint, snapshot_every, trigger
    )
