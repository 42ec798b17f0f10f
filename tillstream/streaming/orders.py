from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.orders import parse_orders, status_of_first_orders
from tillstream.operators.records import accepted, rejected, text_of_rejects_only
from tillstream.plans.order_wide import order_wide
from tillstream.schemas import ORDER_WIDE_COLUMNS
from tillstream.sinks.batches import counted, preview_orders, write_batch, write_rejects
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sinks.topics import EVERY_5_SECONDS

# Tells apart even repeated copies of one order.
ROW_KEY = ("id", "partition", "offset")


def users_of(table: KeyedTable) -> Callable[[SparkSession, DataFrame], DataFrame]:
    """The users of a batch's orders from the user dimension: only their buckets are read."""
    return lambda spark, orders: table.lookup(orders, [F.col("user_id")])


def start_order_wide(
    records: DataFrame,
    wide_path: str,
    rejects_path: str,
    status: KeyedTable,
    provinces: Callable[[SparkSession], DataFrame],
    users: Callable[[SparkSession, DataFrame], DataFrame],
    checkpoint: str,
    snapshot_every: int = 200,
    show_rows: int = 0,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Maintain the wide order table and the user status table.

    Dimensions are opened anew for every batch; `users` also gets the batch's orders, so that it may look up their users
    only (`users_of`). Of the status table a batch reads the buckets of its users, and sees only the status of earlier
    batches, so running it again gives the same flags. A batch spans few days
    as a rule, so the statistics in its files prune by date; a folder per day would make a replay write thousands. `show_rows` prints the earliest that many rows of every batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id and batch_id % snapshot_every == 0:
            status.snapshot(spark, as_of=batch_id - 1)
        parsed = batch.persist()
        try:
            orders = accepted(parsed)
            known = status.lookup(orders, [F.col("user_id")], before=batch_id).persist()
            dims = users(spark, orders)
            wide = order_wide(orders, known, provinces(spark), dims, tie_break=ROW_KEY).select(*ORDER_WIDE_COLUMNS)
            write_batch(wide, wide_path, batch_id)
            status.upsert(status_of_first_orders(orders, known, ROW_KEY), batch_id)
            if show_rows:
                preview_orders(wide, show_rows).show(show_rows, truncate=False)
            write_rejects(rejected(parsed), rejects_path, batch_id)
            known.unpersist()
        finally:
            parsed.unpersist()

    parsed_orders = text_of_rejects_only(parse_orders(records))
    return (
        counted(parsed_orders, "order_wide", F.col("reason").isNull()).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_5_SECONDS))
        .start()
    )
