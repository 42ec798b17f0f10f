from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.logs import dau_record, derive_dt_hr, parse_app_log
from tillstream.operators.records import rejected, text_of_rejects_only
from tillstream.operators.serving import first_seen
from tillstream.schemas import DAU
from tillstream.sinks.batches import counted, fold_closed_days, keys_of_days, write_day_index, write_rejects
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sinks.rollup import HourlyActives, add_counts
from tillstream.sinks.topics import EVERY_5_SECONDS
from tillstream.streaming.day_state import first_of_days, is_closed

EVERY_10_MINUTES = {"processingTime": "10 minutes"}


def collapse_repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Drop repeats of a key inside each Arrow batch, before the shuffle.

    Streaming de-duplication has no map-side combine of its own; with this a device sending
    a large share of all logs reaches its state partition as a trickle.
    """
    def first_of_each(batches):
        import pyarrow as pa

        for batch in batches:
            columns = {key: batch.column(key) for key in keys}
            table = pa.table({**columns, "_row": pa.array(range(batch.num_rows), pa.int64())})
            yield batch.take(table.group_by(keys).aggregate([("_row", "min")])["_row_min"].combine_chunks())

    return rows.mapInArrow(first_of_each, rows.schema)


def _dated(start_records: DataFrame) -> DataFrame:
    parsed = text_of_rejects_only(parse_app_log(start_records)).drop("start")
    return derive_dt_hr(parsed.withColumn("ts", F.when(F.col("reason").isNull(), F.col("ts"))))


def first_opens(start_records: DataFrame, keep_for: str = "1 day") -> DataFrame:
    """Streaming form of the daily-active table: first arrival per day and device, plus every reject.

    The state of a device lives `keep_for` after its batch was processed. The clock of the processing drives it, and a
    repeated batch keeps its time, so no row can be late: neither a lagging partition nor a replay of old messages nor
    a device with a wrong clock loses rows. A device that comes back for the same day after its state has gone is
    written again; readers of the index take the first of both. Rejects do not pass the de-duplication.
    """
    seen_at = _dated(start_records).withColumn("_seen_at", F.current_timestamp())
    good = seen_at.filter(F.col("reason").isNull())
    opens = (
        collapse_repeats(good, ["dt", "mid"])
        .withWatermark("_seen_at", keep_for)
        .dropDuplicatesWithinWatermark(["dt", "mid"])
    )
    return opens.unionByName(seen_at.filter(F.col("reason").isNotNull())).drop("_seen_at")


def first_opens_by_day(start_records: DataFrame, index_path: str, open_hours: int) -> DataFrame:
    """The same with a state that ends with its day: a device is remembered until `open_hours` after the day's end, by the
    clock of the processing. A new checkpoint starts from the index's rows of the days still open."""
    spark, logs = start_records.sparkSession, _dated(start_records)
    good = collapse_repeats(logs.filter(F.col("reason").isNull()), ["dt", "mid"])
    today = spark.sql("SELECT current_date() AS d").first().d
    days = [str(today + timedelta(days=n)) for n in range(-1 - -(-open_hours // 24), 2)]
    opens = first_of_days(good, keys_of_days(spark, index_path, DAU, days, "mid").distinct(), open_hours)
    return opens.unionByName(logs.filter(F.col("reason").isNotNull()))


def without_indexed(opens: DataFrame, index_path: str, batch_id: int, open_hours: int) -> DataFrame:
    """Opens without those of closed days that an earlier batch wrote. Only the folders of those days are read, and none
    if all days are open; rejects pass."""
    days = [r.dt for r in opens.filter(is_closed(F.col("dt"), open_hours)).select("dt").distinct().collect()]
    if not days:
        return opens
    known = keys_of_days(opens.sparkSession, index_path, DAU, days, "mid", before=batch_id)
    return opens.join(known, ["dt", "mid"], "left_anti")


def new_devices(opens: DataFrame, seen: DataFrame) -> DataFrame:
    """First-seen rows to upsert: devices unknown so far, or now known from an earlier day, and `known_dt`, the day known
    before."""
    batch = first_seen(opens)
    before = seen.join(batch.select("mid"), "mid", "left_semi").withColumnRenamed("first_dt", "known_dt")
    joined = batch.join(before, "mid", "left")
    return joined.filter(F.col("known_dt").isNull() | (F.col("first_dt") < F.col("known_dt"))).select("mid", "first_dt", "known_dt")


def new_device_changes(moved: DataFrame) -> DataFrame:
    """What `new_devices` change in the counts of new devices per day."""
    both = F.array_compact(F.array(
        F.struct("first_dt", F.lit(1).alias("n")),
        F.when(F.col("known_dt").isNotNull(), F.struct(F.col("known_dt").alias("first_dt"), F.lit(-1).alias("n"))),
    ))
    each = moved.select(F.explode(both).alias("c")).select("c.first_dt", "c.n")
    return each.groupBy("first_dt").agg(F.sum("n").alias("change")).filter("change <> 0")


def start_dau(
    start_records: DataFrame,
    index_path: str,
    rejects_path: str,
    checkpoint: str,
    keep_for: str = "1 day",
    trigger: dict | None = None,
    fold_every: int = 200,
    open_days: int = 2,
    name: str | None = None,
    open_hours: int | None = None,
    first_batch: int = 0,
) -> StreamingQuery:
    """Maintain the daily-active index, a folder per day of the log. The `name` is for listeners, such as `SavesOffsets`.

    Every `fold_every` batches the folders of closed days, all but the newest `open_days`, are folded into one a day.

    With `open_hours` a device is remembered until so long after its day's end instead of `keep_for`
    (`first_opens_by_day`), and rows of closed days are looked up in the index: no device is written twice for a day, but
    for one whose clock was first over a day ahead. A new checkpoint goes on with an index by `first_batch`, a number
    over all batches that the index has.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch_id += first_batch
        if batch_id and batch_id % fold_every == 0:
            fold_closed_days(batch.sparkSession, index_path, DAU, "mid", open_days, before=batch_id, first=True)
        batch = batch.persist()
        try:
            if open_hours is not None:
                fresh = without_indexed(batch, index_path, batch_id, open_hours)
            else:
                fresh = batch
            opens = dau_record(fresh.filter(F.col("reason").isNull()))
            write_day_index(opens, index_path, batch_id)
            write_rejects(rejected(batch), rejects_path, batch_id)
        finally:
            batch.unpersist()

    found = first_opens(start_records, keep_for) if open_hours is None else first_opens_by_day(start_records, index_path, open_hours)
    opens = counted(found, "dau_index", F.col("reason").isNull())
    writer = opens.writeStream.queryName(name) if name else opens.writeStream
    return (
        writer.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_5_SECONDS))
        .start()
    )


def start_first_seen(
    opens: DataFrame, seen: KeyedTable, checkpoint: str, snapshot_every: int = 20, trigger: dict | None = None,
    per_day: KeyedTable | None = None,
) -> StreamingQuery:
    """Maintain the first-seen table from a stream of daily-active records, repeats allowed; and with `per_day`, a table of
    `first_dt, n` by `first_dt`, the number of new devices per day.

    It may follow the index or the start topic itself, which needs no listing of files. Every batch looks its devices
    up in their buckets of the table; many devices are in all of them, so batches are larger and rarer than those of
    the index.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id and batch_id % snapshot_every == 0:
            for table in filter(None, (seen, per_day)):
                table.snapshot(spark, as_of=batch_id - 1)
        moved = new_devices(batch, seen.lookup(batch, [F.col("mid")], before=batch_id)).persist()
        try:
            seen.upsert(moved, batch_id)
            if per_day:
                add_counts(per_day, new_device_changes(moved), batch_id)
        finally:
            moved.unpersist()

    return (
        opens.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_10_MINUTES))
        .start()
    )


def start_hourly(
    start_records: DataFrame, rollup: HourlyActives, checkpoint: str, snapshot_every: int = 20, trigger: dict | None = None
) -> StreamingQuery:
    """Maintain the counts of daily actives per day and hour from the start topic. Rejects are left to `start_dau`.

    It needs no state of its own: what is known of a batch's devices comes from the buckets of their days.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % snapshot_every == 0:
            rollup.snapshot(batch.sparkSession, as_of=batch_id - 1)
        rollup.update(batch, batch_id)

    logs = derive_dt_hr(parse_app_log(start_records).filter(F.col("reason").isNull()))
    return (
        logs.select("dt", "mid", "hr", "ts", "partition", "offset").writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_10_MINUTES))
        .start()
    )
