"""Writers for use inside `foreachBatch`, and readers of what they wrote.

A repeated batch replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tillstream import fs
from tillstream.operators.keyed import first_per_key, latest_per_key


def _with_batch_id(schema: str) -> str:
    return schema if "batch_id" in schema else f"{schema}, batch_id BIGINT"


def write_batch(rows: DataFrame, root: str, batch_id: int) -> None:
    """Write to `root/batch_id=<n>/`, replacing that folder.

    The rebalance hint sizes output files at run time: few for a small batch, and a big or
    lopsided batch is split.
    """
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def write_rejects(rejects: DataFrame, root: str, batch_id: int) -> None:
    """The same for rows that are rare: a batch without any leaves no empty files."""
    if not rejects.isEmpty():
        write_batch(rejects, root, batch_id)


def read_batch(spark: SparkSession, root: str, schema: str, batch_id: int) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/batch_id={batch_id}")


def read_batches(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All batches written under root, with the given columns; empty while nothing was written."""
    if not fs.exists(spark, root):
        return spark.createDataFrame([], schema)
    columns = spark.createDataFrame([], schema).columns
    return spark.read.schema(_with_batch_id(schema)).parquet(root).select(*columns)


def write_day_index(docs: DataFrame, root: str, batch_id: int, day: str = "dt") -> None:
    """Bulk-write documents to their day's folder, `root/dt=<day>/batch_id=<n>/`.

    A day reads as one folder. Only the folders this batch has rows for are replaced.
    """
    (
        docs.withColumn("batch_id", F.lit(batch_id))
        .hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day, "batch_id")
        .parquet(root)
    )


def read_day_index(
    spark: SparkSession, root: str, schema: str, key: str, day: str = "dt", first: bool = False
) -> DataFrame:
    """The index with the given columns, a document for each day and key; empty while nothing was written.

    Of documents written repeatedly the last batch's is taken, or the first's. Filter on the day to prune: the filter
    passes below the choice, which is made within a day.
    """
    if not fs.exists(spark, root):
        return spark.createDataFrame([], schema)
    columns = spark.createDataFrame([], schema).columns
    docs = _day_rows(spark, root, schema, day)
    chosen = first_per_key(docs, [day, key], ["batch_id"]) if first else latest_per_key(docs, [day, key], ["batch_id"])
    return chosen.select(*columns)


def keys_of_days(
    spark: SparkSession, root: str, schema: str, dates: list[str], key: str, before: int | None = None, day: str = "dt"
) -> DataFrame:
    """Day and key of the documents of these days, repeats allowed; with `before`, of batches before that one only."""
    if not fs.exists(spark, root):
        return spark.createDataFrame([], schema).select(day, key)
    rows = _day_rows(spark, root, schema, day).filter(F.col(day).isin(dates))
    return (rows if before is None else rows.filter(F.col("batch_id") < before)).select(day, key)


def read_daily_active(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The daily-active index: each day's devices once, as first written."""
    return read_day_index(spark, root, schema, key="mid", first=True)


# Folding a day. `_folds/<day>=<date>` in the index, hidden from readers of its folders, holds the folded copy as
# `batch_id=<n>`, and, once the copy is complete, the empty folders `replaces=<batch>`, last of all `intent=<n>`.
_FOLDS = "_folds"


def _day_rows(spark: SparkSession, root: str, schema: str, day: str) -> DataFrame:
    """All rows of the index. Where a fold was begun, its copy counts instead of the folders that it replaces."""
    with_batch = _with_batch_id(schema)
    rows = spark.read.schema(with_batch).parquet(root)
    for date, into, replaced in _intents(spark, root, day):
        rows = rows.filter(~((F.col(day) == date) & F.col("batch_id").isin(replaced)))
        place = f"{root}/{_FOLDS}/{day}={date}/batch_id={into}"
        if not fs.exists(spark, place):  # moved to its place already
            place = f"{root}/{day}={date}/batch_id={into}"
        schema_there = spark.createDataFrame([], with_batch).drop(day, "batch_id").schema
        copy = spark.read.schema(schema_there).parquet(place)
        rows = rows.unionByName(copy.withColumns({day: F.lit(date), "batch_id": F.lit(into).cast("bigint")}))
    return rows


def _intents(spark: SparkSession, root: str, day: str) -> list[tuple[str, int, list[int]]]:
    """Folds begun and not done: the day, the batch that the copy stands for, and the batches that it replaces."""
    found = []
    for date in fs.named(spark, f"{root}/{_FOLDS}", day):
        here = f"{root}/{_FOLDS}/{day}={date}"
        for into in fs.numbered(spark, here, "intent"):
            found.append((date, into, fs.numbered(spark, here, "replaces")))
    return found


def finish_folds(spark: SparkSession, root: str, day: str = "dt") -> None:
    """Carry out the folds that have an intent. Each step can be taken again: folders go only while the copy, complete,
    is still beside, or has taken its place. What a fold without an intent left goes."""
    for date, into, replaced in _intents(spark, root, day):
        here, folder = f"{root}/{_FOLDS}/{day}={date}", f"{root}/{day}={date}"
        beside = fs.exists(spark, f"{here}/batch_id={into}")
        for batch in replaced:
            if beside or batch != into:
                fs.delete_dir(spark, f"{folder}/batch_id={batch}")
        if beside:
            fs.make_dir(spark, folder)
            if not fs.rename(spark, f"{here}/batch_id={into}", f"{folder}/batch_id={into}"):
                raise OSError(f"cannot move the folded copy of {folder}")
        fs.delete_dir(spark, f"{here}/intent={into}")  # first: without it nothing else here counts
    for date in fs.named(spark, f"{root}/{_FOLDS}", day):
        fs.delete_dir(spark, f"{root}/{_FOLDS}/{day}={date}")


def compact_day(
    spark: SparkSession, root: str, schema: str, date: str, key: str | None, day: str = "dt", first: bool = False,
    before: int | None = None,
) -> None:
    """Fold a closed day into its oldest batch's folder, so that a day does not keep a folder per batch. Without `key`
    all rows stay. With `before`, only batches before that one are folded.

    The folded copy is written beside; then an intent names it and the folders that it replaces; then these go and the
    copy takes their place. After a failure before the intent nothing has happened, after it whoever folds next finishes
    the fold, and readers take the copy meanwhile. A batch that is being written or repeated must not be folded.
    """
    finish_folds(spark, root, day)
    folder, here = f"{root}/{day}={date}", f"{root}/{_FOLDS}/{day}={date}"
    folded = [b for b in fs.complete_batches(spark, folder, marked=False) if before is None or b < before]
    if len(folded) < 2:
        return
    rows = spark.read.schema(_with_batch_id(schema)).parquet(root).filter((F.col(day) == date) & F.col("batch_id").isin(folded))
    if key:
        rows = first_per_key(rows, [key], ["batch_id"]) if first else latest_per_key(rows, [key], ["batch_id"])
    fs.delete_dir(spark, here)
    rows.select(*[c for c in spark.createDataFrame([], schema).columns if c not in (day, "batch_id")]).hint("rebalance").write.parquet(
        f"{here}/batch_id={folded[0]}"
    )
    for batch in folded:
        fs.make_dir(spark, f"{here}/replaces={batch}")
    fs.make_dir(spark, f"{here}/intent={folded[0]}")
    finish_folds(spark, root, day)


def fold_closed_days(
    spark: SparkSession, root: str, schema: str, key: str | None, open_days: int, day: str = "dt", before: int | None = None, first: bool = False
) -> None:
    """Fold every day of the index but the newest `open_days`. Days with one folder cost a listing."""
    finish_folds(spark, root, day)
    days = fs.named(spark, root, day)
    for date in days[:len(days) - open_days] if open_days else days:
        compact_day(spark, root, schema, date, key, day, first, before)


def day_index_stream(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Documents of the index as they are written."""
    columns = spark.createDataFrame([], schema).columns
    return spark.readStream.schema(_with_batch_id(schema)).parquet(root).select(*columns)


def preview(rows: DataFrame, n: int = 1000) -> DataFrame:
    """First rows of a batch, for printing."""
    return rows.limit(n)


def preview_orders(orders: DataFrame, n: int = 1000) -> DataFrame:
    """The earliest orders of a batch, by time and id; every task keeps only `n`."""
    return preview(orders.orderBy("create_time", "id"), n)


def write_counted(rows: DataFrame, root: str, counts_root: str, batch_id: int) -> None:
    """Write a batch, and how many rows it wrote as a row of its own, counted on the way and not read again."""
    seen = Observation()
    write_batch(rows.observe(seen, F.count(F.lit(1)).alias("n_written")), root, batch_id)
    count = rows.sparkSession.createDataFrame([(seen.get["n_written"],)], "n_written BIGINT")
    write_batch(count, counts_root, batch_id)


def written_count(spark: SparkSession, counts_root: str) -> DataFrame:
    """One row: rows written by all batches, however many; a repeated batch counts once."""
    return read_batches(spark, counts_root, "n_written BIGINT").agg(F.coalesce(F.sum("n_written"), F.lit(0)).alias("n_written"))


def counted(stream: DataFrame, name: str = "sink", only: Column | None = None) -> DataFrame:
    """The same stream, the number of rows on their way to the sink reported as metric `name.rows`.

    It shows in `lastProgress["observedMetrics"]` of each batch, and takes no second pass.
    """
    return stream.observe(name, F.count_if(F.lit(True) if only is None else only).alias("rows"))


def landing_lines(records: DataFrame, day: Column | None = None) -> DataFrame:
    """Raw messages with the day they arrived."""
    arrived = F.date_format("timestamp", "yyyy-MM-dd") if day is None else day
    return records.select("value", arrived.alias("dt"))
