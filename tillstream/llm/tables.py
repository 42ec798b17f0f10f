"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once under `spark.checkpoint.dir` and read back: later steps, and tasks that are run again after a
    lost executor, read files and recompute nothing."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A table of keys and numbers with up to this many rows is broadcast: some 25 MB.
BROADCAST_ROWS = 500_000


def join_checked(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join to a stored table of short rows: broadcast after a count shows it to be small, else shuffled, where Spark
    splits the partitions of hot keys. `rows` is the count if it is known."""
    few = (small.count() if rows is None else rows) <= BROADCAST_ROWS
    return df.join(F.broadcast(small) if few else small, on, how)
