"""Latest row per key and upsert overlays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """One row per key, the first by `order_by`.

    `row_number() = 1` is planned as a group limit on both sides of the exchange, so each map
    task ships at most one row per key however hot the key is.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], versions: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(v).desc_nulls_last() for v in versions])


def overlay(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`current` with `changes` upserted. Both hold at most one row per key.

    The snapshot is only filtered by the changed keys, so a small change set is broadcast by
    the planner and the snapshot is neither shuffled nor sorted.
    """
    kept = current.join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes.select(*current.columns))
