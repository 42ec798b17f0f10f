"""Orders with first-order flag, province and user columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.operators.orders import FIRST, NOT_FIRST, join_order_province_bcast
from tillstream.schemas import ORDER_WIDE_COLUMNS


def batch_users(orders: DataFrame, tie_break: tuple[str, ...]) -> DataFrame:
    """One row per user: the key of the first order. Combined map-side."""
    return orders.groupBy("user_id").agg(F.min(F.struct("create_time", *tie_break)).alias("_first"))


def order_wide(
    orders: DataFrame,
    status: DataFrame,
    provinces: DataFrame,
    users: DataFrame,
    tie_break: tuple[str, ...] = ("id",),
) -> DataFrame:
    """The wide order. `orders` are typed and dated; `status` holds the users known before.

    Whatever is known per user (status, first order, dimension) is gathered first, on one row per
    user, so the orders themselves are shuffled once, by user; adaptive execution splits the partitions of users with
    very many orders. Provinces are broadcast when few.
    """
    per_user = batch_users(orders, tie_break)
    key = F.col("user_id").cast("string")
    keyed = per_user.withColumn("_key", key)
    known = status.select(F.col("user_id").alias("_key"), F.lit(True).alias("_known"))
    dim = users.select(F.col("id").alias("_key"), F.col("age_group").alias("user_age_group"), F.col("gender_name").alias("user_gender"))
    info = keyed.join(known, "_key", "left").join(dim, "_key", "left").select(
        "user_id", F.when(F.col("_known").isNull(), F.col("_first")).alias("_first"), "user_age_group", "user_gender"
    )
    joined = orders.join(info, "user_id", "left")
    is_first = F.struct("create_time", *tie_break).eqNullSafe(F.col("_first"))
    flagged = joined.withColumn("if_first_order", F.when(is_first, FIRST).otherwise(NOT_FIRST))
    kept = ORDER_WIDE_COLUMNS + [c for c in tie_break if c not in ORDER_WIDE_COLUMNS]
    return join_order_province_bcast(flagged, provinces).select(*kept)
