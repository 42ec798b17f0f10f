"""Order facts: dates, first-order flags, dimension columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillstream.functions.times import date_part, hour_part
from tillstream.operators.joins import MAX_BROADCAST_ROWS, checked_left_join, matching_rows
from tillstream.operators.records import parse_typed
from tillstream.schemas import ORDER_FIELDS
from tillstream.session import scratch_dir

FIRST, NOT_FIRST = "1", "0"


def derive_create_date_hour(orders: DataFrame) -> DataFrame:
    return orders.withColumns({
        "create_date": date_part(F.col("create_time")),
        "create_hour": hour_part(F.col("create_time")),
    })


def parse_orders(records: DataFrame) -> DataFrame:
    """Typed orders with date and hour; an order without id, user or time of day is rejected."""
    typed = parse_typed(records, ORDER_FIELDS, required=["id", "user_id", "create_time"])
    orders = derive_create_date_hour(typed)
    timeless = F.col("reason").isNull() & F.col("create_hour").isNull()
    return orders.withColumn("reason", F.when(timeless, "bad:create_time").otherwise(F.col("reason")))


def known_users(orders: DataFrame, status: DataFrame) -> DataFrame:
    """Users of the orders the status table knows: `user_id, _known`.

    What the lookup finds is the text of some order's user id, so the cast back is exact.
    """
    found = matching_rows(status.select("user_id"), orders, "user_id", "user_id").distinct()
    return found.select(F.col("user_id").cast("bigint").alias("user_id"), F.lit(True).alias("_known"))


def user_columns(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Dimension columns of the users of the orders, by `user_id`."""
    found = matching_rows(users.select("id", "age_group", "gender_name"), orders, "id", "user_id")
    return found.select(
        F.col("id").cast("bigint").alias("user_id"),
        F.col("age_group").alias("user_age_group"),
        F.col("gender_name").alias("user_gender"),
    )


def join_order_user_status(orders: DataFrame, status: DataFrame) -> DataFrame:
    """`if_first_order`: `0` for users the status table knows, `1` for others."""
    joined = orders.join(known_users(orders, status), "user_id", "left")
    flag = F.when(F.col("_known"), NOT_FIRST).otherwise(FIRST)
    return joined.withColumn("if_first_order", flag).drop("_known")


def numbered_by_user(orders: DataFrame, path: str) -> DataFrame:
    """The orders with `_nth`, the order's number among its user's by `(create_date, create_time, id)`, and `n_orders`.

    Rows are dealt out in ranges of all four columns and written in order, so that a user's orders, of one day too, go to
    as many tasks as they fill. A number is the row's place in its part of the table, plus the user's rows in the parts
    before: counts by user and part are all that is added up.
    """
    order = ["user_id", "create_date", "create_time", "id"]
    dealt = orders.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt.write.mode("overwrite").parquet(path)
    placed = orders.sparkSession.read.schema(dealt.schema).parquet(path).withColumn("_run", F.struct("user_id", F.shiftright("_at", 33).alias("part")))
    runs = placed.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    user = Window.partitionBy("_run.user_id")
    before = F.sum("_n").over(user.orderBy("_run.part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_run", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(user).alias("n_orders"))
    nth = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return placed.join(runs, "_run").select(*orders.columns, "n_orders", nth.alias("_nth"))


def group_orders_by_user(orders: DataFrame, span: int = 1_000, columns: Sequence[str] | None = None, path: str | None = None) -> DataFrame:
    """`user_id, n_orders, part, orders`: each user's orders by `(create_date, create_time, id)` and how many the user has.

    A row holds at most `span` orders; a user with more has more parts, numbered from 0 by time. Orders without a date
    come first, orders without a user are one user's. See `numbered_by_user`; `path` is where it keeps its table, by
    default in the shared scratch folder.
    """
    kept = columns or [c for c in orders.columns if c not in ("user_id", "create_date", "create_time", "id")]
    used = orders.select("user_id", "create_date", "create_time", "id", *kept)
    ranked = numbered_by_user(used, path or scratch_dir(orders.sparkSession, "orders_by_user"))
    part = F.call_function("div", F.col("_nth") - 1, F.lit(span))
    order = F.struct("create_time", "id", *kept)
    return ranked.groupBy("user_id", "n_orders", part.alias("part")).agg(F.sort_array(F.collect_list(order)).alias("orders"))


def first_orders(orders: DataFrame, status: DataFrame, tie_break: tuple[str, ...] = ("id",)) -> DataFrame:
    """The earliest order of each user the status table does not know: `user_id, create_time, *tie_break`.

    One minimum per user, combined map-side, then an anti-join of one row per user.
    """
    firsts = orders.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min(F.struct("create_time", *tie_break)).alias("_first")
    )
    keyed = firsts.withColumn("_key", F.col("user_id").cast("string"))
    unknown = keyed.join(status.select(F.col("user_id").alias("_key")), "_key", "left_anti")
    return unknown.select("user_id", "_first.*")


def flag_first_orders(orders: DataFrame, status: DataFrame, tie_break: tuple[str, ...] = ("id",)) -> DataFrame:
    """`if_first_order` in one go: `join_order_user_status` and `order_first_flag`, with the orders read twice only."""
    row_key = ["create_time", *tie_break]
    firsts = first_orders(orders, status, tie_break).withColumn("_is_first", F.lit(True))
    joined = orders.join(firsts, ["user_id", *row_key], "left")
    flag = F.when(F.col("_is_first"), FIRST).otherwise(NOT_FIRST)
    return joined.select(*orders.columns, flag.alias("if_first_order"))


def status_of_first_orders(orders: DataFrame, status: DataFrame, tie_break: tuple[str, ...] = ("id",)) -> DataFrame:
    """Status rows of the users whose first order is here, without going back to the orders."""
    return first_orders(orders, status, tie_break).select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"), F.col("id").alias("first_order_id")
    )


def order_first_flag(orders: DataFrame, tie_break: tuple[str, ...] = ("id",)) -> DataFrame:
    """Fix `if_first_order` within a batch: of a new user's orders only the earliest keeps `1`.

    Earliest by `(create_time, *tie_break)`, which must tell rows apart; with at-least-once
    input add `partition, offset`. The minimum per user combines map-side, and the join back is on
    the whole row key, so a user with very many orders loads no single task.
    """
    row_key = ["create_time", *tie_break]
    firsts = (
        orders.filter(F.col("if_first_order") == FIRST)
        .groupBy("user_id")
        .agg(F.min(F.struct(*row_key)).alias("_first"))
        .select("user_id", "_first.*", F.lit(True).alias("_is_first"))
    )
    flag = F.when(F.col("_is_first"), FIRST).otherwise(NOT_FIRST)
    joined = orders.join(firsts, ["user_id", *row_key], "left")
    return joined.withColumn("if_first_order", flag).select(*orders.columns)


def _province_columns(provinces: DataFrame) -> DataFrame:
    return provinces.select(
        F.col("id").alias("_province"),
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_code").alias("province_iso_code"),
    )


def join_order_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Left join to provinces, strategy left to the planner.

    It broadcasts a table whose measured size is under its threshold; beyond that it sorts and
    merges, and adaptive execution splits the partitions of provinces holding many orders.
    """
    keyed = orders.withColumn("_province", F.col("province_id").cast("string"))
    return keyed.join(_province_columns(provinces), "_province", "left").drop("_province")


def join_order_province_bcast(
    orders: DataFrame, provinces: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """The same with provinces broadcast once, after a count proves them few."""
    keyed = orders.withColumn("_province", F.col("province_id").cast("string"))
    dim = _province_columns(provinces)
    return checked_left_join(keyed, dim, "_province", max_broadcast_rows).drop("_province")


def join_order_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Left join to users: age group and gender name."""
    return orders.join(user_columns(orders, users), "user_id", "left")


def filter_first_orders(orders: DataFrame) -> DataFrame:
    """Status rows of the users whose first order is here."""
    return orders.filter(F.col("if_first_order") == FIRST).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.lit("1").alias("if_consumed"),
        F.col("id").alias("first_order_id"),
    )
