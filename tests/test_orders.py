import json

import pytest
from pyspark.sql import functions as F

from tillstream.operators import orders as ops
from tillstream.operators.joins import checked_left_join
from tillstream.operators.records import accepted, rejected
from tillstream.plans.order_wide import order_wide
from tillstream.schemas import ORDER_FIELDS, ORDER_WIDE_COLUMNS


def order(id, user, time, province=1, **extra):
    return json.dumps({"id": id, "user_id": user, "create_time": time, "province_id": province, **extra})


@pytest.fixture
def orders(records):
    def make(*specs):
        return accepted(ops.parse_orders(records(*[order(*spec) for spec in specs])))
    return make


@pytest.fixture
def status(spark):
    def make(*users):
        return spark.createDataFrame([(str(u), "1", 0) for u in users], "user_id STRING, if_consumed STRING, first_order_id BIGINT")
    return make


@pytest.fixture
def provinces(spark):
    return spark.createDataFrame([("1", "P", "010", "CN-1")], "id STRING, name STRING, area_code STRING, iso_code STRING")


@pytest.fixture
def users(spark):
    return spark.createDataFrame([("1", "g1", "男"), ("3", "g3", "女")], "id STRING, age_group STRING, gender_name STRING")


def test_orders_parse_by_name_with_quoted_or_bare_numbers(records, rows):
    parsed = ops.parse_orders(records(
        order(1, 2, "2024-01-01 05:06:07", final_total_amount=1.5), order("8", "9", "2024-01-01 05:06:07"),
        order(1, 2, "2024-01-01"), order(1, 2, None), order(None, 2, "2024-01-01 01:00:00"),
        order(1, None, "2024-01-01 01:00:00"), "{bad",
    ))
    assert rows(accepted(parsed), "id", "user_id", "create_date", "create_hour", "final_total_amount") == [
        (1, 2, "2024-01-01", "05", 1.5), (8, 9, "2024-01-01", "05", None),
    ]
    assert rows(rejected(parsed), "offset", "reason") == [
        (2, "bad:create_time"), (3, "missing:create_time"), (4, "missing:id"), (5, "missing:user_id"), (6, "bad_json"),
    ]
    assert set(ORDER_FIELDS) <= set(parsed.columns)


def test_first_flag_in_batch(orders, status, rows):
    batch = orders(
        (1, 1, "2024-01-02 00:00:00"), (2, 1, "2024-01-01 00:00:00"), (3, 1, "2024-01-01 00:00:00"),  # new, tie
        (4, 2, "2024-01-01 00:00:00"), (5, 2, "2024-01-02 00:00:00"),  # known
        (6, 3, "2024-01-05 00:00:00"),  # new, single
    )
    looked_up = ops.join_order_user_status(batch, status(2))
    assert rows(looked_up, "id", "if_first_order") == [(1, "1"), (2, "1"), (3, "1"), (4, "0"), (5, "0"), (6, "1")]
    fixed = ops.order_first_flag(looked_up)
    assert rows(fixed, "id", "if_first_order") == [(1, "0"), (2, "1"), (3, "0"), (4, "0"), (5, "0"), (6, "1")]
    assert rows(ops.filter_first_orders(fixed)) == [("1", "1", 2), ("3", "1", 6)]


def test_repeated_copies_of_an_order_give_one_first(orders, status, rows):
    copies = orders(*[(1, 1, "2024-01-01 00:00:00")] * 5)
    fixed = ops.order_first_flag(ops.join_order_user_status(copies, status()), ("id", "partition", "offset"))
    assert rows(fixed, "offset", "if_first_order") == [(0, "1"), (1, "0"), (2, "0"), (3, "0"), (4, "0")]


def test_wide_equals_the_chain_of_single_operators(orders, status, provinces, users, rows):
    batch = orders(*[
        (i, i * i % 7, f"2024-01-{1 + i * 5 % 28:02d} {i % 24:02d}:00:00", i % 3) for i in range(60)
    ])
    chain = ops.order_first_flag(ops.join_order_user_status(batch, status(2, 4)))
    chain = ops.join_order_user(ops.join_order_province(chain, provinces), users)
    want = rows(chain, *ORDER_WIDE_COLUMNS)
    assert rows(order_wide(batch, status(2, 4), provinces, users), *ORDER_WIDE_COLUMNS) == want
    flagged = ops.flag_first_orders(batch, status(2, 4))
    assert rows(flagged, "id", "if_first_order") == rows(chain, "id", "if_first_order")
    assert rows(ops.status_of_first_orders(batch, status(2, 4))) == rows(ops.filter_first_orders(chain))


def test_dimension_misses_stay_null(orders, provinces, users, rows):
    batch = orders((1, 1, "2024-01-01 00:00:00", 1), (2, 2, "2024-01-01 00:00:00", 9), (3, 3, "2024-01-01 00:00:00", None))
    want = [(1, "P", "010", "CN-1"), (2, None, None, None), (3, None, None, None)]
    columns = ["id", "province_name", "province_area_code", "province_iso_code"]
    assert rows(ops.join_order_province(batch, provinces), *columns) == want
    assert rows(ops.join_order_province_bcast(batch, provinces), *columns) == want
    assert rows(ops.join_order_province_bcast(batch, provinces, max_broadcast_rows=0), *columns) == want
    assert rows(ops.join_order_user(batch, users), "id", "user_age_group", "user_gender") == [
        (1, "g1", "男"), (2, None, None), (3, "g3", "女"),
    ]


def test_grouping_by_user_is_whole_and_bounded(orders, rows):
    batch = orders(*[(i, 1 if i % 3 else i, f"2024-01-01 00:00:{i % 60:02d}") for i in range(100)])
    grouped = ops.group_orders_by_user(batch, span=10).collect()
    assert max(len(g["orders"]) for g in grouped) <= 10
    assert sorted((o["id"], g["user_id"]) for g in grouped for o in g["orders"]) == sorted(rows(batch, "id", "user_id"))
    assert {"create_hour", "final_total_amount"} <= set(grouped[0]["orders"][0].asDict())
    assert all(g["orders"] == sorted(g["orders"]) for g in grouped)
    of_one = sorted((g["part"], len(g["orders"]), g["n_orders"]) for g in grouped if g["user_id"] == 1)
    assert of_one == [(k, 10, 66) for k in range(6)] + [(6, 6, 66)]
    parts = [o for g in sorted((g for g in grouped if g["user_id"] == 1), key=lambda g: g["part"]) for o in g["orders"]]
    assert parts == sorted(parts)


def test_grouping_numbers_orders_over_days(orders):
    batch = orders(*[(i, 7, f"2024-01-{1 + i % 5:02d} 00:00:00") for i in range(23)])
    grouped = sorted(ops.group_orders_by_user(batch, span=8).collect(), key=lambda g: g["part"])
    assert [(g["part"], g["n_orders"], len(g["orders"])) for g in grouped] == [(0, 23, 8), (1, 23, 8), (2, 23, 7)]
    assert [o["id"] for o in grouped[0]["orders"]] == [0, 5, 10, 15, 20, 1, 6, 11]


@pytest.fixture
def skewed(spark):
    """One key has a third of the rows, one row in ten has no key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 != 1, F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(3000).withColumn("key", key)


def test_left_join_is_the_same_either_way(spark, skewed, rows):
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "key STRING, v INT")
    plain = rows(skewed.join(dim, "key", "left"), "id", "key", "v")
    assert rows(checked_left_join(skewed, dim, "key"), "id", "key", "v") == plain
    assert rows(checked_left_join(skewed, dim, "key", max_broadcast_rows=2), "id", "key", "v") == plain


def test_any_number_of_hot_keys_is_split(spark):
    """With partitions of a few keys each, all of them hot, the fact side of every one is read in parts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fact = spark.range(0, 400_000, numPartitions=8).select("id", F.concat(F.lit("k"), F.col("id") % 20).alias("key"))
        dim = spark.range(20).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
        joined = checked_left_join(fact, dim, "key", max_broadcast_rows=0)
        assert joined.filter(F.concat(F.lit("k"), "v") == F.col("key")).count() == 400_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
