"""Test tables -> topic records, orders, dimensions and documents.

Narrow expressions only, so each works on a stream as on a table. `oracle.py` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2024-01-01 00:00:00"
DAY = "2024-01-15"
BATCH_FROM = "1996-01-01"  # orders before are history, orders since are the batch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def app_log_records(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    user, event = F.col("user_id"), F.col("event_id")
    common = F.struct(
        F.concat(F.lit("mid_"), user).alias("mid"),
        user.cast("string").alias("uid"),
        F.concat(F.lit("ar_"), user % 34).alias("ar"),
        F.concat(F.lit("ch_"), event % 4).alias("ch"),
        F.concat(F.lit("v1."), user % 3).alias("vc"),
    )
    start = F.when(F.col("event_type") == "view", F.struct(F.lit("icon").alias("entry")))
    log = F.struct(F.unix_millis(ts).alias("ts"), common.alias("common"), start.alias("start"))
    return _records("app_log", event, F.to_json(log), events, ts, 3)


def _records(topic, key, value, df: DataFrame, timestamp, partitions: int) -> DataFrame:
    return df.select(
        F.lit(topic).alias("topic"),
        (key % partitions).cast("int").alias("partition"),
        F.call_function("div", key, F.lit(partitions)).alias("offset"),
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
        timestamp.alias("timestamp"),
    )


def start_log_records(events: DataFrame) -> DataFrame:
    return app_log_records(events.filter(F.col("event_type") == "view"))


def order_facts(orders: DataFrame) -> DataFrame:
    """Typed orders without derived columns."""
    key = F.col("o_orderkey")
    hour = F.lpad((key % 24).cast("string"), 2, "0")
    none = F.lit(None).cast("string")
    return orders.select(
        key.alias("id"),
        (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("final_total_amount"),
        F.lit(0.0).alias("benefit_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"),
        F.lit(0.0).alias("feight_fee"),
        none.alias("expire_time"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), hour, F.lit(":00:00")).alias("create_time"),
        none.alias("operate_time"),
    )


def order_batch(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") >= F.lit(BATCH_FROM).cast("timestamp_ntz"))


def order_records(orders: DataFrame) -> DataFrame:
    value = F.to_json(F.struct(*order_facts(orders).columns))
    facts = order_facts(orders)
    return _records("ods_order_info", F.col("id"), value, facts, F.to_timestamp("create_time"), 3)


def user_status(orders: DataFrame) -> DataFrame:
    """Users who ordered before the batch."""
    before = orders.filter(F.col("o_orderdate") < F.lit(BATCH_FROM).cast("timestamp_ntz"))
    return before.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order_id")).select(
        F.col("o_custkey").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"), "first_order_id"
    )


def provinces(nation: DataFrame) -> DataFrame:
    """Nations outside one region, so that orders of that region find no province."""
    return nation.filter(F.col("n_regionkey") != 3).select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.concat(F.lit("CN-"), "n_nationkey").alias("iso_code"),
    )


def raw_users(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1965-01-01").cast("date"), ((key * 137) % 16000).cast("int"))
    return customer.select(
        key.cast("string").alias("id"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(born, "yyyy-MM-dd").alias("birthday"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
    )


def dim_records(topic: str, rows: DataFrame) -> DataFrame:
    value = F.to_json(F.struct(*rows.columns))
    return _records(topic, F.col("id").cast("bigint"), value, rows, F.timestamp_seconds(F.lit(0)), 3)


def canal_records(orders: DataFrame) -> DataFrame:
    """An envelope per order with one to three rows; which kind of change follows from its status."""
    facts = order_facts(orders)
    key, status = F.col("id"), F.col("order_status")
    copies = F.sequence(F.lit(0).cast("bigint"), key % 3)
    rows = F.transform(copies, lambda i: F.struct(
        (key * 4 + i).alias("id"), F.col("user_id"), F.col("final_total_amount"), F.col("create_time")
    ))
    kind = F.when(status == "F", "INSERT").when(status == "O", "insert").otherwise("UPDATE")
    envelope = F.struct(kind.alias("type"), F.lit("order_info").alias("table"), rows.alias("data"))
    return _records("db_canal", key, F.to_json(envelope), facts, F.to_timestamp("create_time"), 3)


def maxwell_records(orders, customer, nation, part, supplier) -> DataFrame:
    """Row changes of five tables, one of them not passed on; kind and lack of data follow from columns."""
    def changes(rows: DataFrame, name: str, key: str, fields: dict[str, str], kind, empty) -> DataFrame:
        data = F.struct(*[F.col(column).alias(field) for field, column in fields.items()])
        value = F.concat(
            F.lit('{"type":"'), kind, F.lit(f'","table":"{name}","data":'),
            F.when(empty, "{}").otherwise(F.to_json(data)), F.lit("}"),
        )
        return _records("db_maxwell", F.col(key).cast("bigint"), value, rows, F.timestamp_seconds(F.lit(0)), 3)

    status, segment = F.col("o_orderstatus"), F.col("c_mktsegment")
    order_fields = {"id": "o_orderkey", "user_id": "o_custkey", "final_total_amount": "o_totalprice"}
    return (
        changes(
            orders, "order_info", "o_orderkey", order_fields,
            F.when(status == "F", "insert").when(status == "O", "update").otherwise("delete"),
            F.col("o_orderpriority") == "5-LOW",
        )
        .union(changes(
            customer, "user_info", "c_custkey", {"id": "c_custkey", "user_level": "c_mktsegment"},
            F.when(segment == "BUILDING", "insert").otherwise("delete"), F.col("c_acctbal") < 0,
        ))
        .union(changes(
            nation, "base_province", "n_nationkey", {"id": "n_nationkey", "name": "n_name"},
            F.lit("insert"), F.col("n_regionkey") == 4,
        ))
        .union(changes(
            part, "sku_info", "p_partkey", {"id": "p_partkey", "name": "p_name"},
            F.lit("update"), F.col("p_size") > 45,
        ))
        .union(changes(
            supplier, "comment_info", "s_suppkey", {"id": "s_suppkey", "name": "s_name"},
            F.lit("insert"), F.col("s_acctbal") < 0,
        ))
    )


def documents(part: DataFrame) -> DataFrame:
    def actor(number: int, name: str):
        return F.struct(F.lit(number).cast("bigint").alias("id"), F.col(name).alias("name"))

    return part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("doubanScore"),
        F.array(actor(1, "p_brand"), actor(2, "p_type")).alias("actorList"),
    )
