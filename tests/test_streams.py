"""Streams against the batch operators: replay in order, restart, repeated batches."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import Window as W, functions as F

from tillstream import schemas
from tillstream.checks import fixtures as fx
from tillstream.checks.queries import Tables, users as enriched_users
from tillstream.operators.orders import parse_orders
from tillstream.operators import serving
from tillstream.operators.records import accepted
from tillstream.plans.daily_active import daily_active
from tillstream.plans.order_wide import order_wide
from tillstream.session import scratch_dir
from tillstream.sinks import batches
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sources.topics import file_topic
from tillstream.streaming.daily_active import start_dau, start_first_seen
from tillstream.streaming.dims import start_dim_province, start_dim_user
from tillstream.streaming.logs import start_log_landing, start_log_split
from tillstream.streaming.orders import start_order_wide

FOLDER = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


@pytest.fixture
def t(spark):
    return Tables(spark, FOLDER)


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "stream")


def append(records, path, order=("partition", "offset")):
    """One file with these records, in order, to the topic at path."""
    records.repartition(1).sortWithinPartitions(*order).write.mode("append").parquet(f"{path}/topic")


def in_files(records, n, order):
    tile = F.ntile(n).over(W.orderBy(*order))
    cut = records.withColumn("_tile", tile).persist()
    return [cut.filter(F.col("_tile") == i).drop("_tile") for i in range(1, n + 1)]


def run(start, spark, base, **kwargs):
    topic = file_topic(spark, f"{base}/topic", max_files_per_trigger=1)
    query = start(topic, checkpoint=f"{base}/checkpoint", trigger=ONCE, **kwargs)
    query.awaitTermination()
    return query


def forget_commit(path, batch, last):
    """As if the driver had died after the output of a batch, before its commit."""
    logs = [("commits", n) for n in range(batch, last + 1)] + [("offsets", n) for n in range(batch + 1, last + 1)]
    for folder, n in logs:
        entry = Path(path) / "checkpoint" / folder
        os.remove(entry / str(n))
        if (entry / f".{n}.crc").exists():
            os.remove(entry / f".{n}.crc")


def log(mid, ts, **extra):
    return json.dumps({"ts": ts, "common": {"mid": mid}, "start": {}, **extra})


def dau(spark, path, **kwargs):
    query = run(start_dau, spark, path, index_path=f"{path}/index", rejects_path=f"{path}/rejects", **kwargs)
    return query, batches.read_daily_active(spark, f"{path}/index", schemas.DAU)


def test_dau_replay_equals_batch_across_restart_and_repeat(spark, t, path, rows):
    records = fx.start_log_records(t.events)
    order = ("timestamp", "partition", "offset")
    files = in_files(records, 6, order)
    for part in files[:3]:
        append(part, path, order)
    dau(spark, path)
    forget_commit(path, 2, last=3)  # batch 3 had no input, it only moved the watermark
    for part in files[3:]:
        append(part, path, order)
    query, index = dau(spark, path)
    assert rows(index, *schemas.DAU_COLUMNS) == rows(daily_active(records), *schemas.DAU_COLUMNS)
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == 0
    by_batch = batches.read_daily_active(spark, f"{path}/index", f"{schemas.DAU}, batch_id BIGINT").groupBy("batch_id").count()
    written = dict(rows(by_batch))
    counted = {p["batchId"]: p["observedMetrics"]["dau_index"]["rows"] for p in query.recentProgress if p["numInputRows"]}
    assert len(counted) == 4 and counted == {batch: written[batch] for batch in counted}


def test_old_arrivals_and_late_repeats_lose_and_double_nothing(spark, path, records, rows):
    """A lagging partition, a bad old message, and a device whose state has gone before it comes back."""
    day = 86_400_000

    def at(frame, date):
        return frame.withColumn("timestamp", F.lit(date).cast("timestamp"))

    append(at(records(log("a", 1000)), "2024-01-05"), path)
    dau(spark, path, keep_for="1 second")
    append(at(records(log("old", 2000), "{bad"), "2024-01-02"), path)
    dau(spark, path, keep_for="1 second")
    append(at(records(log("a", 1500), log("b", day)), "2024-01-09"), path)
    query, index = dau(spark, path, keep_for="1 second")
    assert rows(index, "mid", "ts") == [("a", 1000), ("b", day), ("old", 2000)]
    assert serving.dau_total(index, "1970-01-01").first().total == 2
    rejects = batches.read_batches(spark, f"{path}/rejects", schemas.REJECT)
    assert rows(rejects, "value", "reason") == [("{bad", "bad_json")]
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0
    assert states[-1]["numRowsTotal"] <= 3, "state of past devices is let go"


def test_a_closed_day_is_compacted(spark, path, rows):
    day = {"uid": "u", "ar": "r", "ch": "c", "vc": "v", "hr": "00", "mi": "00"}
    for n in range(30):
        some = spark.createDataFrame([{**day, "mid": f"m{n % 7}", "dt": d, "ts": n} for d in ("2024-01-01", "2024-01-02")], schemas.DAU)
        batches.write_day_index(some, f"{path}/index", n)
    before = rows(batches.read_daily_active(spark, f"{path}/index", schemas.DAU))
    batches.compact_day(spark, f"{path}/index", schemas.DAU, "2024-01-01", "mid", first=True)
    batches.compact_day(spark, f"{path}/index", schemas.DAU, "2024-01-01", "mid", first=True)
    assert rows(batches.read_daily_active(spark, f"{path}/index", schemas.DAU)) == before and len(before) == 14
    files = {d: len(list(Path(f"{path}/index/dt={d}").rglob("*.parquet"))) for d in ("2024-01-01", "2024-01-02")}
    assert files == {"2024-01-01": 1, "2024-01-02": 30}
    plan = batches.read_daily_active(spark, f"{path}/index", schemas.DAU).filter("dt = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(dt" in plan._jdf.queryExecution().toString()


def test_a_wrong_device_clock_harms_no_other_device(spark, path, records, rows):
    future = 4_070_908_800_000
    append(records(log("a", 1000), log("odd", future)), path)
    append(records(log("b", 2000), log("a", 1500), log("odd", future), log("old", 3)), path)
    _, index = dau(spark, path)
    assert rows(index, "mid", "dt") == [("a", "1970-01-01"), ("b", "1970-01-01"), ("odd", "2099-01-01"), ("old", "1970-01-01")]


def test_dau_rejects_are_all_kept(spark, path, records, rows):
    append(records("{bad", "{bad", log(None, 1), log("a", 1)), path)
    append(records("{bad", log("a", 2), topic="t2"), path)
    _, index = dau(spark, path)
    assert rows(index, "mid", "ts") == [("a", 1)]
    rejects = batches.read_batches(spark, f"{path}/rejects", schemas.REJECT)
    assert rows(rejects, "topic", "offset", "reason") == [
        ("t", 0, "bad_json"), ("t", 1, "bad_json"), ("t", 2, "missing:mid"), ("t2", 0, "bad_json"),
    ]
    assert {r["value"] for r in rejects.collect()} == {"{bad", log(None, 1)}


def test_collapsing_keeps_the_first_of_every_key_per_arrow_batch(spark):
    from tillstream.streaming.daily_active import collapse_repeats
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "100")
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 700))
        many = spark.range(0, 3000, numPartitions=2).select("id", F.lit("d").alias("day"), key.alias("key"))
        left = collapse_repeats(many, ["day", "key"])
        assert left.select("key").distinct().count() == many.select("key").distinct().count()
        assert left.filter("key = 'hot'").count() == 30, "one per Arrow batch"
        firsts = {r["key"]: r["id"] for r in many.groupBy("key").agg(F.min("id").alias("id")).collect()}
        assert {r["key"]: r["id"] for r in left.groupBy("key").agg(F.min("id").alias("id")).collect()} == firsts
    finally:
        spark.conf.set(setting, before)


def test_a_user_with_a_third_of_all_orders(spark, t, path, records, rows):
    status = KeyedTable(f"{path}/status", schemas.USER_STATUS, ("user_id",))
    texts = [
        json.dumps({"id": i, "user_id": 1 if i % 3 else i, "create_time": f"2024-01-01 00:{i % 60:02d}:00"})
        for i in range(300)
    ]
    append(records(*texts), path)
    got = wide(spark, t, path, status)
    assert got.count() == 300
    assert rows(got.filter("user_id = 1 AND if_first_order = '1'"), "id") == [(1,)]
    assert got.filter("if_first_order = '1'").count() == 101


def test_first_seen_moves_back_when_an_earlier_day_arrives(spark, path, records, rows):
    day = 86_400_000
    seen = KeyedTable(f"{path}/seen", schemas.FIRST_SEEN, ("mid",))

    def update():
        stream = batches.day_index_stream(spark, f"{path}/index", schemas.DAU)
        start_first_seen(stream, seen, f"{path}/seen_checkpoint", snapshot_every=1, trigger=ONCE).awaitTermination()
        return rows(seen.read(spark))

    append(records(log("a", 5 * day), log("b", 5 * day)), path)
    dau(spark, path)
    assert update() == [("a", "1970-01-06"), ("b", "1970-01-06")]
    append(records(log("a", 6 * day), log("b", 2 * day), log("c", 6 * day)), path)
    dau(spark, path)
    assert update() == [("a", "1970-01-06"), ("b", "1970-01-03"), ("c", "1970-01-07")]


def wide(spark, t, path, status):
    run(
        start_order_wide, spark, path, wide_path=f"{path}/wide", rejects_path=f"{path}/rejects", status=status,
        provinces=lambda s: fx.provinces(t.nation), users=lambda s, orders: enriched_users(t), snapshot_every=2, show_rows=1,
    )
    return batches.read_batches(spark, f"{path}/wide", schemas.ORDER_WIDE)


def test_order_replay_equals_batch_across_restart_and_repeat(spark, t, path, rows):
    status = KeyedTable(f"{path}/status", schemas.USER_STATUS, ("user_id",))
    before = fx.user_status(t.orders)
    status.upsert(before, -1)
    records = fx.order_records(fx.order_batch(t.orders))
    files = in_files(records, 6, ("timestamp", "partition", "offset"))
    for part in files[:3]:
        append(part, path)
    wide(spark, t, path, status)
    forget_commit(path, 2, last=2)
    for part in files[3:]:
        append(part, path)
    got = wide(spark, t, path, status)
    want = order_wide(accepted(parse_orders(records)), before, fx.provinces(t.nation), enriched_users(t))
    assert rows(got, *schemas.ORDER_WIDE_COLUMNS) == rows(want, *schemas.ORDER_WIDE_COLUMNS)
    firsts = want.filter("if_first_order = '1'").selectExpr("CAST(user_id AS STRING)", "'1' AS if_consumed", "id")
    assert rows(status.read(spark)) == rows(before.union(firsts))


def test_known_new_and_bad_orders_in_one_batch(spark, t, path, records, rows):
    status = KeyedTable(f"{path}/status", schemas.USER_STATUS, ("user_id",))

    def order(id, user, time="2024-01-01 00:00:00"):
        return json.dumps({"id": id, "user_id": user, "create_time": time})

    append(records(order(1, 1), order(1, 1), order(2, 1, "2024-01-02 00:00:00"), "{bad", order(3, 2, "2024-01-01")), path)
    append(records(order(4, 1, "2023-01-01 00:00:00"), order(5, 3)), path)
    got = wide(spark, t, path, status)
    assert rows(got, "id", "if_first_order") == [(1, "0"), (1, "1"), (2, "0"), (4, "0"), (5, "1")]
    assert rows(status.read(spark)) == [("1", "1", 1), ("3", "1", 5)]
    rejects = batches.read_batches(spark, f"{path}/rejects", schemas.REJECT)
    assert rows(rejects, "offset", "reason") == [(3, "bad_json"), (4, "bad:create_time")]


def test_user_dimension_takes_the_last_arrival(spark, path, records, rows):
    target = KeyedTable(f"{path}/user", schemas.USER, ("id",))

    def user(id, level, gender="M"):
        return json.dumps({"id": id, "user_level": level, "birthday": "1990-01-01", "gender": gender})

    def update():
        run(start_dim_user, spark, path, table=target, rejects_path=f"{path}/rejects",
            as_of=F.lit("2024-01-01").cast("timestamp"), snapshot_every=1)
        return rows(target.read(spark), "id", "user_level", "age_group", "gender_name")

    append(records(user("1", "a"), user("2", "a", None), user("1", "b")), path)
    assert update() == [("1", "b", "30岁及以上", "男"), ("2", "a", "30岁及以上", "女")]
    append(records(user("2", "c"), "{bad"), path)
    assert update() == [("1", "b", "30岁及以上", "男"), ("2", "c", "30岁及以上", "男")]
    assert batches.read_batches(spark, f"{path}/rejects", schemas.REJECT).count() == 1


def test_province_dimension(spark, t, path, rows):
    target = KeyedTable(f"{path}/province", schemas.PROVINCE, ("id",))
    append(fx.dim_records("ods_base_province", fx.provinces(t.nation)), path)
    run(start_dim_province, spark, path, table=target, rejects_path=f"{path}/rejects")
    assert rows(target.read(spark)) == rows(fx.provinces(t.nation))


def test_logs_land_raw_and_split(spark, path, records, rows):
    texts = [log("a", 1), '{"ts": 1,  "x": 1.50}', "{bad", "plain words", "天"]
    append(records(*texts), path)
    run(start_log_landing, spark, path, path=f"{path}/landed")
    landed = spark.read.schema("value STRING, dt STRING").text(f"{path}/landed")
    assert rows(landed, "value") == sorted(((x,) for x in texts), key=repr)
    assert {r["dt"] for r in landed.collect()} == {"2023-11-14"}
    start_log_split(file_topic(spark, f"{path}/topic"), f"{path}/split", f"{path}/c2", ONCE).awaitTermination()
    split = file_topic_batch(spark, f"{path}/split")
    assert rows(split, "offset", "topic") == [
        (0, "log_start"), (1, "log_event"), (2, "rejects"), (3, "rejects"), (4, "rejects"),
    ]
    assert rows(split, "value") == rows(landed, "value")
    only_start = file_topic(spark, f"{path}/split").filter("topic = 'log_start'")
    start_dau(only_start, f"{path}/index", f"{path}/rejects", f"{path}/c3", trigger=ONCE).awaitTermination()
    assert rows(batches.read_daily_active(spark, f"{path}/index", schemas.DAU), "mid") == [("a",)]


def file_topic_batch(spark, path):
    return spark.read.schema(schemas.TOPIC).parquet(path)
