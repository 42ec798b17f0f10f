"""Counts kept by a stream against a recount of all logs."""

import random

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.checks import queries
from tillstream.operators import serving
from tillstream.plans.daily_active import daily_active
from tillstream.session import scratch_dir
from tillstream.sinks import batches
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sinks.rollup import HourlyActives
from tillstream.sources.topics import file_topic
from tillstream.streaming.daily_active import start_first_seen, start_hourly
from test_streams import ONCE, append, forget_commit, log, run

HOUR = 3_600_000


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "rollup")


def count(spark, path, rollup, **kwargs):
    run(start_hourly, spark, path, rollup=rollup, **kwargs)
    return rollup.read(spark)


def test_late_logs_and_repeats_across_restart_and_repeated_batch(spark, path, records, rows):
    rng = random.Random(3)
    rollup = HourlyActives(f"{path}/rollup", buckets=3)
    everything = []

    def arrive(n):
        for _ in range(n):
            some = [log(f"m{rng.choice([0, rng.randrange(40)])}", rng.randrange(72) * HOUR + rng.randrange(3)) for _ in range(60)]
            part = records(*some, "{bad", log(None, 1)).withColumn("offset", F.col("offset") + 100 * len(everything))
            everything.append(part.persist())
            append(part, path)

    arrive(4)
    count(spark, path, rollup, snapshot_every=2)
    forget_commit(path, 2, last=3)
    arrive(3)
    got = count(spark, path, rollup, snapshot_every=2)
    union = everything[0]
    for part in everything[1:]:
        union = union.unionByName(part)
    want = daily_active(union)
    assert rows(got, "dt", "hr", "n") == rows(serving.dau_by_hour(want), "dt", "hr", "n")
    day = rollup.read(spark, ["1970-01-02"])
    assert rows(day, "hr", "n") == rows(serving.dau_by_hour(want).filter("dt = '1970-01-02'"), "hr", "n")
    files = {f.split("bucket=")[1].split("/")[0] for f in rollup.hours.read_days(spark, ["1970-01-02"]).inputFiles()}
    assert files == {"1"}, "a report reads its day's bucket"
    assert rows(rollup.devices.read(spark), "dt", "mid", "hr", "ts") == rows(want, "dt", "mid", "hr", "ts")


def test_an_earlier_open_moves_its_device(spark, path, records, rows):
    rollup = HourlyActives(f"{path}/rollup", buckets=2)
    append(records(log("a", 5 * HOUR), log("b", 5 * HOUR)), path)
    assert rows(count(spark, path, rollup), "hr", "n") == [("05", 2)]
    append(records(log("a", 3 * HOUR), log("b", 7 * HOUR), log("a", 5 * HOUR)), path)
    assert rows(count(spark, path, rollup), "hr", "n") == [("03", 1), ("05", 1)]
    append(records(log("b", 3 * HOUR), log("old", -HOUR)), path)
    assert [r for r in rows(count(spark, path, rollup), "dt", "hr", "n") if r[0] >= "1970"] == [("1970-01-01", "03", 2)]


def test_nothing_but_rejects(spark, path, records):
    rollup = HourlyActives(f"{path}/rollup")
    append(records("{bad", log(None, 1)), path)
    assert count(spark, path, rollup).count() == 0 and rollup.read(spark, ["2024-01-01"]).count() == 0


def test_a_batch_reads_the_days_it_holds(spark, path):
    table = KeyedTable(f"{path}/t", schemas.FIRST_OPEN, ("dt", "mid"), 4, day="dt")
    rows = spark.range(400).select(
        F.concat(F.lit("2024-01-0"), F.col("id") % 5 + 1).alias("dt"), F.concat(F.lit("m"), "id").alias("mid"),
        F.lit("00").alias("hr"), F.col("id").alias("ts"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
    )
    table.upsert(rows, 0)
    mine = rows.filter("dt = '2024-01-03'")
    found = table.lookup(mine, [F.col("dt"), F.col("mid")])
    assert found.count() == 80 and {r["dt"] for r in found.select("dt").collect()} == {"2024-01-03"}
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}) <= 4
    assert table.read_days(spark, ["2024-01-03"]).count() == 80


def test_new_devices_per_day(spark, path, rows):
    seen = KeyedTable(f"{path}/seen", schemas.FIRST_SEEN, ("mid",), 2)
    per_day = KeyedTable(f"{path}/per_day", "first_dt STRING, n BIGINT", ("first_dt",), 1, day="first_dt")
    rng = random.Random(5)
    base = {"uid": "u", "ar": "r", "ch": "c", "vc": "v", "hr": "00", "mi": "00"}
    for n in range(4):
        opens = {(f"2024-01-0{rng.randint(1, 9)}", f"m{rng.randrange(30)}") for _ in range(20)}
        some = [{**base, "mid": mid, "dt": dt, "ts": n} for dt, mid in sorted(opens)]
        batches.write_day_index(spark.createDataFrame(some, schemas.DAU), f"{path}/index", n)
        stream = batches.day_index_stream(spark, f"{path}/index", schemas.DAU)
        start_first_seen(stream, seen, f"{path}/c", snapshot_every=2, trigger=ONCE, per_day=per_day).awaitTermination()
    index = batches.read_daily_active(spark, f"{path}/index", schemas.DAU)
    want = serving.first_seen(index)
    assert rows(seen.read(spark)) == rows(want)
    assert rows(per_day.read(spark).filter("n <> 0")) == rows(want.groupBy("first_dt").agg(F.count("*").alias("n")))
    date = want.agg(F.min("first_dt").alias("d")).first()["d"]
    got = serving.counted_totals(serving.dau_by_hour(index), per_day.read_days(spark, [date]), date)
    assert rows(got) == rows(serving.realtime_totals(index, seen.read(spark), date))
    nothing = serving.counted_totals(serving.dau_by_hour(index), per_day.read_days(spark, ["2030-01-01"]), "2030-01-01")
    assert {r["value"] for r in nothing.collect()} == {0}


def test_a_large_part_of_the_query_s_topic_has_many_files_and_is_one_batch(spark, tmp_path, monkeypatch, rows):
    """No task of the query writes or parses a part by itself; the batches do not grow in number, the counts are the same."""
    folder = tmp_path / "tables"
    spark.range(900).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id * 97) AS ts", "id % 40 AS user_id", "'view' AS event_type",
    ).union(spark.sql("SELECT NULL, timestamp '2024-01-02 03:00:00', 5, 'view'")).write.parquet(f"{folder}/events.parquet")
    read = []
    update = HourlyActives.update
    monkeypatch.setattr(HourlyActives, "update", lambda self, opens, n: (read.append(opens.rdd.getNumPartitions()), update(self, opens, n))[1])
    want = rows(queries.REGISTRY["dau_by_hour"](spark, str(folder)))
    monkeypatch.setattr(queries, "FILE_ROWS", 20)
    assert rows(queries.REGISTRY["start_hourly"](spark, str(folder))) == want
    assert len(read) <= 5 and max(read) >= 4, read
