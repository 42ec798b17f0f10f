"""Bucketed tables, two-level lookups, folded days, the inverted index, clustered documents, numbering by ranges."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tillstream import fs, schemas
from tillstream.operators.docs import doc_match
from tillstream.operators.joins import bloom_filter, in_list_lookup
from tillstream.operators.orders import group_orders_by_user
from tillstream.session import scratch_dir
from tillstream.sinks import batches
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sinks.search_index import SearchIndex
from tillstream.sources.lookups import point_get, write_clustered

INDEX = "mid STRING, dt STRING"


def keyed(spark, buckets=16):
    return KeyedTable(scratch_dir(spark, "bucketed"), "id STRING, v STRING", ("id",), buckets)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_against_a_dictionary(spark, rows):
    draw, table, now, before = random.Random(3), keyed(spark), {}, {}
    for batch in range(7):
        new = {f"k{draw.randrange(60)}": f"b{batch}-{k}" for k in range(draw.choice([0, 3, 40]))}
        before[batch] = dict(now)
        now.update(new)
        for _ in range(2):  # a repeated batch
            table.upsert(spark.createDataFrame(list(new.items()), table.schema), batch)
        if batch in (2, 3, 5):
            table.snapshot(spark, batch - 1)
        assert dict(rows(table.read(spark))) == now
        assert dict(rows(table.read(spark, before=batch))) == before[batch]


def test_a_snapshot_writes_changed_buckets_only(spark, rows):
    table = keyed(spark)
    table.upsert(spark.range(500).selectExpr("'k' || id AS id", "'a' AS v"), 0)
    table.snapshot(spark, 0)
    table.upsert(spark.createDataFrame([("k1", "b"), ("new", "c")], table.schema), 1)
    table.snapshot(spark, 1)
    assert len(fs.numbered(spark, f"{table.root}/snapshots/batch_id=0", "bucket")) == 16
    assert len(fs.numbered(spark, f"{table.root}/snapshots/batch_id=1", "bucket")) <= 2
    table.upsert(spark.createDataFrame([("k1", "d")], table.schema), 2)
    table.snapshot(spark, 2)
    kept = fs.numbered(spark, f"{table.root}/snapshots/batch_id=0", "bucket")
    assert len(kept) in (14, 15)  # what batch 1 replaced is gone, the rest still counts
    found = dict(rows(table.read(spark)))
    assert len(found) == 501 and found["k1"] == "d" and found["new"] == "c" and found["k2"] == "a"


def test_a_lookup_reads_the_buckets_of_its_keys(spark, rows):
    table = keyed(spark, buckets=64)
    table.upsert(spark.range(2_000).selectExpr("CAST(id AS STRING) AS id", "'v' || id AS v"), -1)
    few = spark.createDataFrame([(5,), (5,), (1_999,), (None,), (77_777,)], "user BIGINT")
    found = table.lookup(few, [F.col("user")])
    assert rows(found) == [("1999", "v1999"), ("5", "v5")]
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(", plan(found))
    assert len(table.buckets_of(few, F.col("user"))) <= 4
    read = {re.search(r"bucket=(\d+)", f)[1] for f in found.inputFiles() if "bucket=" in f}
    assert len(read) <= 4  # of 64
    everybody = spark.range(0, 4_000, 3).withColumnRenamed("id", "user")
    assert len(rows(table.lookup(everybody, [F.col("user")]))) == 667


def test_no_key_is_lost_by_the_filter(spark, rows):
    draw = random.Random(1)
    store = spark.createDataFrame([(str(k), k) for k in range(5_000)] + [(None, -1)], "id STRING, v INT")
    for n in (0, 1, 50, 3_000):
        keys = draw.sample(range(10_000), n)
        batch = spark.createDataFrame([(k,) for k in [*keys, *keys[:5]]] + [(None,)], "k BIGINT")
        assert [v for _, v in rows(in_list_lookup(store, batch, "id", "k"))].__len__() == sum(k < 5_000 for k in keys)
        held = bloom_filter(batch, "k", bits=1 << 15)
        passed = {r["v"] for r in store.filter(held(F.col("id"))).collect()}
        assert {k for k in keys if k < 5_000} <= passed and (n != 50 or len(passed) < 100)


def write_days(spark, root):
    for batch, pairs in enumerate([[("a", "d1"), ("b", "d1")], [("c", "d1"), ("z", "d2")], [("d", "d1"), ("a", "d1")]]):
        batches.write_day_index(spark.createDataFrame(pairs, INDEX), root, batch)


WHOLE = [("a", "d1"), ("b", "d1"), ("c", "d1"), ("d", "d1"), ("z", "d2")]


@pytest.mark.parametrize("key", ["mid", None])
@pytest.mark.parametrize("step", [*range(13)])
def test_a_crash_at_any_step_of_a_fold_loses_and_doubles_nothing(spark, rows, monkeypatch, key, step):
    """The fold stops before its n-th change of folders; readers see all rows, and the next fold finishes the work."""
    root = scratch_dir(spark, "fold")
    write_days(spark, root)
    want = WHOLE if key else sorted([*WHOLE, ("a", "d1")])

    def read():
        if key:
            return rows(batches.read_day_index(spark, root, INDEX, key, first=True))
        return rows(batches._day_rows(spark, root, INDEX, "dt").select("mid", "dt"))

    left = [step]

    def stopping(name):
        real = getattr(fs, name)

        def call(*args):
            if left[0] == 0:
                raise OSError("crash")
            left[0] -= 1
            return real(*args)

        return call

    with monkeypatch.context() as patch:
        for name in ("delete_dir", "make_dir", "rename"):
            patch.setattr(fs, name, stopping(name))
        try:
            batches.compact_day(spark, root, INDEX, "d1", key, first=True)
            crashed = False
        except OSError:
            crashed = True
    assert read() == want and crashed == (step < 12)
    batches.compact_day(spark, root, INDEX, "d1", key, first=True)
    assert read() == want
    assert fs.numbered(spark, f"{root}/dt=d1", "batch_id") == [0] and fs.named(spark, f"{root}/_folds", "dt") == []


def test_closed_days_are_folded(spark, rows):
    root = scratch_dir(spark, "closed")
    write_days(spark, root)
    batches.fold_closed_days(spark, root, INDEX, "mid", open_days=1, before=2, first=True)
    assert fs.numbered(spark, f"{root}/dt=d1", "batch_id") == [0, 2] and fs.numbered(spark, f"{root}/dt=d2", "batch_id") == [1]
    assert rows(batches.read_day_index(spark, root, INDEX, "mid", first=True)) == WHOLE


def test_the_index_finds_what_the_scan_finds(spark, rows):
    texts = ["red apple", "Red-Widget", "红色 apple", "widgets", "İzmir kebab", "ſtrasse", "STRASSE", "10km", None, "", "a_b", "K2", "ß"]
    first = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id BIGINT, name STRING")
    changed = spark.createDataFrame([(0, "green pear"), (99, "red plum")], "id BIGINT, name STRING")
    docs = first.filter("id <> 0").unionByName(changed)
    index = SearchIndex(scratch_dir(spark, "postings"))
    index.add(first, 0)
    for _ in range(2):
        index.add(changed, 1)
    for query in ("red", "apple widget", "红", "色 pear", "IZMIR", "strasse", "k2", "ss", "zzz", "", "--", "B"):
        assert rows(index.match(docs, query)) == rows(doc_match(docs, query)), query
    found = index.postings(spark, ["red"])
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+", plan(found)) and "PushedFilters: [IsNotNull(word), EqualTo(word,red)]" in plan(found)


def test_one_id_is_in_one_file(spark, rows):
    path = scratch_dir(spark, "clustered")
    docs = spark.range(1_000).selectExpr("(id * 37) % 1000 AS id", "'n' || id AS name")
    write_clustered(docs, path, files=5)
    stored = spark.read.parquet(path)
    assert len(stored.inputFiles()) == 5
    spans = stored.groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))
    assert rows(point_get(stored, 74)) == [(74, "n2")]
    assert "EqualTo(id,74)" in plan(point_get(stored, 74))


def test_orders_of_one_user_and_day_are_spread_over_tasks(spark):
    draw = random.Random(2)
    facts = [
        (k, 7 if k % 3 == 0 else draw.choice([None, *range(20)]), draw.choice([None, "2024-01-01", "2024-01-01", "2024-01-02"]),
         f"2024-01-01 {draw.randrange(24):02d}:00:00") for k in range(3_000)
    ]
    df = spark.createDataFrame(facts, "id BIGINT, user_id BIGINT, create_date STRING, create_time STRING")
    path = scratch_dir(spark, "numbered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = group_orders_by_user(df, span=100, path=path).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    mine = {}
    for k, user, date, time in facts:
        mine.setdefault(user, []).append((date or "", time, k))
    want = {}
    for user, orders in mine.items():
        ids = [k for _, _, k in sorted(orders)]
        for part in range(0, len(ids), 100):
            want[user, part // 100] = (len(ids), sorted(ids[part:part + 100]))
    assert {(r["user_id"], r["part"]): (r["n_orders"], sorted(o["id"] for o in r["orders"])) for r in got} == want
    spread = spark.read.parquet(path).filter("user_id = 7").select(F.input_file_name()).distinct().count()
    assert spread > 1
    assert group_orders_by_user(df.limit(0)).count() == 0
