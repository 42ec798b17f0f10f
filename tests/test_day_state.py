"""Daily actives whose state ends with its day: same rows as the batch, nothing written twice, state let go."""

import json
import time

import pytest

from tillstream import schemas
from tillstream.checks import fixtures as fx
from tillstream.checks.queries import Tables
from tillstream.plans.daily_active import daily_active
from tillstream.session import scratch_dir
from tillstream.sinks import batches
from tillstream.sources.topics import file_topic
from tillstream.streaming.daily_active import start_dau
from tillstream.streaming.day_state import DAY_MS, HOUR_MS, closes_at
from test_streams import ONCE, append, forget_commit, in_files

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "days")


def log(mid, ts):
    return json.dumps({"ts": ts, "common": {"mid": mid, "uid": "u"}, "start": {"entry": "icon"}})


def dau(spark, path, open_hours, checkpoint="checkpoint", **kwargs):
    topic = file_topic(spark, f"{path}/topic", max_files_per_trigger=1)
    query = start_dau(
        topic, f"{path}/index", f"{path}/rejects", f"{path}/{checkpoint}", trigger=ONCE, open_hours=open_hours, **kwargs
    )
    query.awaitTermination()
    return query


def written(spark, path):
    return spark.read.schema(schemas.DAU).parquet(f"{path}/index")


def test_closing_times():
    noon = 19_723 * DAY_MS + DAY_MS // 2  # 2024-01-01
    assert closes_at("2024-01-01", noon, 6) == 19_724 * DAY_MS + 6 * HOUR_MS
    assert closes_at("2024-01-02", noon, 6) == 19_725 * DAY_MS + 6 * HOUR_MS
    assert closes_at("2023-05-01", noon, 6) == noon + 6 * HOUR_MS
    assert closes_at("2099-01-01", noon, 6) == noon + 2 * DAY_MS + 6 * HOUR_MS


def test_replay_equals_batch_across_restart_and_repeat(spark, path, rows):
    starts = fx.start_log_records(Tables(spark, FOLDER).events)
    order = ("timestamp", "partition", "offset")
    files = in_files(starts, 4, order)
    for part in files[:2]:
        append(part, path, order)
    query = dau(spark, path, 6)
    last = query.lastProgress["batchId"]
    forget_commit(path, 1, last=last)
    for part in files[2:]:
        append(part, path, order)
    dau(spark, path, 6)
    found = batches.read_daily_active(spark, f"{path}/index", schemas.DAU)
    assert rows(found, *schemas.DAU_COLUMNS) == rows(daily_active(starts), *schemas.DAU_COLUMNS)
    assert written(spark, path).count() == found.count()


def test_state_of_closed_days_goes_and_a_device_that_returns_is_not_written_twice(spark, path, records, rows):
    day = 1_700_000_000_000
    for mids in ("ab", "c", "d", "abx", "y"):
        append(records(*[log(m, day) for m in mids]), path)
        time.sleep(0.1)
        query = dau(spark, path, 0)
    assert rows(written(spark, path), "mid") == [(m,) for m in "abcdxy"]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4  # of the last batches' devices, not of all six


def test_a_new_checkpoint_starts_from_the_index(spark, path, records, rows):
    now = int(time.time() * 1000)
    append(records(log("a", now), log("a", now + 1), log("b", now), "broken"), path)
    dau(spark, path, 48)
    append(records(log("b", now + 2), log("c", now), log("a", now + DAY_MS * 400)), path)
    dau(spark, path, 48, checkpoint="new", first_batch=100)
    assert rows(written(spark, path), "mid") == [("a",), ("a",), ("b",), ("c",)]
    assert len({r.dt for r in written(spark, path).filter("mid = 'a'").collect()}) == 2
