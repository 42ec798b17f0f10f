"""Application logs: parse, date, route, and each device's first open of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions.times import day_of_millis, hour_of_millis, valid_millis
from tillstream.operators.keyed import first_per_key
from tillstream.operators.records import REJECTS_TOPIC, one_object, parse_once
from tillstream.schemas import APP_LOG_JSON

START_TOPIC = "log_start"
EVENT_TOPIC = "log_event"
COMMON = ["mid", "uid", "ar", "ch", "vc"]
RECORD = ["topic", "partition", "offset", "timestamp", "value"]


def parse_app_log(records: DataFrame) -> DataFrame:
    """Topic records -> `ts`, the `common` fields, `start` (JSON text, null if absent) and `reason`."""
    parsed = parse_once(records.select(*RECORD), one_object(F.col("value"), APP_LOG_JSON), "_j")
    fields = parsed.select(
        *RECORD,
        F.col("_j.ts").try_cast("bigint").alias("ts"),
        *[F.col(f"_j.common.{name}").alias(name) for name in COMMON],
        F.col("_j.start").alias("start"),
        (F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull()).alias("_bad"),
    )
    reason = (
        F.when(F.col("_bad"), "bad_json")
        .when(F.col("ts").isNull(), "missing:ts")
        .when(~valid_millis(F.col("ts")), "bad:ts")
        .when(F.col("mid").isNull(), "missing:mid")
    )
    return fields.withColumn("reason", reason).drop("_bad")


def derive_dt_hr(logs: DataFrame) -> DataFrame:
    return logs.withColumns({"dt": day_of_millis(F.col("ts")), "hr": hour_of_millis(F.col("ts"))})


def dau_record(logs: DataFrame) -> DataFrame:
    """The nine-column daily-active record; minutes are always `00`."""
    return logs.select(*COMMON, "dt", "hr", F.lit("00").alias("mi"), "ts")


def route_app_log(records: DataFrame) -> DataFrame:
    """Same messages with `topic` set: start logs, event logs, or rejects for what is no JSON object."""
    start = one_object(F.col("value"), "start STRING, _corrupt_record STRING")
    topic = (
        F.when(F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull(), REJECTS_TOPIC)
        .when(F.col("_j.start").isNotNull(), START_TOPIC)
        .otherwise(EVENT_TOPIC)
    )
    return parse_once(records, start, "_j").withColumn("topic", topic).drop("_j")


def dau_first_open(logs: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """First log of each device and day: smallest `(ts, *tie_break)`."""
    return first_per_key(logs, ["dt", "mid"], ["ts", *(tie_break or ["partition", "offset"])])
