import datetime
import json

from pyspark.sql import functions as F

from tillstream.functions import users
from tillstream.functions.times import date_part, hour_part, previous_day
from tillstream.operators.dims import enrich_users, parse_provinces, parse_users
from tillstream.operators.records import accepted, rejected

NOW = datetime.datetime(2024, 1, 1)


def born(years, extra_days=0):
    return (NOW - datetime.timedelta(days=365 * years + extra_days)).strftime("%Y-%m-%d")


def test_age_in_365_day_years_and_its_group(spark, rows):
    df = spark.createDataFrame(
        [(born(19, 364),), (born(20),), (born(30),), (born(30, 364),), (born(31),), ("2030-01-01",), ("2024-06-01",),
         (None,), ("soon",)],
        "birthday STRING",
    )
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    out = df.withColumn("age", users.age_years(F.col("birthday"), now)).withColumn("g", users.age_group(F.col("age")))
    got = {r["birthday"]: (r["age"], r["g"]) for r in out.collect()}
    assert got == {
        born(19, 364): (19, "20岁及以下"), born(20): (20, "在20岁和30岁之间"), born(30): (30, "在20岁和30岁之间"),
        born(30, 364): (30, "在20岁和30岁之间"), born(31): (31, "30岁及以上"), "2030-01-01": (-6, "20岁及以下"),
        "2024-06-01": (0, "20岁及以下"), None: (None, None), "soon": (None, None),
    }


def test_gender(spark, rows):
    df = spark.createDataFrame([("M",), ("F",), ("m",), ("",), (None,)], "g STRING")
    assert rows(df, users.gender_name(F.col("g"))) == [("女",), ("女",), ("女",), ("女",), ("男",)]


def test_user_records(records, rows):
    good = {"id": 7, "user_level": "1", "birthday": "1990-01-01", "gender": "M"}
    parsed = parse_users(records(
        json.dumps(good), json.dumps({**good, "birthday": None}), json.dumps({**good, "birthday": "x"}),
        json.dumps({**good, "id": None}), "{bad",
    ))
    assert rows(rejected(parsed), "offset", "reason") == [
        (1, "missing:birthday"), (2, "bad:birthday"), (3, "missing:id"), (4, "bad_json"),
    ]
    user = enrich_users(accepted(parsed), F.lit("2024-01-01").cast("timestamp")).head()
    assert (user["id"], user["age"], user["age_group"], user["gender_name"]) == ("7", 34, "30岁及以上", "男")


def test_province_records(records, rows):
    parsed = parse_provinces(records('{"id":"1","name":"n","area_code":"a","iso_code":"i","more":2}', "{}"))
    assert rows(accepted(parsed), "id", "name", "area_code", "iso_code") == [("1", "n", "a", "i")]
    assert rows(rejected(parsed), "reason") == [("missing:id",)]


def test_previous_day(spark, rows):
    df = spark.createDataFrame([("2024-03-01",), ("2023-03-01",), ("2024-01-01",)], "d STRING")
    assert rows(df, previous_day(F.col("d"))) == [("2023-02-28",), ("2023-12-31",), ("2024-02-29",)]


def test_time_parts(spark, rows):
    df = spark.createDataFrame([("2021-12-13 10:30:20",), ("2021-12-13",), (None,), ("",)], "t STRING")
    got = rows(df, date_part(F.col("t")), hour_part(F.col("t")))
    assert got == [("", None), ("2021-12-13", "10"), ("2021-12-13", None), (None, None)]
