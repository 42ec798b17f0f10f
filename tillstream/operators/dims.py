"""Province and user dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.users import age_group, age_years, gender_name
from tillstream.operators.records import parse_typed
from tillstream.schemas import PROVINCE_FIELDS, USER_FIELDS


def parse_provinces(records: DataFrame) -> DataFrame:
    return parse_typed(records, PROVINCE_FIELDS, required=["id"])


def parse_users(records: DataFrame) -> DataFrame:
    """A birthday that is no date is rejected, since no age follows from it."""
    users = parse_typed(records, USER_FIELDS, required=["id", "birthday"])
    unreadable = F.col("reason").isNull() & F.col("birthday").try_cast("date").isNull()
    return users.withColumn("reason", F.when(unreadable, "bad:birthday").otherwise(F.col("reason")))


def enrich_users(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Adds `age`, `age_group` and `gender_name`."""
    now = F.current_timestamp() if as_of is None else as_of
    return (
        users.withColumn("age", age_years(F.col("birthday"), now))
        .withColumn("age_group", age_group(F.col("age")))
        .withColumn("gender_name", gender_name(F.col("gender")))
    )
