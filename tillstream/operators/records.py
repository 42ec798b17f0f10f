"""JSON messages to rows. What cannot be read is kept, marked with a reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

REJECTS_TOPIC = "rejects"
CARRIED = ["topic", "partition", "offset", "timestamp", "value"]


def parse_once(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Add a parsed document as a column that is computed exactly once per row.

    A generator of one element: the optimizer moves filters on the document's fields below a
    plain projection, and would parse the text again for every field tested there.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def one_object(value: Column, schema: str) -> Column:
    """The text as one JSON object; null if it is none or if anything but white space follows it.

    Spark's reader stops after the first object of a text. In an array it has to read on to the end.
    """
    several = F.from_json(F.concat(F.lit("["), value, F.lit("]")), f"ARRAY<STRUCT<{schema}>>")
    return F.when((F.size(several) == 1) & value.rlike(r"^\s*\{[\s\S]*\}\s*$"), several[0])


def parse_typed(
    records: DataFrame, fields: Mapping[str, str], required: Sequence[str], keep: Sequence[str] = CARRIED
) -> DataFrame:
    """`value` -> the given fields by name, plus the carried record columns and `reason`.

    Fields are read as text and cast, so quoted and bare numbers both work. `reason` is null
    for a good row, else `bad_json` or `missing:<field>`.
    """
    schema = ", ".join(f"{name} STRING" for name in fields) + ", _corrupt_record STRING"
    parsed = parse_once(records.select(*keep), one_object(F.col("value"), schema), "_j")
    typed = parsed.select(
        *[F.col(c) for c in keep if c not in fields],
        *[F.col(f"_j.{name}").try_cast(kind).alias(name) for name, kind in fields.items()],
        (F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull()).alias("_bad"),
    )
    reason = F.when(F.col("_bad"), "bad_json")
    for name in required:
        reason = reason.when(F.col(name).isNull(), f"missing:{name}")
    return typed.withColumn("reason", reason).drop("_bad")


def text_of_rejects_only(df: DataFrame) -> DataFrame:
    """Drop the message text of good rows, before they are kept or shuffled."""
    return df.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull()).drop("reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull()).select("topic", "partition", "offset", "value", "reason")
