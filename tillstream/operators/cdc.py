"""Database change messages split into one topic per table. Narrow plans, one JSON parse per message.

Row data is held as VARIANT between parsing and writing, which keeps decimal amounts exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.operators.records import REJECTS_TOPIC, parse_once

TOPIC_PREFIX = "ods_"

# Tables passed on, by kind.
FACT_TABLES = ["order_info", "order_detail"]
DIM_TABLES = ["base_province", "user_info", "sku_info", "base_trademark", "base_category3", "spu_info"]


def _envelope(records: DataFrame, data_type: str) -> DataFrame:
    """Adds `_e`, a struct of type, table and data; null for what is no JSON object."""
    shape = f"struct<type: string, table: string, data: {data_type}>"
    # In an array, as a parser of one object does not look at what follows it.
    listed = parse_once(records, F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))), "_v")
    single = F.col("value").rlike(r"^\s*\{[\s\S]*\}\s*$") & F.try_variant_get("_v", "$[1]", "variant").isNull()
    return parse_once(listed, F.when(single, F.try_variant_get("_v", "$[0]", shape)), "_e").drop("_v")


def _to_topic(df: DataFrame, bad) -> DataFrame:
    return df.select(
        F.when(bad, REJECTS_TOPIC).otherwise(F.concat(F.lit(TOPIC_PREFIX), "_e.table")).alias("topic"),
        "partition", "offset", "key",
        F.when(bad, F.col("value")).otherwise(F.col("_row")).alias("value"),
        "timestamp",
    )


def canal_route(records: DataFrame) -> DataFrame:
    """`{type, table, data: [row, ...]}` -> one message per inserted row on `ods_<table>`.

    Only type `INSERT`, in upper case, passes; other types are dropped. Unreadable messages, and
    inserts without a table or data array, go to the rejects topic.
    """
    bad = F.col("_e").isNull() | F.col("_e.table").isNull() | F.col("_e.data").isNull()
    rows = (
        F.when(F.col("_e").isNotNull() & ~F.col("_e.type").eqNullSafe("INSERT"), F.array().cast("array<string>"))
        .when(bad, F.array("value"))
        .otherwise(F.transform("_e.data", lambda row: F.to_json(row)))
    )
    return _to_topic(_envelope(records, "array<variant>").select("*", F.explode(rows).alias("_row")), bad)


def maxwell_route(records: DataFrame, drop_deletes: bool = False) -> DataFrame:
    """`{type, table, data: row}` -> the row on `ods_<table>` for the tables passed on.

    Facts pass on `insert`, in lower case; dimensions on any type, deletes too unless
    `drop_deletes`. Empty or absent data is dropped. Unreadable messages, and data without a
    table, go to the rejects topic.
    """
    table, kind = F.col("_e.table"), F.col("_e.type")
    dim = table.isin(DIM_TABLES)
    if drop_deletes:
        dim = dim & ~kind.eqNullSafe("delete")
    wanted = table.isNull() | dim | (table.isin(FACT_TABLES) & kind.eqNullSafe("insert"))
    # Rows are put back to text only for the messages wanted; emptiness shows in the text.
    row = F.when(F.col("_e").isNull(), F.array("value")).when(wanted, F.array(F.to_json("_e.data")))
    exploded = _envelope(records, "variant").select("*", F.explode(row).alias("_row"))
    filled = F.col("_row").startswith("{") & (F.col("_row") != "{}")
    return _to_topic(exploded.filter(F.col("_e").isNull() | filled), table.isNull())
