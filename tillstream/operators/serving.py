"""Reports over the daily-active table (one row per day and device)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.times import previous_day

# Metric ids and display names.
DAU_METRIC = ("dau", "新增日活")
NEW_DEVICE_METRIC = ("new_mid", "新增设备")


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """One row: the day's devices, 0 for a day without any."""
    return dau.filter(F.col("dt") == date).agg(F.count(F.lit(1)).alias("total"))


def dau_by_hour(dau: DataFrame) -> DataFrame:
    """Devices per day and hour of first open; hours without any are absent."""
    return dau.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n"))


def earlier_opens(opens: DataFrame, known: DataFrame, order: Sequence[str]) -> DataFrame:
    """Opens, one per day and device, that come before what is known of the device's day, by `order`; with `known_hr`, the
    hour known so far, null for a device new on that day."""
    before = known.select("dt", "mid", F.col("hr").alias("known_hr"), F.struct(*order).alias("_known"))
    joined = opens.join(before, ["dt", "mid"], "left")
    return joined.filter(F.col("_known").isNull() | (F.struct(*order) < F.col("_known"))).drop("_known")


def hourly_changes(moved: DataFrame) -> DataFrame:
    """What `earlier_opens` change in the counts per day and hour: one more in the new hour, one less in the known one."""
    both = F.array_compact(F.array(
        F.struct("hr", F.lit(1).alias("n")),
        F.when(F.col("known_hr").isNotNull(), F.struct(F.col("known_hr").alias("hr"), F.lit(-1).alias("n"))),
    ))
    each = moved.select("dt", F.explode(both).alias("c")).select("dt", "c.hr", "c.n")
    return each.groupBy("dt", "hr").agg(F.sum("n").alias("change")).filter("change <> 0")


def hour_map(hourly: DataFrame, date: str) -> DataFrame:
    """One row: hour -> count of a day. At most 24 entries."""
    entries = F.collect_list(F.struct("hr", "n"))
    return hourly.filter(F.col("dt") == date).agg(F.map_from_entries(entries).alias("hours"))


def day_over_day(dau: DataFrame, date: str) -> DataFrame:
    """Hours of a day and of the day before, side by side; null where a day has no such hour.

    Both days are counted in one pass over the two partitions, so no join is needed.
    """
    before = previous_day(F.lit(date))
    counts = dau.filter(F.col("dt").isin(F.lit(date), before)).groupBy("hr").agg(
        F.count_if(F.col("dt") == date).alias("today"),
        F.count_if(F.col("dt") == before).alias("yesterday"),
    )
    return counts.select(
        "hr", F.nullif("today", F.lit(0)).alias("today"), F.nullif("yesterday", F.lit(0)).alias("yesterday")
    )


def day_over_day_map(dau: DataFrame, date: str) -> DataFrame:
    """One row: `today` and `yesterday` maps of hour -> count."""
    side = day_over_day(dau, date)

    def as_map(name: str):
        pairs = F.collect_list(F.when(F.col(name).isNotNull(), F.struct("hr", F.col(name).alias("n"))))
        return F.map_from_entries(pairs).alias(name)

    return side.agg(as_map("today"), as_map("yesterday"))


def first_seen(dau: DataFrame) -> DataFrame:
    """First active day of each device. Compared as dates, which aggregate in place."""
    return dau.groupBy("mid").agg(F.min(F.to_date("dt")).alias("first_day")).select(
        "mid", F.date_format("first_day", "yyyy-MM-dd").alias("first_dt")
    )


def _metric(rows: DataFrame, value: Column, label: tuple[str, str]) -> DataFrame:
    return rows.agg(value.alias("value")).select(F.lit(label[0]).alias("id"), F.lit(label[1]).alias("name"), "value")


def realtime_totals(dau: DataFrame, seen: DataFrame, date: str) -> DataFrame:
    """Metric rows `id, name, value`: devices of the day, and devices never seen before it."""
    n = F.count(F.lit(1))
    new = seen.filter(F.col("first_dt") == date)
    return _metric(dau.filter(F.col("dt") == date), n, DAU_METRIC).union(_metric(new, n, NEW_DEVICE_METRIC))


def counted_totals(hourly: DataFrame, new: DataFrame, date: str) -> DataFrame:
    """The same from counts: `dt, hr, n` of devices per hour, `first_dt, n` of new devices per day."""
    n = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return _metric(hourly.filter(F.col("dt") == date), n, DAU_METRIC).union(
        _metric(new.filter(F.col("first_dt") == date), n, NEW_DEVICE_METRIC)
    )
