"""First opens with a state that ends with its day: timers for each day and device, seeded from the index."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def closes_at(day: str, now: int, open_hours: int) -> int:
    """When the state of a day goes, in milliseconds of the processing's clock: `open_hours` after its end. Of days
    gone by at `now` it stays `open_hours`; that of days far ahead, of wrong device clocks, goes as if they were tomorrow."""
    start = (date.fromisoformat(day) - date(1970, 1, 1)).days * DAY_MS
    return min(max(start + DAY_MS, now), now + 2 * DAY_MS) + open_hours * HOUR_MS


def is_closed(day: Column, open_hours: int) -> Column:
    """Whether the state of a day may be gone: the day is closed, or was far ahead when it was seen first."""
    end = F.to_timestamp(day, "yyyy-MM-dd") + F.make_dt_interval(hours=F.lit(24 + open_hours))
    return (F.current_timestamp() >= end) | (F.to_date(day) > F.date_add(F.current_date(), 1))


class FirstOfDay(StatefulProcessor):
    """Passes the first row of a day and device, and remembers it until the day closes. Rows carry `_now`, the time of
    their batch; timers go by a watermark that follows it `open_hours` behind."""

    def __init__(self, columns: list[str]):
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._seen = handle.getValueState("seen", "until BIGINT")

    def _remember(self, key: tuple, now: int) -> None:
        until = closes_at(key[0], now, 0)
        self._seen.update((until,))
        self._handle.registerTimer(until)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self._seen.exists():
            first = next(rows)
            self._remember(key, first["_now"])
            yield Row(**{c: first[c] for c in self._columns})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._seen.clear()
        return iter(())

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        if not self._seen.exists():
            self._remember(key, initialState["_now"])

    def close(self) -> None:
        pass


def first_of_days(logs: DataFrame, known: DataFrame, open_hours: int) -> DataFrame:
    """The first arrival of each day and device (`dt, mid`, neither null). `known` holds the days and devices of open days
    that an earlier stream found; it is read once, when a checkpoint begins."""
    now = F.unix_millis(F.current_timestamp()).alias("_now")
    rows = logs.select("*", now, F.current_timestamp().alias("_seen_at")).withWatermark("_seen_at", f"{open_hours} hours")
    before = known.select("dt", "mid", now).groupBy("dt", "mid")
    return rows.groupBy("dt", "mid").transformWithState(FirstOfDay(logs.columns), logs.schema, "Append", "EventTime", before)
