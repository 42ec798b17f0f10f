"""Start logs to the daily-active table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillstream.operators.logs import dau_first_open, dau_record, derive_dt_hr, parse_app_log
from tillstream.operators.records import accepted


def daily_active(start_records: DataFrame) -> DataFrame:
    """Topic records of start logs -> one daily-active record per day and device."""
    logs = derive_dt_hr(accepted(parse_app_log(start_records)))
    return dau_record(dau_first_open(logs))
