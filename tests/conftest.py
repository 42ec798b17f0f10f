from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tillstream import schemas  # noqa: E402
from tillstream.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def records(spark):
    """Topic records from texts: offset = position in the list."""
    def make(*values, topic="t", partition=0):
        rows = spark.createDataFrame(
            [(topic, partition, i, None, value, 1_700_000_000 + i) for i, value in enumerate(values)],
            "topic STRING, partition INT, offset BIGINT, key STRING, value STRING, seconds BIGINT",
        )
        columns = [c for c in schemas.TOPIC_COLUMNS if c != "timestamp"]
        return rows.selectExpr(*columns, "timestamp_seconds(seconds) AS timestamp")
    return make


@pytest.fixture
def rows():
    """Rows as sorted plain tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
    return collect
