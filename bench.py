"""Times registered queries on local cores and prints one JSON line.

All registered queries of the reference's operators. Each is run once to warm up and then BENCH_RUNS times (3 by
default); its figure is the median. Results go to
the `noop` sink, which computes every row and column and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillstream.checks import fixtures as fx  # noqa: E402
from tillstream.checks.queries import REGISTRY, Tables  # noqa: E402
from tillstream.session import session  # noqa: E402

# What a stream reads, which is not the whole table: start logs, and orders of the batch.
STREAMS = {
    "start_dau": lambda t: fx.start_log_records(t.events), "start_order_wide": lambda t: fx.order_batch(t.orders),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(REGISTRY)
    spark = session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        begin = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    timings = {}
    for name in names:
        seconds(name)
        timings[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    rates = {
        name: round(records(Tables(spark, folder)).count() / timings[name])
        for name, records in STREAMS.items() if name in timings
    }
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(folder).name, "cpus": int(cpus), "stream_input_rows_per_sec": rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
