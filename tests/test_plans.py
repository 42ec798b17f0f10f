"""What the physical plans must look like, whatever the size of the data."""

import re

import pytest

import __spark_entry__ as entry_points

from tillstream.checks.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    def show(name):
        frame = entry_points.queries()[name](spark, FOLDER)
        return frame._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    return show


def nodes(text):
    return re.findall(r"^\((\d+)\) (\w+)", text, flags=re.M)


def count(text, node):
    return sum(1 for _, name in nodes(text) if name == node)


BATCH = [
    "parse_json_dynamic", "parse_json_typed", "derive_dt_hr", "dau_record", "user_age", "route_app_log", "cdc_canal_route",
    "cdc_maxwell_route", "doc_match", "doc_term_nested", "doc_highlight", "source_point_get", "previous_day",
]


@pytest.mark.parametrize("name", BATCH)
def test_row_wise_operators_do_not_shuffle(plan, name):
    assert "Exchange" not in plan(name)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_join_and_no_python(plan, name):
    text = plan(name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInArrow"):
        assert node not in text


@pytest.mark.parametrize("name", ["parse_json_dynamic", "parse_json_typed", "dau_by_hour", "cdc_maxwell_route"])
def test_messages_are_parsed_once(plan, name):
    text = plan(name)
    filters = re.findall(r"^\(\d+\) Filter.*?(?=^\(\d+\))", text, flags=re.M | re.S)
    assert filters and not any("from_json" in f or "parseJson" in f for f in filters)


def test_filters_and_columns_reach_the_scan(plan):
    text = plan("source_point_get")
    assert "EqualTo(id,42)" in text and "p_size" not in text
    text = plan("dau_by_hour")
    assert "EqualTo(event_type,view)" in text and "props" not in text
    text = plan("pipeline_order_wide")
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text and "o_orderpriority" not in text


def test_aggregates_combine_before_the_shuffle(plan):
    for name in ("dau_by_hour", "offsets_range", "pipeline_order_wide", "realtime_totals"):
        assert "partial_" in plan(name), name


def test_paging_keeps_a_page_per_task(plan):
    text = plan("doc_top_n")
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_day_over_day_needs_no_join(plan):
    assert "Join" not in plan("join_day_over_day")


def test_streaming_plans_have_no_python_but_for_repeats(spark):
    """What the streams run, as batch plans. Collapsing a device's repeats is the only step in Python."""
    from tillstream.checks import fixtures as fx
    from tillstream.checks.queries import Tables
    from tillstream.operators import cdc, logs, orders
    from tillstream.streaming.daily_active import first_opens
    t = Tables(spark, FOLDER)
    frames = {
        "canal": cdc.canal_route(fx.canal_records(t.orders)), "split": logs.route_app_log(fx.app_log_records(t.events)),
        "orders": orders.parse_orders(fx.order_records(t.orders)),
    }
    for name, frame in frames.items():
        text = frame._jdf.queryExecution().toString()
        assert not any(x in text for x in ("Python", "MapInArrow", "Exchange", "CartesianProduct")), name
    opens = first_opens(fx.start_log_records(t.stream("events")))._jdf.queryExecution().analyzed().toString()
    assert opens.count("MapInArrow") == 1 and "PythonUDF" not in opens


def test_first_orders_read_the_orders_few_times(plan):
    # the status table of these queries is made from the orders too: one scan more than the operator needs
    for name, scans in (("order_first_flag", 4), ("filter_first_orders", 2), ("pipeline_order_wide", 4)):
        text = plan(name)
        assert sum("orders.parquet" in x for x in re.findall(r"Location: .*", text)) <= scans, name
        assert count(text, "Exchange") <= 8, name


def test_reports_prune_days(plan):
    for name in ("dau_total", "join_day_over_day", "realtime_totals"):
        assert re.search(r"PartitionFilters: \[.*dt#", plan(name)), name


def test_order_rows_are_shuffled_at_most_once(spark):
    """With nothing small enough to broadcast, full order rows cross one exchange."""
    from tillstream.checks import fixtures as fx
    from tillstream.checks.queries import Tables, dated_orders, users
    from tillstream.plans.order_wide import order_wide
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, FOLDER)
        wide = order_wide(dated_orders(t), fx.user_status(t.orders), fx.provinces(t.nation), users(t))
        text = wide._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        exchanges = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: (.*)", text, flags=re.M)
        assert sum("final_total_amount" in columns for columns in exchanges) == 1
        assert sum("SortMergeJoin" == name for _, name in nodes(text)) >= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
