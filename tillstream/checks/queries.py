"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas
from tillstream.checks import fixtures as fx
from tillstream.functions.times import previous_day
from tillstream.operators import cdc, dims, docs, logs, offsets, orders as ops, serving
from tillstream.operators.joins import in_list_lookup
from tillstream.operators.records import accepted
from tillstream.plans.daily_active import daily_active
from tillstream.plans.order_wide import order_wide as build_order_wide
from tillstream.session import scratch_dir
from tillstream.sinks import batches
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sinks.ledger import SavesOffsets, offset_ledger
from tillstream.sinks.rollup import HourlyActives
from tillstream.sinks.search_index import SearchIndex
from tillstream.sinks.topics import start_topic_files
from tillstream.sources.lookups import lookup_rows, point_get, write_clustered
from tillstream.sources.topics import file_topic, table_stream
from tillstream.streaming.cdc import start_cdc_canal, start_cdc_maxwell
from tillstream.streaming.daily_active import start_dau as run_dau, start_first_seen, start_hourly as run_hourly
from tillstream.streaming.dims import start_dim_province as run_dim_province, start_dim_user as run_dim_user
from tillstream.streaming.logs import start_log_landing, start_log_split
from tillstream.streaming.orders import start_order_wide as run_order_wide, users_of

GROUP = "daily_active"
QUERY, TERM = "red widget", "Brand#13"
POINT_ID = 42
ONCE = {"availableNow": True}
FILE_ROWS = 20_000  # of a topic's file, where a batch may take several

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Tables:
    """The test tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return fx.table(self.spark, self.folder, name)

    def stream(self, name: str) -> DataFrame:
        return table_stream(self.spark, self.folder, name)


def query(build: Callable[[Tables], DataFrame], name: str | None = None):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(Tables(spark, folder))

    REGISTRY[name or build.__name__] = run
    return build


def named(name: str):
    return lambda build: query(build, name)


def finished(running: StreamingQuery) -> StreamingQuery:
    running.awaitTermination()
    return running


def in_files(records: DataFrame, path: str, order: list[str], n: int = 4, rows: int | None = None) -> int:
    """The records as a topic of n parts, which are written in order: a file each, which holds them in order; or with
    `rows`, for readers to whom the order within a part is all one, a file for each so many rows of a part, so that no
    task writes or reads more. The number of files of a part, on average."""
    seconds = F.unix_seconds("timestamp")
    cuts = F.percentile_approx(seconds, [k / n for k in range(1, n)]).alias("cuts")
    found = records.agg(cuts, F.count(F.lit(1)).alias("all")).first()
    bounds = [None, *sorted(set(found["cuts"] or [])), None]
    files = 1 if rows is None else -(-found["all"] // (rows * (len(bounds) - 1))) or 1
    for low, high in zip(bounds, bounds[1:]):
        part = records if low is None else records.filter(seconds >= low)
        part = part if high is None else part.filter(seconds < high)
        dealt = part.repartition(1) if files == 1 else part.repartition(files, F.xxhash64(*order))
        dealt.sortWithinPartitions(*order).write.mode("append").parquet(path)
    written = len(records.sparkSession.read.schema(schemas.TOPIC).parquet(path).inputFiles())
    return -(-written // (len(bounds) - 1)) or 1


def dated_orders(t: Tables) -> DataFrame:
    return ops.derive_create_date_hour(fx.order_facts(fx.order_batch(t.orders)))


def all_orders(t: Tables) -> DataFrame:
    return ops.derive_create_date_hour(fx.order_facts(t.orders))


def users(t: Tables) -> DataFrame:
    return dims.enrich_users(fx.raw_users(t.customer), fx.as_of())


def dau(t: Tables) -> DataFrame:
    return daily_active(fx.start_log_records(t.events))


def written_dau(t: Tables) -> DataFrame:
    """The daily-active index as reports read it: written by day, one folder each."""
    path = scratch_dir(t.spark, "dau_index")
    batches.write_day_index(dau(t), path, 0)
    return batches.read_daily_active(t.spark, path, schemas.DAU)


# --- sources, sinks, offsets ---

@query
def source_topic(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "source_topic")
    records = fx.app_log_records(t.stream("events"))
    finished(start_topic_files(records, f"{path}/topics", f"{path}/checkpoint_in", ONCE))
    replayed = file_topic(t.spark, f"{path}/topics")
    finished(
        replayed.writeStream.format("parquet").option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint_out").trigger(**ONCE).start()
    )
    return t.spark.read.parquet(f"{path}/out").select("topic", "partition", "offset", "value")


@query
def source_lookup_sql(t: Tables) -> DataFrame:
    sql = """SELECT user_id, if_consumed FROM {status}
             WHERE user_id IN (SELECT CAST(user_id AS STRING) FROM {orders})"""
    return lookup_rows(t.spark, sql, status=fx.user_status(t.orders), orders=dated_orders(t))


@query
def source_point_get(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "documents")
    write_clustered(fx.documents(t.part), path, files=8)
    return point_get(t.spark.read.parquet(path), POINT_ID).select("id", "name", "doubanScore")


@query
def sink_topic(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "sink_topic")
    finished(start_log_split(fx.app_log_records(t.stream("events")), f"{path}/topics", f"{path}/checkpoint", ONCE))
    return t.spark.read.schema(schemas.TOPIC).parquet(f"{path}/topics").select("topic", "partition", "offset", "value")


@query
def sink_upsert_table(t: Tables) -> DataFrame:
    target = KeyedTable(scratch_dir(t.spark, "upsert"), "id STRING, user_level STRING", ("id",))
    segment = F.col("c_mktsegment")
    key = F.col("c_custkey").cast("string").alias("id")
    target.upsert(t.customer.select(key, segment.alias("user_level")), 0)
    target.snapshot(t.spark, 0)
    changed = t.customer.filter(F.col("c_acctbal") > 5000)
    versions = F.explode(F.array(F.lit(1), F.lit(2))).alias("offset")
    level = F.concat(segment, F.lit("_"), F.col("offset")).alias("user_level")
    target.upsert(changed.select(key, "c_mktsegment", versions).select("id", level, "offset"), 1, versions=["offset"])
    target.snapshot(t.spark, 1)
    return target.read(t.spark)


@query
def sink_index_bulk(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "index_bulk")
    everything = logs.derive_dt_hr(accepted(logs.parse_app_log(fx.app_log_records(t.events))))
    opens = logs.dau_record(logs.dau_first_open(everything.filter(F.col("start").isNotNull())))
    others = logs.dau_record(logs.dau_first_open(everything.filter(F.col("start").isNull())))
    batches.write_day_index(opens, path, 0)
    batches.write_day_index(others, path, 1)
    return batches.read_day_index(t.spark, path, schemas.DAU, key="mid")


@query
def sink_write_count(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "write_count")

    def write(batch: DataFrame, batch_id: int) -> None:
        batches.write_counted(batch, f"{path}/rows", f"{path}/counts", batch_id)

    stream = fx.app_log_records(t.stream("events")).writeStream.foreachBatch(write)
    finished(stream.option("checkpointLocation", f"{path}/checkpoint").trigger(**ONCE).start())
    return batches.written_count(t.spark, f"{path}/counts")


@query
def sink_log_landing(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "landing")
    finished(start_log_landing(fx.app_log_records(t.stream("events")), f"{path}/lines", f"{path}/checkpoint", ONCE))
    lines = t.spark.read.schema("value STRING, dt STRING").text(f"{path}/lines")
    return lines.select("dt", "value")


@query
def sink_preview(t: Tables) -> DataFrame:
    return batches.preview_orders(all_orders(t))


@query
def offsets_range(t: Tables) -> DataFrame:
    return offsets.offsets_range(fx.app_log_records(t.events))


def _ledger(t: Tables) -> DataFrame:
    """What a consumer had read of the topic by the middle of the month, and another consumer's entry."""
    early = t.events.filter(F.col("ts") < F.lit(f"{fx.DAY} 00:00:00").cast("timestamp_ntz"))
    ranges = offsets.offsets_range(fx.app_log_records(early))
    entry = ranges.select("topic", F.lit(GROUP).alias("group"), "partition", "until_offset")
    return entry.union(entry.withColumn("group", F.lit("other")))


@query
def offsets_save(t: Tables) -> DataFrame:
    return offsets.offsets_save(_ledger(t), offsets.offsets_range(fx.app_log_records(t.events)), GROUP)


@query
def offsets_read(t: Tables) -> DataFrame:
    saved = offsets.offsets_read(_ledger(t), "app_log", GROUP)
    return offsets.resume(fx.app_log_records(t.events), saved).select("partition", "offset", "value")


# --- projections and scalar functions ---

@query
def parse_json_dynamic(t: Tables) -> DataFrame:
    parsed = accepted(logs.parse_app_log(fx.app_log_records(t.events)))
    return parsed.select("partition", "offset", "ts", *logs.COMMON, F.col("start").isNotNull().alias("is_start"))


@query
def parse_json_typed(t: Tables) -> DataFrame:
    return accepted(ops.parse_orders(fx.order_records(t.orders))).select(*schemas.ORDER_FIELDS)


@query
def derive_dt_hr(t: Tables) -> DataFrame:
    parsed = accepted(logs.parse_app_log(fx.app_log_records(t.events)))
    return logs.derive_dt_hr(parsed).select("partition", "offset", "ts", "dt", "hr")


@query
def derive_create_date_hour(t: Tables) -> DataFrame:
    return ops.derive_create_date_hour(fx.order_facts(t.orders)).select("id", "create_date", "create_hour")


@query
def dau_record(t: Tables) -> DataFrame:
    parsed = accepted(logs.parse_app_log(fx.start_log_records(t.events)))
    return logs.dau_record(logs.derive_dt_hr(parsed))


@query
def user_age(t: Tables) -> DataFrame:
    return users(t).select("id", "age")


@query
def user_age_group(t: Tables) -> DataFrame:
    return users(t).select("id", "age_group")


@query
def user_gender_name(t: Tables) -> DataFrame:
    return users(t).select("id", "gender_name")


@named("previous_day")
def previous_day_of_event(t: Tables) -> DataFrame:
    days = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    return days.withColumn("previous_dt", previous_day(F.col("dt")))


# --- filters, routing, change capture ---

@query
def route_app_log(t: Tables) -> DataFrame:
    return logs.route_app_log(fx.app_log_records(t.events)).select("topic", "partition", "offset", "value")


def _order_rows(messages: DataFrame) -> DataFrame:
    fields = F.from_json("value", "id BIGINT, user_id BIGINT, final_total_amount DOUBLE, create_time STRING")
    return messages.select("topic", fields.alias("row")).select("topic", "row.*")


def _any_rows(messages: DataFrame) -> DataFrame:
    fields = F.from_json("value", "id STRING, name STRING, user_level STRING, final_total_amount DOUBLE")
    return messages.select("topic", fields.alias("row")).select("topic", "row.*")


def _maxwell(t: Tables) -> DataFrame:
    return fx.maxwell_records(t.orders, t.customer, t.nation, t.part, t.supplier)


@query
def cdc_canal_route(t: Tables) -> DataFrame:
    return _order_rows(cdc.canal_route(fx.canal_records(t.orders)))


@query
def cdc_maxwell_route(t: Tables) -> DataFrame:
    return _any_rows(cdc.maxwell_route(_maxwell(t)))


@named("in_list_lookup")
def in_list_lookup_of_batch(t: Tables) -> DataFrame:
    return in_list_lookup(fx.user_status(t.orders), dated_orders(t), "user_id", "user_id")


@query
def filter_first_orders(t: Tables) -> DataFrame:
    return ops.status_of_first_orders(dated_orders(t), fx.user_status(t.orders))


@query
def doc_match(t: Tables) -> DataFrame:
    return docs.doc_match(fx.documents(t.part), QUERY).select("id", "name")


@query
def doc_match_indexed(t: Tables) -> DataFrame:
    """The same through an inverted index, two batches of documents, the second one changing some of the first."""
    documents = fx.documents(t.part)
    index = SearchIndex(scratch_dir(t.spark, "search_index"))
    index.add(documents.withColumn("name", F.when(F.col("id") % 3 == 0, F.concat(F.lit(QUERY), F.lit(" "), "id")).otherwise(F.col("name"))), 0)
    index.add(documents.filter(F.col("id") % 3 == 0), 1)
    return index.match(documents, QUERY).select("id", "name")


@query
def doc_term_nested(t: Tables) -> DataFrame:
    return docs.doc_term_nested(fx.documents(t.part), TERM).select("id", "name")


# --- joins ---

@query
def join_order_user_status(t: Tables) -> DataFrame:
    joined = ops.join_order_user_status(dated_orders(t), fx.user_status(t.orders))
    return joined.select("id", "user_id", "if_first_order")


PROVINCE_OUT = ["id", "province_id", "province_name", "province_area_code", "province_iso_code"]


@query
def join_order_province(t: Tables) -> DataFrame:
    return ops.join_order_province(all_orders(t), fx.provinces(t.nation)).select(*PROVINCE_OUT)


@query
def join_order_province_bcast(t: Tables) -> DataFrame:
    return ops.join_order_province_bcast(all_orders(t), fx.provinces(t.nation)).select(*PROVINCE_OUT)


@query
def join_order_user(t: Tables) -> DataFrame:
    joined = ops.join_order_user(all_orders(t), users(t))
    return joined.select("id", "user_id", "user_age_group", "user_gender")


@query
def join_day_over_day(t: Tables) -> DataFrame:
    return serving.day_over_day(written_dau(t), fx.DAY)


# --- aggregation, grouping, ordering ---

@query
def dau_total(t: Tables) -> DataFrame:
    return serving.dau_total(written_dau(t), fx.DAY)


@query
def dau_by_hour(t: Tables) -> DataFrame:
    return serving.dau_by_hour(dau(t))


@query
def realtime_totals(t: Tables) -> DataFrame:
    active = written_dau(t)
    seen = KeyedTable(scratch_dir(t.spark, "seen"), schemas.FIRST_SEEN, ("mid",))
    seen.upsert(serving.first_seen(active), 0)
    return serving.realtime_totals(active, seen.read(t.spark), fx.DAY)


@query
def group_orders_by_user(t: Tables) -> DataFrame:
    ids = F.array_join(F.transform("orders", lambda o: o["id"].cast("string")), ",")
    grouped = ops.group_orders_by_user(all_orders(t), columns=["final_total_amount"])
    return grouped.select("user_id", "part", "n_orders", ids.alias("order_ids"))


@query
def doc_top_n(t: Tables) -> DataFrame:
    return docs.doc_top_n(fx.documents(t.part)).select("id", "name", "doubanScore")


@query
def doc_highlight(t: Tables) -> DataFrame:
    hits = docs.doc_match(fx.documents(t.part), QUERY)
    return docs.doc_highlight(hits, QUERY).select("id", "name", "highlight")


@query
def doc_search(t: Tables) -> DataFrame:
    return docs.search(fx.documents(t.part), QUERY, TERM).select("id", "name", "doubanScore", "highlight")


# --- stateful ---

@query
def dau_first_open(t: Tables) -> DataFrame:
    return dau(t)


@query
def order_first_flag(t: Tables) -> DataFrame:
    flagged = ops.flag_first_orders(dated_orders(t), fx.user_status(t.orders))
    return flagged.select("id", "user_id", "create_time", "if_first_order")


@query
def pipeline_order_wide(t: Tables) -> DataFrame:
    wide = build_order_wide(dated_orders(t), fx.user_status(t.orders), fx.provinces(t.nation), users(t))
    return wide.select(*schemas.ORDER_WIDE_COLUMNS)


# --- the jobs as streams ---

@query
def start_dau(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "start_dau")
    seen = KeyedTable(f"{path}/seen", schemas.FIRST_SEEN, ("mid",))
    in_files(fx.start_log_records(t.events), f"{path}/topic", ["timestamp", "partition", "offset"])
    records = file_topic(t.spark, f"{path}/topic", max_files_per_trigger=1)
    finished(run_dau(records, f"{path}/index", f"{path}/rejects", f"{path}/checkpoint", trigger=ONCE))
    written = batches.day_index_stream(t.spark, f"{path}/index", schemas.DAU)
    finished(start_first_seen(written, seen, f"{path}/checkpoint_seen", trigger=ONCE))
    index = batches.read_daily_active(t.spark, f"{path}/index", schemas.DAU)
    return index.join(seen.read(t.spark), "mid", "left").select(*schemas.DAU_COLUMNS, "first_dt")


@query
def start_offsets(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "start_offsets")
    records = fx.app_log_records(t.events)
    partitions = [r["partition"] for r in records.select("partition").distinct().collect()]  # few, by the fixture
    in_files(records, f"{path}/topic", ["timestamp", "partition", "offset"])
    stream = offsets.observed_offsets(file_topic(t.spark, f"{path}/topic", max_files_per_trigger=1), "app_log", partitions)
    name = f"offsets_{path[-8:]}"
    saving = SavesOffsets(t.spark, offset_ledger(f"{path}/ledger"), GROUP, name, topic="app_log", snapshot_every=2)
    t.spark.streams.addListener(saving)
    try:
        finished(run_dau(stream, f"{path}/index", f"{path}/rejects", f"{path}/checkpoint", trigger=ONCE, name=name))
        saving.wait()
    finally:
        t.spark.streams.removeListener(saving)
    return saving.ledger.read(t.spark)


@query
def start_hourly(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "start_hourly")
    rollup = HourlyActives(f"{path}/rollup", buckets=4)
    files = in_files(fx.start_log_records(t.events), f"{path}/topic", ["timestamp", "partition", "offset"], rows=FILE_ROWS)
    records = file_topic(t.spark, f"{path}/topic", max_files_per_trigger=files)
    finished(run_hourly(records, rollup, f"{path}/checkpoint", snapshot_every=2, trigger=ONCE))
    return rollup.read(t.spark)


@named("start_cdc_canal")
def start_cdc_canal_rows(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "start_cdc_canal")
    finished(start_cdc_canal(fx.canal_records(t.stream("orders")), f"{path}/topics", f"{path}/checkpoint", ONCE))
    return _order_rows(t.spark.read.schema(schemas.TOPIC).parquet(f"{path}/topics"))


@named("start_cdc_maxwell")
def start_cdc_maxwell_rows(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "start_cdc_maxwell")
    names = ["orders", "customer", "nation", "part", "supplier"]
    records = fx.maxwell_records(*[t.stream(name) for name in names])
    finished(start_cdc_maxwell(records, f"{path}/topics", f"{path}/checkpoint", ONCE))
    return _any_rows(t.spark.read.schema(schemas.TOPIC).parquet(f"{path}/topics"))


@query
def start_dim_province(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "start_dim_province")
    target = KeyedTable(f"{path}/province", schemas.PROVINCE, ("id",))
    records = fx.dim_records("ods_base_province", fx.provinces(t.stream("nation")))
    finished(run_dim_province(records, target, f"{path}/rejects", f"{path}/checkpoint", trigger=ONCE))
    return target.read(t.spark)


@query
def start_dim_user(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "start_dim_user")
    target = KeyedTable(f"{path}/user", schemas.USER, ("id",))
    records = fx.dim_records("ods_user_info", fx.raw_users(t.stream("customer")))
    finished(run_dim_user(records, target, f"{path}/rejects", f"{path}/checkpoint", fx.as_of(), trigger=ONCE))
    return target.read(t.spark)


@query
def start_order_wide(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "start_order_wide")
    status = KeyedTable(f"{path}/status", schemas.USER_STATUS, ("user_id",))
    status.upsert(fx.user_status(t.orders), -1)
    dim = KeyedTable(f"{path}/user", schemas.USER, ("id",))
    dim.upsert(users(t).select(*t.spark.createDataFrame([], schemas.USER).columns), -1)
    records = fx.order_records(fx.order_batch(t.stream("orders")))
    finished(run_order_wide(
        records, f"{path}/wide", f"{path}/rejects", status,
        lambda spark: fx.provinces(t.nation), users_of(dim), f"{path}/checkpoint", trigger=ONCE,
    ))
    return batches.read_batches(t.spark, f"{path}/wide", schemas.ORDER_WIDE)
