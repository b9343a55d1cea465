"""The registered queries: every operator over the given tables.

Each function takes the session and the folder of Parquet tables. Streaming ones
read the table as a stream, drain it and return what the sink holds.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace import operators as op
from millrace.plans.sql import run_sql
from millrace.schemas import CARS, STOCK_DATE_FORMAT, STOCKS
from millrace.session import delete_path, entries, full_uri, move_path, run_folder
from millrace.sources import csv_stream, json_stream, lines_stream, numbers, read_table, table, table_stream
from millrace.streaming import (
    EpochSink,
    KeyedTable,
    kept_schema,
    observed,
    published,
    run_stream,
    start_stream,
    state_layout,
    state_rows,
    stored_progress,
    trigger_options,
    watermark_in_force,
)
from millrace.streaming.backlog import SLICE, feed_slices, number_by_time, sliced_stream, write_slices
from millrace.streaming.layout import StateLayout
from millrace.streaming.runner import await_end
from millrace.streaming.sinks import ParquetConnection

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TWO_HOURS = 2 * 3600
BATCH_BYTES = 10**12
NTZ = "timestamp_ntz"


def query(build: Query) -> Query:
    """Register under the function's name, with window bounds and casts in UTC."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return run


def drained(df: DataFrame, name: str, mode: str = "append", **options: object) -> DataFrame:
    return run_stream(df, run_folder(df.sparkSession, name), mode, **options)


def backlog(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table as a stream, in micro-batches of bounded size.

    For queries whose result is the same for any cut into batches. Queries with a
    watermark are fed in stretches of time instead (``drained_in_slices``), as files need
    not lie in time order and rows of a late file would be dropped.
    """
    return table_stream(spark, folder, name, max_bytes_per_trigger=BATCH_BYTES)


def drained_in_slices(
    spark: SparkSession,
    folder: str,
    name: str,
    build: Callable[[DataFrame, str], DataFrame],
    number: Column | None = None,
    *,
    watch: Callable[[str], None] | None = None,
    **options: object,
) -> DataFrame:
    """Feed the events to a query with a watermark one stretch of time after the other.

    The table is cut into slices in one pass, and each slice is one run over the same
    checkpoint. No row is late, as slices follow each other in time, however the files lie.
    ``number`` replaces the number of the stretch; ``build`` gets the stream and the run folder.
    """
    events, place = table(spark, folder, "events"), run_folder(spark, name)
    write_slices(number_by_time(events, "ts") if number is None else events.withColumn(SLICE, number), "ts", place)

    def run() -> DataFrame:
        stream = sliced_stream(spark, place, events.schema)
        return run_stream(build(_zoned(stream), f"{place}/run"), f"{place}/run", **options)

    stored = feed_slices(spark, place, run)
    if watch is not None:
        watch(f"{place}/run")
    return stored


def purchases(events: DataFrame) -> DataFrame:
    """Events in the shape of purchase records."""
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("item"),
        F.col("value").alias("quantity"),
    )


def cars(part: DataFrame) -> DataFrame:
    """Parts in the shape of car records; columns without a counterpart stay null."""
    return part.select(
        F.col("p_name").alias("Name"),
        F.col("p_retailprice").alias("Miles_per_Gallon"),
        F.col("p_partkey").alias("Horsepower"),
        F.col("p_size").cast("bigint").alias("Weight_in_lbs"),
        F.col("p_brand").alias("Year"),
        F.col("p_type").alias("Origin"),
    )


# --- sources -----------------------------------------------------------------


@query
def src_text_stream(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "events").select(
        F.concat_ws(",", F.unix_millis(F.col("ts").cast("timestamp")), "event_type").alias("value")
    )
    path = run_folder(spark, "lines")
    lines.write.text(path)
    parsed = fn.parse_lines(lines_stream(spark, "text", path))
    return drained(parsed, "src_text_stream").withColumn("created", F.col("created").cast(NTZ))


@query
def src_csv_stream(spark: SparkSession, folder: str) -> DataFrame:
    stocks = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("company"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("value"),
    )
    path = run_folder(spark, "stocks")
    stocks.write.csv(path, header=False, dateFormat=STOCK_DATE_FORMAT)
    return drained(csv_stream(spark, path, STOCKS), "src_csv_stream")


def _car_files(spark: SparkSession, folder: str) -> str:
    path = run_folder(spark, "cars")
    cars(table(spark, folder, "part")).write.json(path)
    return path


@query
def src_json_stream(spark: SparkSession, folder: str) -> DataFrame:
    stream = json_stream(spark, _car_files(spark, folder), CARS)
    return drained(stream.select("Name", "Miles_per_Gallon", "Weight_in_lbs", "Origin"), "src_json_stream")


@query
def src_json_inferred(spark: SparkSession, folder: str) -> DataFrame:
    read = read_table(spark, "json", _car_files(spark, folder))
    return read.select("Name", "Miles_per_Gallon", "Weight_in_lbs", "Origin")


@query
def src_range(spark: SparkSession, folder: str) -> DataFrame:
    """The range from 1 to each line's number."""
    lines = table(spark, folder, "lineitem")
    return lines.select("l_orderkey", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("l_linenumber").cast("bigint"))).alias("number"))


@query
def src_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """As many numbers as there are lines, made where they are used."""
    return numbers(spark, table(spark, folder, "lineitem").count())


@query
def rdd_double(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select((F.col("l_orderkey").cast("bigint") * 2).alias("doubled"))


@query
def src_recursive(spark: SparkSession, folder: str) -> DataFrame:
    """Files two folders down, read with a recursive lookup and the path as an option."""
    place = run_folder(spark, "nested")
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    for number in range(2):
        part.where(F.col("p_partkey") % 2 == number).write.json(f"{place}/deep/level-{number}")
    return read_table(spark, "json", schema="p_partkey BIGINT, p_name STRING", path=place, recursiveFileLookup=True)


def _json_lines(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Rows as a folder of JSON lines."""
    path = run_folder(spark, name)
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(path)
    return path


@query
def lines_top1(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines to records to day windows to the best item of each day."""
    bought = purchases(table(spark, folder, "events"))
    lines = lines_stream(spark, "text", _json_lines(spark, bought, "purchase_lines"))
    records = fn.expand(fn.json_records(lines, bought.schema, "purchase"), "purchase")
    totals = op.window_totals(records, "time", "1 day", "quantity", keys=["item"])
    return rounded(drained(totals, "lines_top1", "complete", finish=lambda day: op.top_per_window(day, "item")))


@query
def lines_static_inner(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of JSON lines, parsed with the inferred schema of a static read, joined with a table."""
    place, path = run_folder(spark, "lines_static_inner"), _json_lines(spark, _customers(table(spark, folder, "customer")), "customer_lines")
    known = kept_schema(spark, place, lambda: read_table(spark, "json", path).schema)
    records = fn.json_records(lines_stream(spark, "text", path), known, "customer")
    picked = fn.pick_fields(records, "customer", {"c_custkey": "c_custkey", "c_name": "c_name", "c_nationkey": "c_nationkey"})
    joined = op.join_stream_static(picked, _orders(table(spark, folder, "orders")), "c_custkey", "o_custkey")
    return run_stream(joined, place, schema=known).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query
def lines_schema_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Two starts over one checkpoint. With the lines that come in between the inferred schema
    would have a field more. The stream goes on with the schema of its first start."""
    place, rows = run_folder(spark, "lines_schema_kept"), _customers(table(spark, folder, "customer"))
    odd = F.col("c_custkey") % 2 == 1
    for part in (rows.where(odd), rows.where(~odd).withColumn("a_new_field", F.lit(1.5))):
        part.select(F.to_json(F.struct(*part.columns)).alias("value")).write.mode("append").text(f"{place}/in")
        known = kept_schema(spark, place, lambda: read_table(spark, "json", f"{place}/in").schema)
        records = fn.json_records(lines_stream(spark, "text", f"{place}/in"), known, "customer")
        stored = run_stream(fn.expand(records, "customer"), place, schema=known)
    return stored.withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query
def lines_stream_inner(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams of JSON lines joined on a key."""
    sides = []
    for rows in (_orders(table(spark, folder, "orders")), _customers(table(spark, folder, "customer"))):
        lines = lines_stream(spark, "text", _json_lines(spark, rows, "side_lines"))
        sides.append(fn.expand(fn.json_records(lines, rows.schema, "row"), "row"))
    place = run_folder(spark, "lines_stream_inner")
    layout = state_layout(spark, place, lambda: op.hot_layout(table(spark, folder, "orders"), "o_custkey"))
    joined = op.join_streams(
        *sides, "o_custkey", "c_custkey", unbounded_state=True, hot=layout.hot, salts=layout.salts
    )
    return run_stream(joined, place, layout=layout)


@query
def files_json_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of JSON files to key and JSON messages."""
    stream = json_stream(spark, _car_files(spark, folder), CARS)
    return drained(fn.to_json_kv(stream, "Name", ["Name", "Weight_in_lbs", "Origin"]), "files_json_messages")


# --- projections and messages ------------------------------------------------


@query
def proj_columns(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.select(F.col("p_name"), part["p_brand"])


@query
def proj_arith(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", F.round(F.col("p_size") / 2.2, 6).alias("weight_kg")
    )


@query
def proj_expr(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", F.round(F.expr("p_size / 2.2").cast("double"), 4).alias("weight_kg")
    )


@query
def proj_select_expr(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey", "round(cast(p_size / 2.2 as double), 4) as weight_kg"
    )


@query
def proj_typed(spark: SparkSession, folder: str) -> DataFrame:
    typed = fn.conform(
        cars(table(spark, folder, "part")), "Name STRING, Horsepower BIGINT, Weight_in_lbs DOUBLE, Origin STRING"
    )
    return typed.toDF("name", "hp", "weight", "origin")


@query
def json_expand(spark: SparkSession, folder: str) -> DataFrame:
    records = fn.json_records(backlog(spark, folder, "events"), "k BIGINT", "record", "props")
    return drained(fn.expand(records, "record"), "json_expand")


@query
def json_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = backlog(spark, folder, "events").select(
        F.struct("event_id", F.from_json("props", "k BIGINT").alias("props")).alias("event")
    )
    picked = rows.selectExpr("event.event_id as id", "event.props.k as amount")
    return drained(picked, "json_fields")


@query
def struct_pick(spark: SparkSession, folder: str) -> DataFrame:
    rows = backlog(spark, folder, "customer").select(F.struct("c_custkey", "c_name").alias("band"))
    return drained(fn.pick_fields(rows, "band", {"c_custkey": "id", "c_name": "name"}), "struct_pick")


@query
def kafka_decode(spark: SparkSession, folder: str) -> DataFrame:
    rows = backlog(spark, folder, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    return drained(fn.decode_kafka(rows), "kafka_decode")


@query
def kafka_kv(spark: SparkSession, folder: str) -> DataFrame:
    return drained(fn.to_kv(backlog(spark, folder, "part"), "p_name"), "kafka_kv")


@query
def json_build(spark: SparkSession, folder: str) -> DataFrame:
    messages = fn.to_json_kv(backlog(spark, folder, "part"), "p_name", ["p_name", "p_size", "p_type"])
    return drained(messages, "json_build")


@query
def msg_default_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    known = F.when(F.col("event_type") != "error", F.col("event_type"))
    return fn.keyed_messages(events, "props", known)


# --- filters and SQL ---------------------------------------------------------


@query
def filter_length(spark: SparkSession, folder: str) -> DataFrame:
    lines = backlog(spark, folder, "events").select(F.col("event_type").alias("value"))
    return drained(fn.short_lines(lines), "filter_length")


@query
def filter_ne(spark: SparkSession, folder: str) -> DataFrame:
    return op.differs_from(table(spark, folder, "part"), "p_type", "PROMO").select("p_partkey", "p_type")


@query
def filter_default(spark: SparkSession, folder: str) -> DataFrame:
    strong = op.above(backlog(spark, folder, "part"), "p_retailprice", 950)
    return drained(strong.select("p_partkey", "p_name", "p_retailprice"), "filter_default")


@query
def sql_where(spark: SparkSession, folder: str) -> DataFrame:
    views = {"cars": cars(table(spark, folder, "part"))}
    return run_sql(spark, views, "select Name from cars where Origin = 'PROMO'")


# --- aggregates --------------------------------------------------------------


@query
def agg_avg(spark: SparkSession, folder: str) -> DataFrame:
    mean = op.mean_of(table(spark, folder, "part"), "p_retailprice", "average")
    return mean.select(F.round("average", 4).alias("average"))


@query
def agg_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = op.spread_stats(table(spark, folder, "part"), "p_retailprice")
    return stats.select(*(F.round(name, 4).alias(name) for name in stats.columns))


@query
def agg_count_by(spark: SparkSession, folder: str) -> DataFrame:
    return op.count_by(table(spark, folder, "part"), "p_type", name="parts")


@query
def stream_count_powerful(spark: SparkSession, folder: str) -> DataFrame:
    strong = op.above(backlog(spark, folder, "part"), "p_retailprice", 950)
    return drained(op.count_where(strong, F.lit(True), "powerful"), "stream_count_powerful", "complete")


@query
def stream_avg(spark: SparkSession, folder: str) -> DataFrame:
    mean = op.mean_of(backlog(spark, folder, "part"), "p_retailprice", "average")
    return drained(mean, "stream_avg", "complete").select(F.round("average", 4).alias("average"))


@query
def stream_count_by(spark: SparkSession, folder: str) -> DataFrame:
    counts = op.count_by(backlog(spark, folder, "part"), "p_type", name="parts")
    return drained(counts, "stream_count_by", "complete")


# --- output modes, checkpoints, progress -------------------------------------


@query
def mode_append_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = backlog(spark, folder, "events").where("value > 100").select("event_id", "event_type", "value")
    return drained(rows, "mode_append_rows")


@query
def mode_update_agg(spark: SparkSession, folder: str) -> DataFrame:
    counts = op.count_by(backlog(spark, folder, "events"), "user_id", name="actions")
    return drained(counts, "mode_update_agg", "update", keys=["user_id"])


@query
def mode_complete_agg(spark: SparkSession, folder: str) -> DataFrame:
    totals = backlog(spark, folder, "events").groupBy("user_id").agg(F.sum("value").alias("total"))
    return drained(totals, "mode_complete_agg", "complete").select("user_id", F.round("total", 4).alias("total"))


@query
def ckpt_no_reread(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over one checkpoint: the second finds nothing new."""
    place = run_folder(spark, "ckpt_no_reread")
    for _ in range(2):
        stored = run_stream(backlog(spark, folder, "orders").select("o_orderkey", "o_totalprice"), place)
    return stored


@query
def ckpt_new_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs with a checkpoint each: both read everything."""
    rows = [drained(backlog(spark, folder, "orders").select("o_orderkey"), "ckpt_new_run") for _ in range(2)]
    return rows[0].union(rows[1])


@query
def ckpt_edited_file(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs over one checkpoint: files, the same files with other rows in them, new files.

    An edited file is not read again, a new one is.
    """
    place = run_folder(spark, "ckpt_edited_file")
    rows, watched = table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), f"{place}/in"

    def staged(third: int) -> tuple[str, list[str]]:
        path = f"{place}/staged-{third}"
        rows.where(F.col("o_orderkey") % 3 == third).write.json(path)
        return path, [name for name in entries(spark, path) if name.endswith(".json")]

    def run() -> DataFrame:
        return run_stream(json_stream(spark, watched, rows.schema), place)

    path, first = staged(0)
    for name in first:
        move_path(spark, f"{path}/{name}", f"{watched}/{name}")
    run()
    path, names = staged(1)
    for name, edited in zip(names, first):
        delete_path(spark, f"{watched}/{edited}")
        move_path(spark, f"{path}/{name}", f"{watched}/{edited}")
    run()
    path, names = staged(2)
    for name in names:
        move_path(spark, f"{path}/{name}", f"{watched}/{name}")
    return run()


@query
def trigger_processing_time(spark: SparkSession, folder: str) -> DataFrame:
    """A running query that starts a batch every two seconds, stopped when all is read."""
    running = start_stream(
        backlog(spark, folder, "part").select("p_partkey", "p_size"),
        run_folder(spark, "trigger_processing_time"),
        trigger=trigger_options("processing_time", "2 seconds"),
    )
    running.query.processAllAvailable()
    running.query.stop()
    return running.result()


@query
def sink_json(spark: SparkSession, folder: str) -> DataFrame:
    return drained(backlog(spark, folder, "part").select("p_partkey", "p_name", "p_size"), "sink_json", fmt="json")


@query
def sink_csv(spark: SparkSession, folder: str) -> DataFrame:
    return drained(backlog(spark, folder, "part").select("p_partkey", "p_name", "p_size"), "sink_csv", fmt="csv")


@query
def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Even events first, then the odd ones, most of which come after their windows closed.

    ``late`` is the number of rows that the watermark has turned away.
    """
    places: list[str] = []
    odd = F.coalesce(F.pmod("event_id", F.lit(2)), F.lit(0)).cast("long")

    def build(events: DataFrame, place: str) -> DataFrame:
        known = watermark_in_force(spark, f"{place}/checkpoint") or 0
        return op.late_safe_counts(events, "ts", "event_type", "10 minutes", "1 hour", watermark=known)

    stored = drained_in_slices(spark, folder, "late_rows", build, odd, watch=places.append, progress=True)
    late = observed(spark, places[0], op.LATE, "rows BIGINT").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("late"))
    stored = stored.withColumns({name: F.col(name).cast(NTZ) for name in ("start", "end")})
    return stored.withColumn("late", F.lit(late.first().late).cast("long"))


@query
def state_open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """What the state of a watermarked count still holds when all is read: the open windows, no closed one."""
    places: list[str] = []
    drained_in_slices(spark, folder, "state_open_windows", _hourly_counts, watch=places.append)
    held = state_rows(spark, f"{places[0]}/checkpoint")
    bounds = [F.col(f"key.window.{name}").cast(NTZ).alias(name) for name in ("start", "end")]
    return held.select(*bounds, "key.event_type", "value.count")


def _hourly_counts(events: DataFrame, place: str) -> DataFrame:
    return op.late_safe_counts(events, "ts", "event_type", "10 minutes", "1 hour")


@query
def progress_event_time(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over the filed reports of all batches."""
    places: list[str] = []
    drained_in_slices(spark, folder, "progress_event_time", _hourly_counts, watch=places.append, progress=True)
    return stored_progress(spark, places[0]).agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.min("min_time").cast(NTZ).alias("min_time"),
        F.max("max_time").cast(NTZ).alias("max_time"),
        F.max("watermark").cast(NTZ).alias("watermark"),
    )


# --- sinks -------------------------------------------------------------------


def _each_batch(rows: DataFrame, place: str, write: Callable[[DataFrame, int], None]) -> None:
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{place}/checkpoint")
    await_end(writer.trigger(availableNow=True).start())


@query
def sink_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """One row per name, the newest part number wins."""
    place = run_folder(spark, "sink_upsert")
    rows = backlog(spark, folder, "part").select("p_name", "p_size", "p_partkey")
    keyed = KeyedTable(spark, f"{place}/data", ["p_name"], rows.schema, ["p_partkey"])
    _each_batch(rows, place, keyed.sink())
    return keyed.rows()


@query
def sink_upsert_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a new version of the table between batches of the running stream."""
    place = run_folder(spark, "sink_upsert_compacted")
    rows = backlog(spark, folder, "part").select("p_name", "p_size", "p_partkey")
    keyed = KeyedTable(spark, f"{place}/data", ["p_name"], rows.schema, ["p_partkey"], buckets=8)

    def write(batch: DataFrame, batch_id: int) -> None:
        for part, half in enumerate((batch.where("p_partkey % 2 = 0"), batch.where("p_partkey % 2 = 1"))):
            keyed.write(half, 2 * batch_id + part)
            keyed.compact()
        keyed.vacuum()

    _each_batch(rows, place, write)
    return keyed.rows()


def _name_files(spark: SparkSession, name: str) -> tuple[str, EpochSink]:
    place = full_uri(spark, run_folder(spark, name))
    shape = pa.schema([("p_name", pa.string()), ("p_size", pa.int32())])
    connect = lambda part, batch: ParquetConnection(f"{place}/data", shape, part, batch, once=True)
    return place, EpochSink(spark, f"{place}/data", connect)


@query
def sink_row_writer(spark: SparkSession, folder: str) -> DataFrame:
    place, sink = _name_files(spark, "sink_row_writer")
    rows = backlog(spark, folder, "part").select("p_name", "p_size")
    _each_batch(rows, place, sink)
    return published(spark, f"{place}/data", rows.schema)


@query
def sink_row_writer_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Each batch is first written by a try that breaks off before it is published, then with
    other partitions, and then comes once more after it was published."""
    place, sink = _name_files(spark, "sink_row_writer_repeated")
    rows = backlog(spark, folder, "part").select("p_name", "p_size")

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch.repartition(5), batch_id)
        sink(batch.repartition(3), batch_id)
        sink(batch, batch_id)

    _each_batch(rows, place, write)
    return published(spark, f"{place}/data", rows.schema)


# --- joins -------------------------------------------------------------------


def _orders(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", "o_totalprice")


def _customers(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", "c_name", "c_nationkey")


def _documents(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "lang", "n_chars")


def _labels(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").alias("l_doc_id"), "quality", "toxic")


@query
def join_inner(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = _orders(table(spark, folder, "orders")), _customers(table(spark, folder, "customer"))
    return op.join_tables(orders, customers, "o_custkey", "c_custkey", "inner")


@query
def join_left(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _documents(table(spark, folder, "documents")), _labels(table(spark, folder, "labels"))
    return op.join_tables(documents, labels, "doc_id", "l_doc_id", "left")


@query
def join_right(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _documents(table(spark, folder, "documents")), _labels(table(spark, folder, "labels"))
    return op.join_tables(labels, documents, "l_doc_id", "doc_id", "right")


@query
def join_full(spark: SparkSession, folder: str) -> DataFrame:
    """Parts against nations by number: both sides have rows without a partner."""
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return op.join_tables(part, nation, "p_size", "n_nationkey", "full")


@query
def join_semi(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _documents(table(spark, folder, "documents")), _labels(table(spark, folder, "labels"))
    return op.join_tables(documents, labels, "doc_id", "l_doc_id", "left_semi")


@query
def join_anti(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _documents(table(spark, folder, "documents")), _labels(table(spark, folder, "labels"))
    return op.join_tables(documents, labels, "doc_id", "l_doc_id", "left_anti")


@query
def ss_static_inner(spark: SparkSession, folder: str) -> DataFrame:
    joined = op.join_stream_static(
        _orders(backlog(spark, folder, "orders")),
        _customers(table(spark, folder, "customer")),
        "o_custkey",
        "c_custkey",
    )
    return drained(joined, "ss_static_inner")


@query
def static_ss_right(spark: SparkSession, folder: str) -> DataFrame:
    joined = op.join_stream_static(
        _labels(table(spark, folder, "labels")),
        _documents(backlog(spark, folder, "documents")),
        "l_doc_id",
        "doc_id",
        "right",
    )
    return drained(joined, "static_ss_right")


def _documents_with_labels(spark: SparkSession, folder: str, how: str) -> DataFrame:
    joined = op.join_stream_static(
        _documents(backlog(spark, folder, "documents")),
        _labels(table(spark, folder, "labels")),
        "doc_id",
        "l_doc_id",
        how,
    )
    return drained(joined, f"ss_static_{how}")


@query
def ss_static_left(spark: SparkSession, folder: str) -> DataFrame:
    return _documents_with_labels(spark, folder, "left")


@query
def ss_static_semi(spark: SparkSession, folder: str) -> DataFrame:
    return _documents_with_labels(spark, folder, "left_semi")


@query
def ss_static_anti(spark: SparkSession, folder: str) -> DataFrame:
    return _documents_with_labels(spark, folder, "left_anti")


@query
def stream_stream_inner(spark: SparkSession, folder: str) -> DataFrame:
    place = run_folder(spark, "stream_stream_inner")
    layout = state_layout(spark, place, lambda: op.hot_layout(table(spark, folder, "orders"), "o_custkey"))
    joined = op.join_streams(
        _orders(backlog(spark, folder, "orders")),
        _customers(backlog(spark, folder, "customer")),
        "o_custkey",
        "c_custkey",
        unbounded_state=True,
        hot=layout.hot,
        salts=layout.salts,
    )
    return run_stream(joined, place, layout=layout)


def _zoned(events: DataFrame) -> DataFrame:
    """Watermarks need a timestamp with a zone; the session zone is UTC here."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _clicks(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("c_user"), F.col("ts").alias("c_ts")
    )


def _buys(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("buy_id"), F.col("user_id").alias("b_user"), F.col("ts").alias("b_ts")
    )


BUYS = ["buy_id", "b_user", "b_ts"]
CLICK_TO_BUY = {"left_time": "c_ts", "right_time": "b_ts", "within": TWO_HOURS, "delay": "10 minutes"}


def _user_layout(spark: SparkSession, folder: str) -> StateLayout:
    """Hot users among the events that the click and purchase joins take."""
    events = table(spark, folder, "events").where("event_type IN ('click', 'purchase')")
    return op.hot_layout(events, "user_id")


def _click_then_buy(spark: SparkSession, folder: str, how: str) -> DataFrame:
    def build(events: DataFrame, place: str) -> DataFrame:
        layout = state_layout(spark, place, lambda: measured)
        hot = {"hot": layout.hot, "salts": layout.salts}
        clicks, buys = _clicks(events), _buys(events)
        if how == "full":
            return op.full_interval_join(clicks, buys, "c_user", "b_user", **CLICK_TO_BUY, **hot)
        return op.join_streams(clicks, buys, "c_user", "b_user", how, **CLICK_TO_BUY, **hot)

    measured = _user_layout(spark, folder)
    read = (lambda stored: op.settle_full(stored, BUYS)) if how == "full" else None
    stored = drained_in_slices(spark, folder, f"stream_interval_{how}", build, layout=measured, read=read)
    return stored.withColumns({name: F.col(name).cast(NTZ) for name in ("c_ts", "b_ts") if name in stored.columns})


@query
def stream_interval_inner(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy(spark, folder, "inner")


@query
def stream_interval_left(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy(spark, folder, "left")


@query
def stream_interval_right(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy(spark, folder, "right")


@query
def stream_interval_full(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy(spark, folder, "full")


@query
def stream_interval_semi(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy(spark, folder, "left_semi")


# --- time windows and ranking ------------------------------------------------


def rounded(df: DataFrame, name: str = "total") -> DataFrame:
    return df.withColumn(name, F.round(name, 4))


@query
def win_tumbling_sum(spark: SparkSession, folder: str) -> DataFrame:
    totals = op.window_totals(purchases(backlog(spark, folder, "events")), "time", "1 day", "quantity")
    return rounded(drained(totals, "win_tumbling_sum", "complete"))


@query
def win_best_seller(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted when read back: neither the state nor the stored files keep an order."""
    totals = op.window_totals(purchases(backlog(spark, folder, "events")), "time", "1 day", "quantity", keys=["item"])
    largest_first = [F.col("total").desc_nulls_last()]
    return rounded(drained(totals, "win_best_seller", "complete", order_by=largest_first))


@query
def win_top1_per_day(spark: SparkSession, folder: str) -> DataFrame:
    totals = op.window_totals(
        purchases(backlog(spark, folder, "events")), "time", "1 day", "quantity", keys=["item"]
    )
    best = drained(totals, "win_top1_per_day", "complete", finish=lambda day: op.top_per_window(day, "item"))
    return rounded(best)


def _hourly_panes(spark: SparkSession, folder: str) -> DataFrame:
    return op.pane_totals(
        purchases(backlog(spark, folder, "events")), "time", "1 hour", "quantity", keys=["item"]
    )


@query
def win_sliding_sum(spark: SparkSession, folder: str) -> DataFrame:
    totals = drained(
        _hourly_panes(spark, folder),
        "win_sliding_sum",
        "complete",
        finish=lambda panes: op.slide_panes(panes, "1 day", "1 hour", keys=["item"]),
    )
    return rounded(totals)


@query
def win_top1_sliding(spark: SparkSession, folder: str) -> DataFrame:
    best = drained(
        _hourly_panes(spark, folder),
        "win_top1_sliding",
        "complete",
        finish=lambda panes: op.top_per_window(op.slide_panes(panes, "1 day", "1 hour", keys=["item"]), "item"),
    )
    return rounded(best)


@query
def proc_time_chars(spark: SparkSession, folder: str) -> DataFrame:
    """Arrival windows differ from run to run, so their bounds are summed away."""
    lines = backlog(spark, folder, "events").select(F.col("props").alias("value"))
    stored = drained(op.processing_time_chars(lines), "proc_time_chars", "complete")
    return stored.groupBy("value").agg(F.sum("length").alias("length"))


@query
def wm_count(spark: SparkSession, folder: str) -> DataFrame:
    stored = drained_in_slices(spark, folder, "wm_count", _hourly_counts)
    return stored.withColumns({name: F.col(name).cast(NTZ) for name in ("start", "end")})


@query
def win_sliding_append(spark: SparkSession, folder: str) -> DataFrame:
    def build(events: DataFrame, place: str) -> DataFrame:
        return op.sliding_totals_closed(
            events, "ts", "1 day", "1 hour", "value", delay="10 minutes", keys=["event_type"]
        )

    stored = rounded(drained_in_slices(spark, folder, "win_sliding_append", build))
    return stored.withColumns({name: F.col(name).cast(NTZ) for name in ("start", "end")})


@query
def win_top1_closed(spark: SparkSession, folder: str) -> DataFrame:
    """Best item of each day in append mode, written once when the day is closed."""

    def build(events: DataFrame, place: str) -> DataFrame:
        return op.top_closed(purchases(events), "time", "1 day", "quantity", "item", delay="10 minutes")

    stored = rounded(drained_in_slices(spark, folder, "win_top1_closed", build))
    return stored.withColumns({name: F.col(name).cast(NTZ) for name in ("start", "end")})


@query
def win_top1_sliding_closed(spark: SparkSession, folder: str) -> DataFrame:
    """Best item of each sliding day in append mode."""

    def build(events: DataFrame, place: str) -> DataFrame:
        return op.top_sliding_closed(purchases(events), "time", "1 day", "1 hour", "quantity", "item", delay="10 minutes")

    stored = rounded(drained_in_slices(spark, folder, "win_top1_sliding_closed", build))
    return stored.withColumns({name: F.col(name).cast(NTZ) for name in ("start", "end")})


# --- the same transforms over bounded tables ---------------------------------


@query
def batch_best_seller(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(op.best_sellers(purchases(table(spark, folder, "events"))))


@query
def batch_top1_per_day(spark: SparkSession, folder: str) -> DataFrame:
    totals = op.window_totals(purchases(table(spark, folder, "events")), "time", "1 day", "quantity", keys=["item"])
    return rounded(op.top_per_window(totals, "item"))


def _sliding_day(spark: SparkSession, folder: str) -> DataFrame:
    return op.sliding_totals(
        purchases(table(spark, folder, "events")), "time", "1 day", "1 hour", "quantity", keys=["item"]
    )


@query
def batch_sliding_sum(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_sliding_day(spark, folder))


@query
def batch_top1_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(op.top_per_window(_sliding_day(spark, folder), "item"))


def _click_then_buy_batch(spark: SparkSession, folder: str, how: str) -> DataFrame:
    events, layout = table(spark, folder, "events"), _user_layout(spark, folder)
    return op.join_streams(
        _clicks(events),
        _buys(events),
        "c_user",
        "b_user",
        how,
        left_time="c_ts",
        right_time="b_ts",
        within=TWO_HOURS,
        hot=layout.hot,
        salts=layout.salts,
    )


@query
def batch_wm_count(spark: SparkSession, folder: str) -> DataFrame:
    """All windows, those included that the stream still holds back."""
    return _hourly_counts(table(spark, folder, "events"), "")


@query
def batch_interval_inner(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy_batch(spark, folder, "inner")


@query
def batch_interval_right(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy_batch(spark, folder, "right")


@query
def batch_interval_semi(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy_batch(spark, folder, "left_semi")


@query
def batch_interval_left(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy_batch(spark, folder, "left")


@query
def batch_interval_full(spark: SparkSession, folder: str) -> DataFrame:
    return _click_then_buy_batch(spark, folder, "full")
