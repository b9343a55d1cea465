import datetime as dt

import pytest
from frames import rows

import samples
from millrace.schemas import CARS
from millrace.sources import (
    csv_stream,
    json_stream,
    kafka_stream,
    kafka_stream_options,
    lines_stream,
    numbers,
    read_table,
    table_stream,
)
from millrace.streaming import run_stream


def test_text_stream_has_one_value_column(spark, drop, tmp_path):
    drop("hello\nhi\n")
    lines = lines_stream(spark, "text", drop.folder)
    assert lines.isStreaming and lines.dtypes == [("value", "string")]
    assert rows(run_stream(lines, str(tmp_path / "run"))) == [("hello",), ("hi",)]


def test_socket_stream_is_a_pass_through(spark):
    lines = lines_stream(spark, "socket", host="localhost", port=12345)
    assert lines.isStreaming and lines.dtypes == [("value", "string")]


def test_csv_stream_parses_dates(spark, drop, tmp_path):
    drop(samples.STOCKS, "stocks.csv")
    stored = run_stream(csv_stream(spark, drop.folder), str(tmp_path / "run"))
    assert rows(stored) == [
        ("QUUX", dt.date(2000, 1, 1), 12.5),
        ("QUUX", dt.date(2000, 2, 1), 13.75),
        ("ZORB", dt.date(2000, 3, 1), 40.0),
    ]


def test_json_stream_reads_whole_numbers_as_double(spark, drop, tmp_path):
    drop(samples.CARS, "cars.json")
    stored = run_stream(json_stream(spark, drop.folder, CARS), str(tmp_path / "run"))
    assert stored.where("Name = 'wren van'").select("Miles_per_Gallon", "Displacement").first() == (44.0, 97.0)


def test_json_stream_equals_bounded_read(spark, drop, tmp_path):
    drop(samples.CARS, "cars.json")
    stored = run_stream(json_stream(spark, drop.folder, CARS), str(tmp_path / "run"))
    assert rows(stored) == rows(read_table(spark, "json", drop.folder, CARS))


def test_stream_of_files_needs_a_schema(spark, drop):
    drop(samples.CARS, "cars.json")
    with pytest.raises(Exception, match="[Ss]chema must be specified"):
        read_table(spark, "json", drop.folder, stream=True)


def test_inferred_json_columns_are_alphabetical(spark, drop):
    drop(samples.BANDS, "bands.json")
    read = read_table(spark, "json", drop.folder, inferSchema=True)
    assert read.dtypes == [("hometown", "string"), ("id", "bigint"), ("name", "string"), ("year", "bigint")]
    assert read.count() == 4


def test_path_may_be_an_option(spark, drop):
    drop(samples.BANDS, "bands.json")
    by_option = spark.read.format("json").option("path", drop.folder).load()
    assert rows(by_option) == rows(read_table(spark, "json", drop.folder)) == rows(spark.read.json(drop.folder))


def test_recursive_lookup(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "top.json").write_text('{"x": 1}\n')
    (tmp_path / "a" / "b" / "deep.json").write_text('{"x": 2}\n')
    path = str(tmp_path / "a")
    assert rows(read_table(spark, "json", path, "x INT")) == [(1,)]
    assert rows(read_table(spark, "json", path, "x INT", recursiveFileLookup=True)) == [(1,), (2,)]


def test_numbers_are_one_to_count(spark):
    frame = numbers(spark, 1000)
    assert frame.columns == ["number"]
    assert frame.selectExpr("min(number)", "max(number)", "count(*)").first() == (1, 1000, 1000)


@pytest.mark.parametrize("as_folder", [False, True])
def test_table_stream_takes_a_file_or_a_folder(spark, tmp_path, as_folder):
    frame = spark.range(20).withColumnRenamed("id", "n")
    target = tmp_path / "tables" / "t.parquet"
    if as_folder:
        frame.repartition(3).write.parquet(str(target))
    else:
        target.parent.mkdir(parents=True)
        frame.toPandas().to_parquet(target)
    stored = run_stream(table_stream(spark, str(tmp_path / "tables"), "t"), str(tmp_path / "run"))
    assert sorted(row[0] for row in stored.collect()) == list(range(20))


def test_table_stream_cuts_a_backlog_into_batches(spark, tmp_path):
    spark.range(40).repartition(4).write.parquet(str(tmp_path / "t.parquet"))
    seen = []
    stream = table_stream(spark, str(tmp_path), "t", max_bytes_per_trigger=1)
    stored = run_stream(stream, str(tmp_path / "run"), on_query=lambda q: seen.extend(q.recentProgress))
    assert stored.count() == 40
    assert len([report for report in seen if report["numInputRows"] > 0]) == 4


def test_jdbc_cannot_be_read_as_a_stream(spark):
    with pytest.raises(Exception, match="does not support streamed reading"):
        read_table(spark, "jdbc", stream=True, url="jdbc:none:", dbtable="t")


def test_kafka_options(spark):
    assert kafka_stream_options("h1:1,h2:2", "a, b") == {
        "kafka.bootstrap.servers": "h1:1,h2:2",
        "subscribe": "a,b",
    }
    assert kafka_stream_options(["h1:1", "h2:2"], ["a"], startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "h1:1,h2:2",
        "subscribe": "a",
        "startingOffsets": "earliest",
    }
    with pytest.raises(ValueError, match="at least one"):
        kafka_stream_options("h:1", " , ")
    with pytest.raises(Exception, match="(?i)failed to find.*kafka"):
        kafka_stream(spark, "h:1", "topic")


def test_delta_streams_are_a_pass_through(spark):
    with pytest.raises(Exception, match="(?i)failed to find.*delta"):
        read_table(spark, "delta", "/tmp/none", stream=True, ignoreDeletes=True)
