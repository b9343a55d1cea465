import datetime as dt

import pytest
from frames import as_stream, rows
from pyspark.sql import functions as F

import samples
from millrace import functions as fn
from millrace.schemas import CARS, KAFKA_ROW, PURCHASES
from millrace.streaming import run_stream


def lines(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value STRING")


def test_short_lines(spark):
    assert rows(fn.short_lines(lines(spark, "hello", "hello!", "", None))) == [("",), ("hello",)]


def test_short_lines_on_a_stream_equals_batch(spark, tmp_path):
    frame = lines(spark, "a", "abcde", "abcdef")
    stored = run_stream(fn.short_lines(as_stream(spark, frame, tmp_path)), str(tmp_path / "run"))
    assert rows(stored) == rows(fn.short_lines(frame))


def test_parse_lines(spark):
    parsed = fn.parse_lines(lines(spark, "7000,blue", "14000,red,ignored", "-1,x"))
    assert parsed.columns == ["created", "color"]
    assert rows(parsed.select(F.unix_millis("created"), "color")) == [(-1, "x"), (14000, "red"), (7000, "blue")]


@pytest.mark.parametrize("bad", ["bad", "x,y", "7000,", "7000", ",blue", "", " 7,blue", "99999999999999999999,blue"])
def test_malformed_lines(spark, bad):
    with pytest.raises(Exception, match="malformed line"):
        fn.parse_lines(lines(spark, bad)).collect()
    created, color = fn.parse_lines(lines(spark, bad), mode="null").first()
    assert created is None or color is None


def test_parse_lines_null_mode_keeps_what_is_good(spark):
    assert rows(fn.parse_lines(lines(spark, "bad", "x,y"), mode="null")) == [(None, "y"), (None, None)]
    with pytest.raises(ValueError):
        fn.parse_lines(lines(spark, "bad"), mode="skip")


def test_json_records_on_bad_input(spark):
    parsed = fn.json_records(lines(spark, "hello", "[]", None, '{"id":"x","quantity":"abc"}'), PURCHASES, "p")
    facts = parsed.select(F.col("p").isNull().alias("missing"), "p.id", "p.quantity")
    assert rows(facts) == [(False, "x", None), (False, None, None), (False, None, None), (True, None, None)]


def test_json_records_expand_and_pick(spark):
    band = fn.json_records(lines(spark, *samples.BANDS.splitlines()), "id BIGINT, name STRING", "band")
    assert rows(fn.expand(band, "band").where("id = 3")) == [(3, "Third Rail Choir")]
    picked = fn.pick_fields(band, "band", {"id": "band_id", "name": "band_name"})
    assert picked.columns == ["band_id", "band_name"] and picked.count() == 4


def test_purchase_times_keep_their_offset(spark):
    purchases = fn.expand(fn.json_records(lines(spark, *samples.PURCHASES.splitlines()), PURCHASES, "p"), "p")
    first = purchases.where("quantity = 1").select(F.unix_millis("time")).first()[0]
    assert first == int(dt.datetime(2019, 2, 28, 15, 2, 41, 675000, dt.timezone.utc).timestamp() * 1000)


def test_conform(spark):
    frame = spark.createDataFrame([("a", "90", 1)], "Name STRING, Horsepower STRING, extra INT")
    typed = fn.conform(frame, "Horsepower BIGINT, Name STRING")
    assert typed.dtypes == [("Horsepower", "bigint"), ("Name", "string")]
    assert rows(typed) == [(90, "a")]
    with pytest.raises(ValueError, match="Miles_per_Gallon"):
        fn.conform(frame, CARS)


def test_decode_kafka(spark):
    stamp = dt.datetime(2024, 1, 11, 11, 4)
    raw = spark.createDataFrame(
        [(None, bytearray(b"Hello Spark"), "topic-a", 0, 0, stamp, 0)], KAFKA_ROW
    )
    decoded = fn.decode_kafka(raw)
    assert decoded.columns == ["topic", "stringValue", "timestamp", "timestampType"]
    assert decoded.select("topic", "stringValue", "timestampType").first() == ("topic-a", "Hello Spark", 0)


def test_message_frames(spark):
    frame = spark.createDataFrame([("a", None, "US")], "Name STRING, Horsepower BIGINT, Origin STRING")
    assert rows(fn.to_kv(frame, "Name")) == [("A", "a")]
    assert rows(fn.to_json_kv(frame, "Name", ["Name", "Horsepower", "Origin"])) == [
        ("A", '{"Name":"a","Origin":"US"}')
    ]


def test_kafka_round_trip_of_json_messages(spark):
    sent = fn.to_json_kv(spark.createDataFrame([("a", 5)], "Name STRING, hp INT"), "Name", ["Name", "hp"])
    received = fn.decode_kafka(
        sent.selectExpr(
            "cast(key as binary) key", "cast(value as binary) value", "'t' topic", "0 partition",
            "0L offset", "current_timestamp() timestamp", "0 timestampType",
        )
    )
    back = fn.expand(fn.json_records(received, "Name STRING, hp INT", "car", "stringValue"), "car")
    assert rows(back) == [("a", 5)]


def test_keyed_messages(spark):
    frame = spark.createDataFrame([("k", [34, 5, 4]), (None, None)], "key STRING, body ARRAY<INT>")
    assert rows(fn.keyed_messages(frame, "body", "key")) == [("k", "[34, 5, 4]"), ("undefined", None)]
    assert rows(fn.keyed_messages(frame.select("key"), F.lit("no key"))) == [("undefined", "no key")] * 2
