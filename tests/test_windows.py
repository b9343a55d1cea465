import datetime as dt
import random

import pytest
from frames import as_stream, rows
from pyspark.sql import functions as F

import samples
from millrace import functions as fn
from millrace import operators as op
from millrace.schemas import PURCHASES
from millrace.sources import lines_stream
from millrace.streaming import run_stream


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def purchases(spark):
    frame = spark.createDataFrame([(line,) for line in samples.PURCHASES.splitlines()], "value STRING")
    return fn.expand(fn.json_records(frame, PURCHASES, "purchase"), "purchase")


DAYS = [(day("2019-02-28"), day("2019-03-01"), 14), (day("2019-03-01"), day("2019-03-02"), 6)]


def rebound(df):
    """Window bounds as plain UTC times, whatever the machine's zone."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("start", "end")})


def test_sum_per_day(purchases):
    per_day = op.window_totals(purchases, "time", "1 day", "quantity")
    assert rows(rebound(per_day)) == DAYS


def test_sum_per_day_from_a_stream_of_lines(spark, drop, tmp_path):
    for line in samples.PURCHASES.splitlines():
        drop(line + "\n")
    lines = lines_stream(spark, "text", drop.folder, maxFilesPerTrigger=1)
    stream = fn.expand(fn.json_records(lines, PURCHASES, "purchase"), "purchase")
    stored = run_stream(op.window_totals(stream, "time", "1 day", "quantity"), str(tmp_path / "run"), "complete")
    assert rows(rebound(stored)) == DAYS


def test_best_sellers_are_sorted(purchases):
    ranked = op.best_sellers(purchases).select("item", "total").collect()
    assert [tuple(row) for row in ranked] == [("Watch", 10), ("iPad", 6), ("iPhone", 4)]


def test_best_sellers_put_unknown_totals_last(spark):
    frame = spark.createDataFrame(
        [(day("2024-01-01"), "x", None), (day("2024-01-01"), "y", -3)], "time TIMESTAMP, item STRING, quantity INT"
    )
    assert [row.item for row in op.best_sellers(frame).collect()] == ["y", "x"]
    totals = op.window_totals(frame, "time", "1 day", "quantity", keys=["item"])
    assert rows(op.top_per_window(totals, "item"), "item") == [("y",)]


@pytest.mark.parametrize("mode", ["append", "update"])
def test_sorted_stream_needs_complete_mode(spark, purchases, tmp_path, mode):
    ranked = op.best_sellers(as_stream(spark, purchases, tmp_path))
    with pytest.raises(Exception, match="(?i)not supported|unsupported"):
        run_stream(ranked, str(tmp_path / "run"), mode, keys=["start", "item"])


def test_best_sellers_of_a_stream(spark, purchases, tmp_path):
    stored = run_stream(op.best_sellers(as_stream(spark, purchases, tmp_path)), str(tmp_path / "run"), "complete")
    assert rows(stored) == rows(op.best_sellers(purchases))


def test_ranking_function_on_a_stream_is_refused(spark, purchases, tmp_path):
    totals = op.window_totals(as_stream(spark, purchases, tmp_path), "time", "1 day", "quantity", keys=["item"])
    with pytest.raises(Exception, match="NON_TIME_WINDOW_NOT_SUPPORTED_IN_STREAMING"):
        run_stream(op.top_per_window(totals, "item"), str(tmp_path / "run"), "complete")


def test_top_per_day(spark, purchases, tmp_path):
    def build(frame):
        return op.window_totals(frame, "time", "1 day", "quantity", keys=["item"])

    best = op.top_per_window(build(purchases), "item")
    assert rows(rebound(best)) == [
        (day("2019-02-28"), day("2019-03-01"), "Watch", 10),
        (day("2019-03-01"), day("2019-03-02"), "iPad", 6),
    ]
    stored = run_stream(
        build(as_stream(spark, purchases, tmp_path)), str(tmp_path / "run"), "complete",
        finish=lambda whole: op.top_per_window(whole, "item"),
    )
    assert rows(stored) == rows(best)


def test_top_per_window_breaks_ties_by_name(spark):
    totals = spark.createDataFrame(
        [(1, 2, "b", 5), (1, 2, "a", 5), (1, 2, "c", 4), (2, 3, "z", None)], "start INT, end INT, item STRING, total INT"
    )
    assert rows(op.top_per_window(totals, "item")) == [(1, 2, "a", 5), (2, 3, "z", None)]


def test_one_record_falls_into_24_sliding_windows(purchases):
    first = purchases.where("quantity = 1")
    windows = sorted(map(tuple, rebound(op.sliding_totals(first, "time", "1 day", "1 hour", "quantity")).collect()))
    assert len(windows) == 24
    assert windows[0] == (day("2019-02-27T16:00:00"), day("2019-02-28T16:00:00"), 1)
    assert windows[-1] == (day("2019-02-28T15:00:00"), day("2019-03-01T15:00:00"), 1)


@pytest.mark.parametrize("length, slide", [("1 day", "1 hour"), ("30 minutes", "10 minutes"), ("1 hour", "1 hour")])
def test_sliding_in_panes_equals_the_plain_window(spark, length, slide):
    rng = random.Random(3)
    data = [
        (day("2024-03-01") + dt.timedelta(seconds=rng.randrange(100_000)), rng.choice("abc"),
         rng.choice([None, 1, 2, 7]))
        for _ in range(300)
    ] + [(day("2024-03-01T05:00:00"), "a", 3), (day("1969-12-31T23:59:59"), "a", 1), (None, "a", 9)]
    frame = spark.createDataFrame(data, "time TIMESTAMP, item STRING, quantity INT")
    plain = op.window_totals(frame, "time", length, "quantity", slide=slide, keys=["item"])
    assert rows(op.sliding_totals(frame, "time", length, slide, "quantity", keys=["item"])) == rows(plain)


def test_sliding_stream_keeps_panes_as_state(spark, purchases, tmp_path):
    panes = op.pane_totals(as_stream(spark, purchases, tmp_path), "time", "1 hour", "quantity", keys=["item"])
    seen = []
    stored = run_stream(
        panes, str(tmp_path / "run"), "complete",
        finish=lambda whole: op.slide_panes(whole, "1 day", "1 hour", keys=["item"]),
        on_query=lambda q: seen.append(q.lastProgress.stateOperators[0].numRowsTotal),
    )
    assert rows(stored) == rows(op.sliding_totals(purchases, "time", "1 day", "1 hour", "quantity", keys=["item"]))
    assert seen == [3]  # three panes, not 72 windows


def test_sliding_append_emits_closed_windows(spark, purchases, tmp_path):
    closed = op.sliding_totals_closed(
        as_stream(spark, purchases, tmp_path), "time", "1 day", "1 hour", "quantity", delay="10 minutes"
    )
    stored = run_stream(closed, str(tmp_path / "run"))
    everything = op.sliding_totals(purchases, "time", "1 day", "1 hour", "quantity")
    last = purchases.agg(F.max("time")).first()[0] - dt.timedelta(minutes=10)
    assert rows(stored) == rows(everything.where(F.col("end") <= F.lit(last)))


def test_window_bounds_of_zoneless_times_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        frame = spark.sql("select timestamp_ntz'2024-01-01 03:00:00' as time, 1 as quantity")
        bounds = op.window_totals(frame, "time", "1 day", "quantity").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert bounds.start == day("2024-01-01")


def test_processing_time_window(spark, tmp_path):
    frame = spark.createDataFrame([("abc",), ("abc",), ("", ), (None,)], "value STRING")
    stored = run_stream(
        op.processing_time_chars(as_stream(spark, frame, tmp_path)), str(tmp_path / "run"), "complete"
    )
    assert stored.columns == ["start", "end", "value", "length"]
    assert rows(stored, "value", "length") == [("", 0), ("abc", 6), (None, None)]
    assert stored.select("start", "end").distinct().count() == 1
    assert stored.selectExpr("max(end - start) = interval 10 seconds").first()[0]
