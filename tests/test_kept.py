"""What is kept beside a checkpoint: typed hot keys and inferred schemas; state and late rows read back."""

import datetime as dt
from decimal import Decimal

import pytest
from frames import rows
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.session import read_text
from millrace.sources import read_table
from millrace.streaming import (
    StateLayout,
    check_schema,
    kept_schema,
    observed,
    run_stream,
    state_layout,
    state_rows,
    stored_progress,
    watermark_in_force,
)

KEYS = {
    "STRING": ("a", "b'ab'"),
    "BIGINT": (1, -5),
    "BINARY": (b"ab", b"\x00\xff"),
    "DATE": (dt.date(2024, 2, 29), dt.date(1, 1, 1)),
    "TIMESTAMP_NTZ": (dt.datetime(2024, 2, 29, 1, 2, 3, 4), dt.datetime(1970, 1, 1)),
    "DECIMAL(9,3)": (Decimal("1.500"), Decimal("-2.000")),
    "DOUBLE": (0.1, -1e300),
    "BOOLEAN": (True, False),
}


@pytest.mark.parametrize("kind", KEYS)
def test_hot_keys_come_back_with_their_type(spark, tmp_path, kind):
    layout = StateLayout(KEYS[kind], 3)
    assert state_layout(spark, str(tmp_path), lambda: layout) == layout
    found = state_layout(spark, str(tmp_path), lambda: None)
    assert found == layout and [type(v) for v in found.hot] == [type(v) for v in layout.hot]


def test_other_key_types_are_refused(spark, tmp_path):
    with pytest.raises(TypeError, match="tuple"):
        state_layout(spark, str(tmp_path), lambda: StateLayout(((1, 2),), 3))


@pytest.mark.parametrize("kind", ["BINARY", "DATE"])
def test_a_resumed_join_meets_the_state_of_its_hot_keys(spark, tmp_path, kind):
    """Rows of the second run join rows that the first one left in the state."""
    place, hot = str(tmp_path / "run"), KEYS[kind][0]

    def add(run):
        left = spark.createDataFrame([(hot, 10 * run + k) for k in range(9)], f"a {kind}, x INT")
        right = spark.createDataFrame([(hot, run)], f"b {kind}, y INT")
        left.write.mode("append").parquet(str(tmp_path / "a"))
        right.write.mode("append").parquet(str(tmp_path / "b"))

    def run():
        left = spark.readStream.schema(f"a {kind}, x INT").parquet(str(tmp_path / "a"))
        right = spark.readStream.schema(f"b {kind}, y INT").parquet(str(tmp_path / "b"))
        layout = state_layout(spark, place, lambda: StateLayout((hot,), 4))
        joined = op.join_streams(left, right, "a", "b", unbounded_state=True, hot=layout.hot, salts=layout.salts)
        return run_stream(joined.select("x", "y"), place, layout=layout)

    for number in range(2):
        add(number)
        stored = run()
    assert rows(stored) == sorted(((10 * r + k, y) for r in range(2) for k in range(9) for y in range(2)), key=repr)


def test_a_schema_is_inferred_once(spark, tmp_path):
    place, path, calls = str(tmp_path / "run"), tmp_path / "lines", []
    path.mkdir()
    (path / "1.json").write_text('{"id": 1, "name": "a"}\n')

    def infer():
        calls.append(1)
        return read_table(spark, "json", str(path)).schema

    first = kept_schema(spark, place, infer)
    (path / "2.json").write_text('{"id": "two", "more": 1}\n')
    assert kept_schema(spark, place, infer) == first and calls == [1]
    assert infer() != first
    with pytest.raises(ValueError, match="another schema"):
        check_schema(spark, place, infer())
    check_schema(spark, place, first)
    stream = spark.readStream.schema(first).json(str(path))
    with pytest.raises(ValueError, match="another schema"):
        run_stream(stream, place, schema=infer())
    assert run_stream(stream, place, schema=first).count() == 2
    assert read_text(spark, f"{place}/schema.json") == first.json()


SECONDS = [[7, 8], [14], [9, 9, 15, 8], [13], [21], [4, 4, 17]]  # one list of event times per run


def replay(spark, tmp_path, watched):
    """One run per list over one checkpoint, many equal rows in one task."""
    place = str(tmp_path / "run")
    for number, times in enumerate(SECONDS):
        lines = [(dt.datetime.fromtimestamp(t, dt.timezone.utc), "c") for t in times for _ in range(50)]
        frame = spark.createDataFrame(lines, "created TIMESTAMP, color STRING").coalesce(1)
        frame.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
        watched.append(watermark_in_force(spark, f"{place}/checkpoint"))
        counts = op.late_safe_counts(stream, watermark=watched[-1] or 0)
        stored = run_stream(counts, place, progress=True)
    return place, stored


def test_late_rows_are_counted_one_by_one(spark, tmp_path):
    place, stored = replay(spark, tmp_path, marks := [])
    assert marks == [None, 6000, 12000, 13000, 13000, 19000]
    late = observed(spark, place, op.LATE, "rows BIGINT").where("rows > 0").orderBy("batch_id")
    assert [r.rows for r in late.collect()] == [150, 150]  # 9, 9 and 8; then 4, 4 and 17
    sums = stored_progress(spark, place).agg(F.sum("late_rows")).first()[0]
    assert 0 < sums < 300  # Spark's own figure counts sums per task
    closed = [(r["end"].timestamp(), r["count"]) for r in stored.orderBy("end").collect()]
    assert closed == [(8.0, 50), (10.0, 50), (14.0, 50), (16.0, 100)]


def test_the_state_holds_open_windows_only(spark, tmp_path):
    place, _ = replay(spark, tmp_path, [])
    held = state_rows(spark, f"{place}/checkpoint")
    held = held.select(F.unix_seconds("key.window.end").alias("end"), "key.color", "value.count")
    assert rows(held) == [(22, "c", 50)]


def test_best_items_equal_their_ranked_form(spark):
    """Ties go to the first name, unknown totals come last; on a bounded frame all windows are there."""
    lines = [(0, "b", 2.0), (1, "a", 2.0), (2, "c", None), (4000, "x", None), (4001, "w", None), (9000, "n", -1.0), (9000, "z", 0.0)]
    frame = spark.createDataFrame(lines, "s LONG, item STRING, quantity DOUBLE").withColumn("time", F.timestamp_seconds("s"))
    for best, totals in (
        (
            op.top_closed(frame, "time", "1 hour", "quantity", "item", delay="1 minute"),
            op.window_totals(frame, "time", "1 hour", "quantity", keys=["item"]),
        ),
        (
            op.top_sliding_closed(frame, "time", "2 hours", "1 hour", "quantity", "item", delay="1 minute"),
            op.sliding_totals(frame, "time", "2 hours", "1 hour", "quantity", keys=["item"]),
        ),
    ):
        assert rows(best) == rows(op.top_per_window(totals, "item").select("start", "end", "item", "total"))


def test_state_of_best_items_falls(spark):
    from millrace.plans import queries

    places = []

    def build(events, place):
        return op.top_closed(queries.purchases(events), "time", "1 day", "quantity", "item", delay="10 minutes")

    queries.drained_in_slices(spark, "/root/testdata/sf0.001", "best", build, watch=places.append, progress=True)
    states = [r.state_rows for r in stored_progress(spark, places[0]).orderBy("batch_id").collect()]
    assert states[-1] < max(states)
