"""Tables cut into stretches of time in one pass and fed one after the other."""

import datetime as dt

import pytest
from frames import rows
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.session import entries
from millrace.streaming import feed_slices, number_by_time, run_stream, slice_manifest, sliced_stream, write_slices
from millrace.streaming.backlog import SLICE

DAY = dt.datetime(2024, 1, 1)


def events(spark, count=3000, hot=0):
    """Rows out of time order, ``hot`` of them at one moment, some without a time."""
    df = spark.range(count).withColumn("n", F.pmod(F.xxhash64("id"), F.lit(86400 * 5)))
    at = F.when(F.col("id") < hot, F.lit(100_000)).when(F.col("id") % 97 == 1, None).otherwise(F.col("n"))
    return df.select("id", (F.lit(DAY) + F.make_dt_interval(secs=at)).alias("t"), (F.col("id") % 3).alias("k"))


def numbers(df):
    return number_by_time(df, "t", rows_each=500, least=3)


def test_slices_follow_each_other_and_hold_every_row(spark, tmp_path):
    df = events(spark)
    write_slices(numbers(df), "t", str(tmp_path))
    found = slice_manifest(spark, str(tmp_path)).collect()
    assert len(found) == 6 and sum(r.rows for r in found) == 3000
    assert all(a.high < b.low for a, b in zip(found, found[1:]))
    assert max(r.rows for r in found) < 700
    assert rows(spark.read.parquet(f"{tmp_path}/slices").select("id", "t", "k")) == rows(df)


def test_equal_times_share_a_slice(spark, tmp_path):
    df = events(spark, hot=1000)
    write_slices(numbers(df), "t", str(tmp_path))
    found = slice_manifest(spark, str(tmp_path)).collect()
    assert all(a.high < b.low for a, b in zip(found, found[1:])) and max(r.rows for r in found) >= 1000
    assert numbers(df.where("id < 1000 AND k >= 0")).select(SLICE).distinct().count() == 1


@pytest.mark.parametrize("condition", ["false", "t IS NULL"])
def test_tables_without_times(spark, tmp_path, condition):
    df = events(spark).where(condition)
    write_slices(numbers(df), "t", str(tmp_path))
    stored = feed_slices(
        spark, str(tmp_path), lambda: run_stream(sliced_stream(spark, str(tmp_path), df.schema), str(tmp_path / "run"))
    )
    assert stored.count() == df.count()


def test_the_table_is_read_once(spark, tmp_path):
    events(spark).write.parquet(str(tmp_path / "table"))
    numbered = numbers(spark.read.parquet(str(tmp_path / "table")))
    plan = numbered.hint("rebalance", F.col(SLICE))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "BroadcastHashJoin" in plan


def counted(spark, place, df, crash=()):
    write_slices(numbers(df), "t", place)
    seen, crash = [], list(crash)

    def run():
        stream = sliced_stream(spark, place, df.schema)
        stored = run_stream(op.late_safe_counts(stream, "t", "k", "10 minutes", "1 hour"), f"{place}/run")
        seen.append((entries(spark, f"{place}/in"), entries(spark, f"{place}/slices")))
        if len(seen) in crash:
            crash.remove(len(seen))
            raise RuntimeError("driver lost")
        return stored

    return seen, run


def expected(df):
    per_hour = df.groupBy(F.window("t", "1 hour"), "k").count().select("window.*", "k", "count")
    last = df.agg(F.max("t")).first()[0] - dt.timedelta(minutes=10)
    return rows(per_hour.where(F.col("end") <= F.lit(last)))


def test_no_row_is_late_and_one_slice_is_watched_at_a_time(spark, tmp_path):
    df = events(spark).withColumn("t", F.col("t").cast("timestamp"))
    seen, run = counted(spark, str(tmp_path), df)
    assert rows(feed_slices(spark, str(tmp_path), run)) == expected(df)
    assert len(seen) == 6 and all(len(watched) == 1 for watched, _ in seen)
    assert len(entries(spark, f"{tmp_path}/done")) == 6 and not entries(spark, f"{tmp_path}/in")


def test_a_feed_that_broke_off_goes_on(spark, tmp_path):
    df = events(spark).withColumn("t", F.col("t").cast("timestamp"))
    seen, run = counted(spark, str(tmp_path), df, crash=[2, 4])
    for _ in range(2):
        with pytest.raises(RuntimeError, match="driver lost"):
            feed_slices(spark, str(tmp_path), run)
    assert rows(feed_slices(spark, str(tmp_path), run)) == expected(df)
    assert len(seen) == 8  # two slices came twice
    assert rows(feed_slices(spark, str(tmp_path), run)) == expected(df)  # nothing left to feed
