import datetime as dt
import itertools
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from frames import as_stream, rows
from pyspark.sql import functions as F

import samples
from millrace import operators as op
from millrace.schemas import BANDS, GUITAR_PLAYERS
from millrace.streaming import progress_frame, run_stream


@pytest.fixture(scope="module")
def bands(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("bands") / "bands.json"
    path.write_text(samples.BANDS)
    return spark.read.schema(BANDS).json(str(path)).select(
        F.col("id").alias("band_id"), F.col("name").alias("band_name"), "hometown"
    )


@pytest.fixture(scope="module")
def players(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("players") / "players.json"
    path.write_text(samples.PLAYERS)
    return spark.read.schema(GUITAR_PLAYERS).json(str(path)).select("id", "name", "guitars", "band")


KINDS = {"inner": 3, "left": 4, "right": 4, "full": 5, "left_semi": 3, "left_anti": 1}


@pytest.mark.parametrize("how, count", list(KINDS.items()))
def test_join_tables(players, bands, how, count):
    joined = op.join_tables(players, bands, "band", "band_id", how)
    plain = players.join(bands, players.band == bands.band_id, how)
    assert joined.count() == count
    assert joined.columns == plain.columns
    assert rows(joined) == rows(plain)


def test_anti_join_finds_the_player_without_a_band(players, bands):
    assert rows(op.join_tables(players, bands, "band", "band_id", "anti"), "name") == [("Cleo Marsh",)]


@pytest.mark.parametrize("how", KINDS)
def test_join_tables_with_nulls_and_repeated_keys(spark, how):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (5, "d")], "k INT, l STRING")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (9, "w"), (9, "v")], "q INT, r STRING")
    joined = op.join_tables(left, right, "k", "q", how)
    assert rows(joined) == rows(left.join(right, left.k == right.q, how))


def test_unknown_join_type(players, bands):
    with pytest.raises(ValueError, match="unknown join type"):
        op.join_tables(players, bands, "band", "band_id", "right_semi")


def test_no_forced_broadcast(spark, players, bands):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = op.join_tables(players, bands, "band", "band_id", "full")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and plan.count("FullOuter") > 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_stream_static(spark, players, bands, tmp_path, how):
    joined = op.join_stream_static(as_stream(spark, players, tmp_path), bands, "band", "band_id", how)
    assert rows(run_stream(joined, str(tmp_path / "run"))) == rows(
        players.join(bands, players.band == bands.band_id, how)
    )


@pytest.mark.parametrize("how", ["inner", "right"])
def test_static_stream(spark, players, bands, tmp_path, how):
    joined = op.join_stream_static(players, as_stream(spark, bands, tmp_path), "band", "band_id", how)
    assert rows(run_stream(joined, str(tmp_path / "run"))) == rows(
        players.join(bands, players.band == bands.band_id, how)
    )


ALL = ["inner", "left", "right", "full", "left_semi", "left_anti"]


@pytest.mark.parametrize("pairing, how", list(itertools.product(["stream-static", "static-stream"], ALL)))
def test_stream_static_legality(spark, players, bands, tmp_path, pairing, how):
    """The table of legal joins is what Spark itself accepts."""
    left, right = players, bands
    if pairing == "stream-static":
        left = as_stream(spark, left, tmp_path)
    else:
        right = as_stream(spark, right, tmp_path)
    if how in op.STREAM_JOINS[pairing]:
        run_stream(left.join(right, F.col("band") == F.col("band_id"), how), str(tmp_path / "run"))
        return
    with pytest.raises(ValueError, match="not possible"):
        op.join_stream_static(left, right, "band", "band_id", how)
    with pytest.raises(Exception, match="(?i)not supported|unsupported"):
        run_stream(left.join(right, F.col("band") == F.col("band_id"), how), str(tmp_path / "run"))


def test_streams_without_a_range(spark, players, bands, tmp_path):
    left, right = as_stream(spark, players, tmp_path), as_stream(spark, bands, tmp_path)
    with pytest.raises(ValueError, match="unbounded_state"):
        op.join_streams(left, right, "band", "band_id")
    joined = op.join_streams(left, right, "band", "band_id", unbounded_state=True, hot=[1], salts=4)
    expected = rows(players.join(bands, players.band == bands.band_id))
    assert rows(run_stream(joined, str(tmp_path / "run"))) == expected


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_streams_join_in_append_mode_only(spark, players, bands, tmp_path, mode):
    left, right = as_stream(spark, players, tmp_path), as_stream(spark, bands, tmp_path)
    joined = op.join_streams(left, right, "band", "band_id", unbounded_state=True)
    with pytest.raises(Exception, match="(?i)not supported|unsupported"):
        run_stream(joined, str(tmp_path / "run"), mode, keys=["band"])


@pytest.mark.parametrize("how", [kind for kind in ALL if kind != "inner"])
def test_streams_without_a_range_allow_inner_only(spark, players, bands, tmp_path, how):
    left, right = as_stream(spark, players, tmp_path), as_stream(spark, bands, tmp_path)
    with pytest.raises(ValueError, match="not possible"):
        op.join_streams(left, right, "band", "band_id", how, unbounded_state=True)
    with pytest.raises(Exception, match="(?i)not supported|unsupported|watermark"):
        run_stream(left.join(right, F.col("band") == F.col("band_id"), how), str(tmp_path / "run"))


HOUR = 3600
START = dt.datetime(2024, 1, 1)


def _views_and_buys(spark, hot_share):
    """Two hours' ranges over a few days; one user holds ``hot_share`` of the rows."""
    rng = random.Random(7)

    def side(count, width):
        out = []
        for number in range(count):
            user = 1 if rng.random() < hot_share else rng.choice([2, 3, 4, 5, None])
            out.append((number, user, START + dt.timedelta(seconds=rng.randrange(width))))
        return out

    left = side(400, 4 * 24 * HOUR)
    right = side(300, 4 * 24 * HOUR)
    # rows exactly on a stretch boundary and exactly at both ends of the range
    left += [(1000, 1, START + dt.timedelta(hours=2)), (1001, 9, START + dt.timedelta(hours=3))]
    right += [(2000, 1, START + dt.timedelta(hours=4)), (2001, 9, START + dt.timedelta(hours=3)),
              (2002, 9, START + dt.timedelta(hours=5)), (2003, 9, START + dt.timedelta(hours=5, seconds=1))]
    return (
        spark.createDataFrame(left, "view BIGINT, v_user INT, v_ts TIMESTAMP"),
        spark.createDataFrame(right, "buy BIGINT, b_user INT, b_ts TIMESTAMP"),
    )


RANGE = dict(left_time="v_ts", right_time="b_ts", within=2 * HOUR, delay="10 minutes")


def _brute_force(left, right, how):
    """All pairs in plain Python, then the rows an append query may emit by the end."""
    lefts = [tuple(r) for r in left.collect()]
    rights = [tuple(r) for r in right.collect()]
    span = dt.timedelta(hours=2)
    pairs = [a + b for a in lefts for b in rights
             if a[1] is not None and a[1] == b[1] and a[2] <= b[2] <= a[2] + span]
    closed = min(max(r[2] for r in lefts), max(r[2] for r in rights)) - dt.timedelta(minutes=10)
    met_left, met_right = {p[0] for p in pairs}, {p[3] for p in pairs}
    lone_left = [a + (None,) * 3 for a in lefts if a[0] not in met_left and a[2] + span < closed]
    lone_right = [(None,) * 3 + b for b in rights if b[0] not in met_right and b[2] < closed]
    return {
        "inner": pairs,
        "left": pairs + lone_left,
        "right": pairs + lone_right,
        "full": pairs + lone_left + lone_right,
        "left_semi": [a for a in lefts if a[0] in met_left],
    }[how]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi"])
def test_interval_join_with_a_hot_key(spark, tmp_path, how):
    left, right = _views_and_buys(spark, hot_share=0.4)
    hot = op.hot_keys(left, "v_user", 0.3)
    assert hot == [1]
    joined = op.join_streams(
        as_stream(spark, left, tmp_path), as_stream(spark, right, tmp_path),
        "v_user", "b_user", how, hot=hot, salts=5, **RANGE,
    )
    expected = _brute_force(left, right, how)
    assert rows(run_stream(joined, str(tmp_path / "run"))) == sorted(expected, key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi"])
def test_interval_join_of_bounded_frames(spark, how):
    left, right = _views_and_buys(spark, hot_share=0.4)
    joined = op.join_streams(left, right, "v_user", "b_user", how, hot=[1], salts=5, **RANGE)
    near = (F.col("b_ts") >= F.col("v_ts")) & (F.col("b_ts") <= F.col("v_ts") + F.expr("INTERVAL 2 HOURS"))
    plain = left.join(right, (F.col("v_user") == F.col("b_user")) & near, how)
    assert rows(joined) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_interval_join_of_zoneless_times_across_a_clock_change(spark, how):
    left, right = _views_and_buys(spark, hot_share=0.4)
    moved = F.expr("INTERVAL 69 DAYS")  # 9 to 13 March 2024; New York skips an hour on the 10th
    left = left.withColumn("v_ts", F.col("v_ts").cast("timestamp_ntz") + moved)
    right = right.withColumn("b_ts", F.col("b_ts").cast("timestamp_ntz") + moved)
    left, right = (spark.createDataFrame(side.collect(), side.schema) for side in (left, right))
    near = (F.col("b_ts") >= F.col("v_ts")) & (F.col("b_ts") <= F.col("v_ts") + F.expr("INTERVAL 2 HOURS"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        joined = rows(op.join_streams(left, right, "v_user", "b_user", how, **RANGE))
        plain = rows(left.join(right, (F.col("v_user") == F.col("b_user")) & near, how))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert joined == plain


def _in_time_order(spark, df, time_column, folder, cuts):
    """A stream that delivers the rows in batches of rising time, one file each."""
    folder.mkdir()
    ordered = df.orderBy(time_column).toPandas()
    edges = [ordered[time_column].min() + (ordered[time_column].max() - ordered[time_column].min()) * i / cuts
             for i in range(1, cuts)]
    part = ordered[time_column].map(lambda at: sum(at > edge for edge in edges))
    for number in range(cuts):
        chunk = spark.createDataFrame(ordered[part == number], df.schema).toPandas()
        target = folder / f"{number}.parquet"
        table = pa.Table.from_pandas(chunk, preserve_index=False)
        fields = [pa.field(f.name, {"bigint": pa.int64(), "int": pa.int32()}.get(
            f.dataType.simpleString(), pa.timestamp("us", "UTC"))) for f in df.schema]
        pq.write_table(table.cast(pa.schema(fields)), target)
        os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


@pytest.mark.parametrize("how", ["inner", "full", "left_semi"])
def test_interval_join_over_many_batches(spark, tmp_path, how):
    left, right = _views_and_buys(spark, hot_share=0.4)
    left, right = left.where("v_user is not null"), right.where("b_user is not null")
    reports = []
    joined = op.join_streams(
        _in_time_order(spark, left, "v_ts", tmp_path / "l", 3), _in_time_order(spark, right, "b_ts", tmp_path / "r", 3),
        "v_user", "b_user", how, hot=[1], salts=3, **RANGE,
    )
    stored = run_stream(joined, str(tmp_path / "run"), on_query=lambda q: reports.extend(q.recentProgress))
    facts = progress_frame(spark, reports).agg(F.count_if(F.col("input_rows") > 0), F.sum("late_rows")).first()
    assert facts[0] == 3 and facts[1] == 0
    assert rows(stored) == sorted(_brute_force(left, right, how), key=repr)


@pytest.mark.parametrize("hot", [(), (1,)])
def test_a_full_join_by_one_stateful_join(spark, tmp_path, hot):
    """Many batches, equal rows, and lone rows near both ends of a stretch."""
    left, right = _views_and_buys(spark, hot_share=0.4)
    left, right = left.where("v_user is not null"), right.where("b_user is not null")
    right = right.unionByName(right.where(F.pmod(F.xxhash64(*right.columns), F.lit(3)) == 0))
    seen = []

    def join(lefts, rights):
        return op.full_interval_join(lefts, rights, "v_user", "b_user", hot=hot, salts=3, **RANGE)

    stored = run_stream(
        join(_in_time_order(spark, left, "v_ts", tmp_path / "l", 4), _in_time_order(spark, right, "b_ts", tmp_path / "r", 4)),
        str(tmp_path / "run"), read=lambda raw: op.settle_full(raw, right.columns), on_query=seen.append,
    )
    plan = seen[0]._jsq.explainInternal(False)
    assert plan.count("StreamingSymmetricHashJoin") == 1 and len(seen[0].lastProgress.stateOperators) == 1
    assert rows(stored) == sorted(_brute_force(left, right, "full"), key=repr)
    near = (F.col("b_ts") >= F.col("v_ts")) & (F.col("b_ts") <= F.col("v_ts") + F.expr("INTERVAL 2 HOURS"))
    plain = left.join(right, (F.col("v_user") == F.col("b_user")) & near, "full")
    assert rows(op.settle_full(join(left, right), right.columns)) == rows(plain)


def test_interval_join_has_no_anti(spark, tmp_path):
    left, right = _views_and_buys(spark, 0.4)
    left, right = as_stream(spark, left, tmp_path), as_stream(spark, right, tmp_path)
    with pytest.raises(ValueError, match="not possible"):
        op.join_streams(left, right, "v_user", "b_user", "left_anti", **RANGE)
    with pytest.raises(ValueError, match="both time columns"):
        op.join_streams(left, right, "v_user", "b_user", within=60)
    with pytest.raises(ValueError, match="watermark delay"):
        op.join_streams(left, right, "v_user", "b_user", left_time="v_ts", right_time="b_ts", within=60)
    marked = left.withWatermark("v_ts", "1 minute"), right.withWatermark("b_ts", "1 minute")
    near = (F.col("b_ts") >= F.col("v_ts")) & (F.col("b_ts") <= F.col("v_ts") + F.expr("INTERVAL 2 HOURS"))
    with pytest.raises(Exception, match="(?i)not supported|unsupported"):
        run_stream(
            marked[0].join(marked[1], (F.col("v_user") == F.col("b_user")) & near, "left_anti"), str(tmp_path / "run")
        )


def test_hot_rows_are_dealt_over_many_groups(spark, tmp_path):
    left, right = _views_and_buys(spark, hot_share=0.9)
    joined = op.join_streams(left, right, "v_user", "b_user", hot=[1], salts=8, **RANGE)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_lsalt" in plan and "_lslot" in plan


def test_hot_keys_are_few(spark):
    frame = spark.range(1000).selectExpr("if(id < 400, 1, id) as k")
    assert op.hot_keys(frame, "k", 0.3) == [1]
    assert op.hot_keys(frame, "k", 0.5) == []
    nulls = spark.range(10).selectExpr("cast(null as bigint) as k")
    assert op.hot_keys(nulls, "k") == []
