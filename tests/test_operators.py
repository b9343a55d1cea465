import pytest
from frames import as_stream, rows
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.plans import run_sql
from millrace.streaming import run_stream


@pytest.fixture(scope="module")
def cars(spark):
    return spark.createDataFrame(
        [("a", 90, "USA"), ("b", None, "Europe"), ("c", 150, None), ("d", 200, "USA")],
        "Name STRING, Horsepower BIGINT, Origin STRING",
    )


def test_differs_from_drops_nulls(cars):
    assert rows(op.differs_from(cars, "Origin", "USA"), "Name") == [("b",)]


def test_above_reads_missing_as_default(cars):
    assert rows(op.above(cars, "Horsepower", 140), "Name") == [("c",), ("d",)]
    assert rows(op.above(cars, "Horsepower", 140, default=141), "Name") == [("b",), ("c",), ("d",)]


def test_above_is_pushed_into_the_scan(spark, cars, tmp_path):
    cars.write.parquet(str(tmp_path / "cars"))
    plan = op.above(spark.read.parquet(str(tmp_path / "cars")), "Horsepower", 140)._jdf.queryExecution().toString()
    assert "GreaterThan(Horsepower,140)" in plan


def test_aggregates(cars):
    assert op.mean_of(cars, "Horsepower", "hp").first()[0] == pytest.approx(440 / 3)
    stats = op.spread_stats(cars, "Horsepower").first()
    assert (stats.total, stats.least, stats.greatest) == (440, 90, 200)
    assert stats.stddev == pytest.approx(55.0757, abs=1e-4)
    assert rows(op.count_by(cars, "Origin")) == [("Europe", 1), ("USA", 2), (None, 1)]
    assert op.count_where(cars, F.col("Horsepower") > 1000).first()[0] == 0


@pytest.mark.parametrize(
    "build",
    [
        lambda df: op.count_where(df, F.coalesce("Horsepower", F.lit(0)) > 140),
        lambda df: op.mean_of(df, "Horsepower", "hp"),
        lambda df: op.count_by(df, "Origin"),
    ],
)
@pytest.mark.parametrize("mode", ["complete", "update"])
def test_stream_aggregate_equals_batch(spark, cars, tmp_path, build, mode):
    stream = build(as_stream(spark, cars, tmp_path))
    keys = stream.columns[:1]
    assert rows(run_stream(stream, str(tmp_path / "run"), mode, keys=keys)) == rows(build(cars))


def test_weight_types(spark):
    frame = spark.createDataFrame([(3504,)], "Weight_in_lbs BIGINT")
    column = frame.select((F.col("Weight_in_lbs") / 2.2).alias("w"))
    text = frame.select(F.expr("Weight_in_lbs / 2.2").alias("w"))
    assert column.dtypes == [("w", "double")] and text.dtypes == [("w", "decimal(27,6)")]
    assert column.first()[0] == pytest.approx(1592.7272727272725)
    assert str(text.first()[0]) == "1592.727273"
    assert frame.selectExpr("Weight_in_lbs / 2.2").columns == ["(Weight_in_lbs / 2.2)"]


def test_run_sql(spark, cars, tmp_path):
    sql = "select Name from cars where Origin = 'USA'"
    assert rows(run_sql(spark, {"cars": cars}, sql)) == [("a",), ("d",)]
    stream = run_sql(spark, {"cars": as_stream(spark, cars, tmp_path)}, sql)
    assert stream.isStreaming
    assert rows(run_stream(stream, str(tmp_path / "run"))) == [("a",), ("d",)]


def test_show_and_schema(cars, capsys):
    cars.show()
    cars.printSchema()
    printed = capsys.readouterr().out
    assert "Horsepower" in printed and "|-- Origin: string (nullable = true)" in printed
