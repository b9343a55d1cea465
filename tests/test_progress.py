import json
import time

from frames import as_stream

from millrace.streaming import ProgressLog, event_time_line, progress_frame, run_stream, watch


class Quiet:
    lastProgress = None
    isActive = True


def test_no_report_yet():
    assert event_time_line(Quiet()) == "[]"


def test_watch_ends_with_the_query_or_the_count():
    seen = []
    watch(Quiet(), times=3, every=0, show=seen.append)
    assert seen == ["1: []", "2: []", "3: []"]
    ended = Quiet()
    ended.isActive = False
    watch(ended, times=100, every=0, show=seen.append)
    assert seen[3:] == ["1: []"]


def test_reports_of_a_run(spark, tmp_path):
    frame = spark.sql("select timestamp'2024-01-01 00:00:07Z' as t union all select timestamp'2024-01-01 00:00:08Z'")
    stream = as_stream(spark, frame, tmp_path).withWatermark("t", "2 seconds")
    log, lines, reports = ProgressLog(), [], []
    spark.streams.addListener(log)
    try:
        counts = stream.groupBy("t").count()

        def look(query):
            lines.append(event_time_line(query))
            reports.extend(query.recentProgress)

        run_stream(counts, str(tmp_path / "run"), on_query=look)
        deadline = time.time() + 20
        while not log.ended and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert json.loads(lines[0])["watermark"] == "2024-01-01T00:00:06.000Z"
    first = progress_frame(spark, reports).orderBy("batch_id").first()
    assert (first.batch_id, first.input_rows, first.late_rows) == (0, 2, 0)
    assert str(first.max_time) == "2024-01-01 00:00:08" or first.max_time is not None
    assert len(log.reports) == len(reports) and len(log.ended) == 1


def test_reports_without_event_time(spark, tmp_path):
    reports = []
    run_stream(as_stream(spark, spark.range(3).toDF("n"), tmp_path), str(tmp_path / "run"),
               on_query=lambda q: reports.extend(q.recentProgress))
    row = progress_frame(spark, reports).first()
    assert row.input_rows == 3 and row.max_time is None and row.state_rows == 0
