"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS (timed
runs after one warm-up, the median counts), BENCH_ONLY (comma-separated names).
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import functions as F

from millrace import build_session
from millrace.operators import hot_layout, join_tables
from millrace.plans.queries import QUERIES
from millrace.sources import table

HEADLINE = [
    "src_csv_stream",
    "json_expand",
    "kafka_decode",
    "json_build",
    "filter_default",
    "agg_stats",
    "agg_count_by",
    "join_inner",
    "join_right",
    "join_full",
    "join_anti",
    "ss_static_inner",
    "ss_static_left",
    "stream_stream_inner",
    "stream_interval_inner",
    "stream_interval_left",
    "stream_interval_full",
    "stream_count_by",
    "mode_update_agg",
    "win_tumbling_sum",
    "win_best_seller",
    "win_top1_per_day",
    "win_sliding_sum",
    "win_top1_sliding",
    "win_sliding_append",
    "proc_time_chars",
    "wm_count",
    "sink_upsert",
    "batch_best_seller",
    "batch_top1_per_day",
    "batch_sliding_sum",
    "batch_top1_sliding",
    "batch_interval_left",
    "batch_interval_full",
    "lines_top1",
    "lines_static_inner",
    "lines_stream_inner",
    "files_json_messages",
    "late_rows",
    "progress_event_time",
    "join_left",
    "join_semi",
    "ss_static_semi",
    "ss_static_anti",
    "stream_interval_right",
    "stream_interval_semi",
    "batch_wm_count",
    "batch_interval_inner",
    "batch_interval_right",
    "batch_interval_semi",
    "mode_append_rows",
    "sink_row_writer",
    "sink_upsert_compacted",
    "sink_row_writer_repeated",
    "win_top1_closed",
    "win_top1_sliding_closed",
    "state_open_windows",
    "lines_schema_kept",
    "ckpt_edited_file",
]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def skewed_join(spark, folder: str) -> float:
    """Orders, a third of which belong to one customer, joined with customers over salts."""
    orders = table(spark, folder, "orders")
    orders = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")))
    start = time.perf_counter()
    layout = hot_layout(orders, "o_custkey")
    joined = join_tables(orders, table(spark, folder, "customer"), "o_custkey", "c_custkey", "left", hot=layout.hot, salts=layout.salts)
    joined.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name] or HEADLINE
    extra = dict(pair.split("=", 1) for pair in os.environ.get("BENCH_CONF", "").split(",") if pair)
    spark = build_session(
        "millrace-bench",
        f"local[{cpus}]",
        shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "4")),
        log_level="ERROR",
        checkpoint_dir=os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="millrace-bench-"),
        large_state=os.environ.get("BENCH_STATE") == "rocksdb",
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "8g", **extra},
    )
    seconds = {}
    for name in names:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
    if not os.environ.get("BENCH_ONLY"):
        skewed_join(spark, folder)
        seconds["skewed_join_left"] = round(statistics.median(skewed_join(spark, folder) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
