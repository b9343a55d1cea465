"""Time windows. Windows are aligned to 1970-01-01 UTC, whatever the first record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def window_totals(
    df: DataFrame,
    time: str,
    length: str,
    amount: str | Column,
    *,
    slide: str | None = None,
    keys: Sequence[str] = (),
    name: str = "total",
) -> DataFrame:
    """Sum per window (tumbling, or sliding with ``slide``) and keys.

    A sliding window copies every row ``length / slide`` times before the sum;
    ``sliding_totals`` avoids that.
    """
    return (
        df.groupBy(F.window(time, length, slide).alias("window"), *keys)
        .agg(F.sum(amount).alias(name))
        .select(
            F.col("window").getField("start").alias("start"),
            F.col("window").getField("end").alias("end"),
            *keys,
            name,
        )
    )


def best_sellers(
    df: DataFrame, time: str = "time", item: str = "item", quantity: str = "quantity", length: str = "1 day"
) -> DataFrame:
    """Quantity per window and item, largest first, unknown totals last."""
    totals = window_totals(df, time, length, quantity, keys=[item])
    return totals.orderBy(F.col("total").desc_nulls_last())


def top_per_window(totals: DataFrame, item: str, total: str = "total") -> DataFrame:
    """The best item of every window; equal totals go to the first name.

    Spark cuts each map task down to one row per window before the shuffle, so a
    window with very many items does not end up in one task. Needs a bounded
    frame: rank a stream inside ``run_stream(..., finish=...)``.
    """
    order = Window.partitionBy("start", "end").orderBy(F.col(total).desc_nulls_last(), F.col(item))
    return totals.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def pane_totals(
    df: DataFrame, time: str, slide: str, amount: str | Column, *, keys: Sequence[str] = ()
) -> DataFrame:
    """Sums per pane, the stretch of one slide that all windows take whole."""
    panes = window_totals(df, time, slide, amount, keys=keys, name="pane_total")
    return panes.select(F.col("start").alias("pane"), *keys, "pane_total")


def slide_panes(
    panes: DataFrame, length: str, slide: str, *, keys: Sequence[str] = (), name: str = "total"
) -> DataFrame:
    """Sliding sums from pane sums. The slide must divide the length."""
    return window_totals(panes, "pane", length, "pane_total", slide=slide, keys=keys, name=name)


def sliding_totals(
    df: DataFrame,
    time: str,
    length: str,
    slide: str,
    amount: str | Column,
    *,
    keys: Sequence[str] = (),
    name: str = "total",
) -> DataFrame:
    """Sliding sums over a bounded frame in two steps.

    Rows are first summed per pane; only those few sums are then copied into the
    windows they belong to, instead of every row. On a stream keep ``pane_totals``
    as the state and apply ``slide_panes`` when finishing a batch.
    """
    panes = pane_totals(df, time, slide, amount, keys=keys)
    return slide_panes(panes, length, slide, keys=keys, name=name)


def sliding_totals_closed(
    df: DataFrame,
    time: str,
    length: str,
    slide: str,
    amount: str | Column,
    *,
    delay: str,
    keys: Sequence[str] = (),
    name: str = "total",
) -> DataFrame:
    """Sliding sums of a stream in append mode: each window once, when it is closed.

    Two chained aggregates under one watermark. The first holds open panes only,
    the second open windows only, so the state does not grow with the history.
    ``time`` must be a zoned timestamp.
    """
    panes = (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, slide).alias("pane"), *keys)
        .agg(F.sum(amount).alias("pane_total"))
    )
    return (
        panes.groupBy(F.window("pane", length, slide).alias("window"), *keys)
        .agg(F.sum("pane_total").alias(name))
        .select("window.*", *keys, name)
    )


def processing_time_chars(lines: DataFrame, length: str = "10 seconds", column: str = "value") -> DataFrame:
    """Characters per line text and arrival window; arrival is fixed per micro-batch."""
    stamped = lines.select(column, F.current_timestamp().alias("processing_time"))
    return window_totals(
        stamped, "processing_time", length, F.length(column), keys=[column], name="length"
    )


LATE = "late"


def late_safe_counts(
    df: DataFrame,
    time: str = "created",
    key: str = "color",
    delay: str = "2 seconds",
    length: str = "2 seconds",
    *,
    watermark: int | None = None,
) -> DataFrame:
    """Rows per window and key with a watermark, so that windows close and leave the state.

    ``time`` must be a zoned timestamp. With ``watermark``, the one in force in milliseconds
    (``watermark_in_force``), the rows of windows that it has closed are counted as they come
    in, as the observed metric ``late.rows``: just those that the aggregate turns away. Spark's
    own figure counts the sums that each task has made of them. The metric holds for one
    batch, so drain one batch per start.
    """
    rows = df.withWatermark(time, delay).withColumn("window", F.window(time, length))
    if watermark is not None:
        closed = F.unix_micros(F.col("window.end")) <= F.lit(watermark * 1000)
        rows = rows.observe(LATE, F.count(F.when(closed, 1)).alias("rows"))
    return rows.groupBy("window", key).count().select("window.*", key, "count")


def _best(totals: DataFrame, window: Column, item: str, total: str) -> DataFrame:
    """Best item per window by one aggregate: unknown totals last, equal ones by name."""
    first = F.min(F.struct(F.col(total).isNull().alias("unknown"), (F.lit(0) - F.col(total)).alias("less"), item))
    best = totals.groupBy(window.alias("window")).agg(first.alias("best"))
    return best.select(
        "window.start", "window.end", F.col(f"best.{item}").alias(item), (F.lit(0) - F.col("best.less")).alias(total)
    )


def top_closed(
    df: DataFrame, time: str, length: str, amount: str | Column, item: str, *, delay: str, name: str = "total"
) -> DataFrame:
    """The best item of every window of a stream, once, when the window is closed.

    Two chained aggregates under one watermark: totals per window and item, and of these the
    best per window. Both leave the state with their window, and nothing is written twice.
    On a bounded frame all windows are there. ``time`` must be a zoned timestamp.
    """
    totals = df.withWatermark(time, delay).groupBy(F.window(time, length).alias("window"), item).agg(F.sum(amount).alias(name))
    return _best(totals, F.window(F.window_time("window"), length), item, name)


def top_sliding_closed(
    df: DataFrame, time: str, length: str, slide: str, amount: str | Column, item: str, *, delay: str, name: str = "total"
) -> DataFrame:
    """``top_closed`` for sliding windows: panes, windows and the best of each, all in state that closes."""
    panes = (
        df.withWatermark(time, delay).groupBy(F.window(time, slide).alias("pane"), item).agg(F.sum(amount).alias("pane_total"))
    )
    totals = panes.groupBy(F.window("pane", length, slide).alias("window"), item).agg(F.sum("pane_total").alias(name))
    return _best(totals, F.col("window"), item, name)
