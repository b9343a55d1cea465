"""Equality joins of tables and streams, safe against hot keys.

Column names of the two sides must differ.

No side is ever forced into a broadcast: Spark broadcasts a side when its size,
from file statistics or measured at run time, is below
``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from millrace.streaming.layout import StateLayout

#: Spark's counters take no smaller share.
LEAST_SHARE = 1.01e-4

HOW = {
    "inner": "inner",
    "left": "left",
    "left_outer": "left",
    "right": "right",
    "right_outer": "right",
    "full": "full",
    "outer": "full",
    "full_outer": "full",
    "left_semi": "left_semi",
    "semi": "left_semi",
    "left_anti": "left_anti",
    "anti": "left_anti",
}

# Join types Spark accepts by the kind of its two inputs.
STREAM_JOINS = {
    "stream-static": {"inner", "left", "left_semi", "left_anti"},
    "static-stream": {"inner", "right"},
    "stream-stream": {"inner"},
    "stream-stream with watermark and range": {"inner", "left", "right", "full", "left_semi"},
}


def _kind(how: str) -> str:
    if how not in HOW:
        raise ValueError(f"unknown join type {how!r}")
    return HOW[how]


def _require(pairing: str, kind: str) -> None:
    if kind not in STREAM_JOINS[pairing]:
        allowed = ", ".join(sorted(STREAM_JOINS[pairing]))
        raise ValueError(f"{kind} join is not possible {pairing}; possible: {allowed}")


def join_tables(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    *,
    hot: Sequence = (),
    salts: int = 8,
) -> DataFrame:
    """Join two bounded frames on one equality.

    Without ``hot`` this is Spark's own join, each side read once. Adaptive execution
    splits a hot key of either side of an inner join and of the kept side of left, right,
    semi and anti joins. Of the keys that a semi or anti join looks up, few rows per key go
    into its shuffle.

    Keys named in ``hot`` (see ``hot_keys``) are dealt over ``salts`` groups without the
    help of adaptive execution: rows of the kept side get a salt, those of the other side
    a copy per salt.

    Adaptive execution does not split a full join. Its hot keys are measured on both sides
    first, also when none are named, and dealt as ``_full_join`` says.
    """
    kind = _kind(how)
    if kind == "full":
        return _full_join(left, right, left_key, right_key, hot)
    if kind in ("left_semi", "left_anti"):
        right = _few(right, right_key)
    if not hot:
        return left.join(right, F.col(left_key) == F.col(right_key), kind)
    if kind == "right":
        return _salted_join(right, left, right_key, left_key, "left", hot, salts).select(*left.columns, *right.columns)
    return _salted_join(left, right, left_key, right_key, kind, hot, salts)


def _full_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, named: Sequence = ()) -> DataFrame:
    """Full join of tables in one pass, with the rows of hot keys (and of no key) dealt over groups.

    The rows of a hot key are dealt by a hash on the side that has more of them. The other
    side's rows of that key get a copy for each group that the dealt side really has, so every
    copy meets a partner and none comes out as a lone row. Rows of a hot key that the other
    side does not have stay single, and are lone once each. Which groups there are is counted
    beforehand, from the key and the rows' hashes alone: about eight to each shuffle partition.
    """
    spark = left.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(0.5 / width, LEAST_SHARE)
    counts = [_hot_counts(df, key, share, named) for df, key in ((left, left_key), (right, right_key))]
    if not any(n for n, _ in counts):
        return left.join(right, F.col(left_key) == F.col(right_key), "full")

    groups: list[dict] = [{}, {}]  # by side, the number of groups of each key that it deals
    for key in {k for n, _ in counts for k in n if k is not None}:
        rows = [n.get(key, 0) for n, _ in counts]
        side = 0 if rows[0] >= rows[1] else 1
        groups[side][key] = min(8 * width, math.ceil(4 * rows[side] / (share * counts[side][1])))
    present = [
        _groups_present(df, key, groups[side]) for side, (df, key) in enumerate(((left, left_key), (right, right_key)))
    ]
    dealt = _dealt(left, left_key, groups[0], present[1], width, "_lsalt")
    other = _dealt(right, right_key, groups[1], present[0], width, "_rsalt")
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_lsalt") == F.col("_rsalt"))
    return dealt.join(other, same, "full").select(*left.columns, *right.columns)


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*(_hashable(df) or [F.lit(0)]))


def _lookup(df: DataFrame, key: str, rows: list[tuple], fields: str) -> DataFrame:
    """The frame with the fields of a table of few rows, one per hot key; null elsewhere."""
    kind = df.schema[key].dataType.simpleString()
    table = df.sparkSession.createDataFrame(rows, f"_hot {kind}, {fields}")
    return df.join(F.broadcast(table), F.col(key) == F.col("_hot"), "left").drop("_hot")


def _groups_present(df: DataFrame, key: str, groups: dict) -> dict:
    """For each key that a side deals, the groups that have a row."""
    if not groups:
        return {}
    hot = _lookup(df, key, list(groups.items()), "_groups long").where("_groups IS NOT NULL")
    group = F.pmod(_row_hash(df), F.col("_groups")).alias("group")
    found: dict = {}
    for row in hot.select(F.col(key).alias("key"), group).distinct().collect():
        found.setdefault(row.key, []).append(row.group)
    return found


def _dealt(df: DataFrame, key: str, own: dict, others: dict, width: int, name: str) -> DataFrame:
    """Rows with a group: of its own key by hash, a copy for each group of the other side's keys, else 0."""
    table = [(k, n, None) for k, n in own.items()] + [(k, None, sorted(g)) for k, g in others.items() if k not in own]
    known = _lookup(df, key, table, "_groups long, _copies array<long>")
    own_group = F.pmod(_row_hash(df), F.coalesce("_groups", F.when(F.col(key).isNull(), F.lit(width)), F.lit(1)))
    return known.withColumn(name, F.explode(F.coalesce("_copies", F.array(own_group)))).drop("_groups", "_copies")


def _salted_join(
    kept: DataFrame, other: DataFrame, kept_key: str, other_key: str, kind: str, hot: Sequence, salts: int
) -> DataFrame:
    columns = kept.columns if kind in ("left_semi", "left_anti") else kept.columns + other.columns
    dealt = _salted(kept, kept_key, hot, salts, "_lsalt")
    copied = _replicated(other, other_key, hot, salts, "_rsalt")
    same = (F.col(kept_key) == F.col(other_key)) & (F.col("_lsalt") == F.col("_rsalt"))
    return dealt.join(copied, same, kind).select(*columns)


def _few(df: DataFrame, key: str, groups: int = 16) -> DataFrame:
    """The keys of a frame, each at most ``groups`` times.

    Distinct per key and a hash of the row, not per key alone: the join after it then has
    a shuffle of its own, whose hot partitions adaptive execution can split.
    """
    group = F.pmod(F.xxhash64(*_hashable(df)), F.lit(groups)) if _hashable(df) else F.lit(0)
    return df.select(F.col(key), group.alias("_group")).distinct().select(key)


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> list:
    """Keys holding more than ``share`` of a bounded frame: at most ``1 / share`` of them.

    By default a key counts as hot if it would fill more than half of a shuffle partition's
    fair part. One pass finds candidates with counters of fixed size, which miss no such
    key and shuffle no list of all keys; a second counts the candidates and the rest, so
    the driver sees one row per candidate and one more. Filter the frame to the rows that
    take part in the join first. For a true stream take the keys from its history.
    """
    return list(hot_layout(df, key, share).hot)


def hot_layout(df: DataFrame, key: str, share: float | None = None) -> StateLayout:
    """Hot keys of a bounded frame and the number of salts that brings each below half a partition's part."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(share if share is not None else 0.5 / width, LEAST_SHARE)
    counts, total = _hot_counts(df, key, share)
    hot = {k: n / total for k, n in counts.items() if k is not None}
    salts = min(2 * width, math.ceil(max(hot.values()) / share)) if hot else 1
    return StateLayout(tuple(sorted(hot)), salts)


def _hot_counts(df: DataFrame, key: str, share: float, named: Sequence = ()) -> tuple[dict, int]:
    """Rows of each key with more than ``share`` of the frame, null included, and of the whole frame.

    ``named`` keys are counted whatever their share.
    """
    found = df.select(F.col(key).alias("key")).freqItems(["key"], share).first()[0]
    candidates = list({v for v in [*(found or ()), *named] if v is not None})
    candidate = F.when(F.col(key).isin(candidates), F.col(key)) if candidates else F.lit(None)
    marked = df.select(candidate.alias("key"), F.col(key).isNull().alias("missing"))
    counts = marked.groupBy("key", "missing").agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(row.n for row in counts)
    hot = {r.key: r.n for r in counts if (r.key is not None or r.missing) and (r.n > share * total or r.key in named)}
    return hot, total


def _is_hot(key: str, hot: Sequence) -> Column:
    missing = F.col(key).isNull()
    return (missing | F.col(key).isin(list(hot))) if hot else missing


def _salted(df: DataFrame, key: str, hot: Sequence, salts: int, name: str) -> DataFrame:
    """Each row of a hot (or null) key gets one of ``salts`` numbers, other rows 0.

    The number depends on the row's content alone, so a repeated task deals alike.
    """
    salt = F.pmod(F.xxhash64(*(_hashable(df) or [F.lit(0)])), F.lit(salts))
    return df.withColumn(name, F.when(_is_hot(key, hot), salt).otherwise(F.lit(0).cast("bigint")))


def _replicated(df: DataFrame, key: str, hot: Sequence, salts: int, name: str) -> DataFrame:
    """Each row of a hot key once per salt, all others once.

    A null key has no partner and gets a number of its own. That also keeps the
    column from being a constant, which would drop out of the join key.
    """
    single = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("bigint")
    if not hot:
        return df.withColumn(name, single)
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    copies = F.when(F.col(key).isin(list(hot)), every).otherwise(F.array(single))
    return df.withColumn(name, F.explode(copies))


def _stretch(df: DataFrame, time: str, seconds: int) -> Column:
    """Start of the stretch of ``seconds`` that a time falls in, in seconds since 1970.

    A time without a zone is counted by its own calendar, so that the session's zone
    and its clock changes do not matter.
    """
    if isinstance(df.schema[time].dataType, TimestampNTZType):
        clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
        at = F.unix_date(F.to_date(time)).cast("bigint") * 86400 + clock
    else:
        at = F.unix_seconds(time)
    return at - F.pmod(at, F.lit(seconds))


def join_stream_static(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Join a stream with a bounded frame, given in either order.

    The stream is the kept side in every legal form. Such a query holds no state,
    so each micro-batch is planned adaptively: a small static side is broadcast,
    a large one shuffled with the hot keys of the stream split.
    """
    kind = _kind(how)
    _require("stream-static" if left.isStreaming else "static-stream", kind)
    if kind in ("left_semi", "left_anti"):
        right = _few(right, right_key)
    return left.join(right, F.col(left_key) == F.col(right_key), kind)


def join_streams(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    *,
    left_time: str | None = None,
    right_time: str | None = None,
    within: int | None = None,
    delay: str | None = None,
    unbounded_state: bool = False,
    hot: Sequence = (),
    salts: int = 8,
) -> DataFrame:
    """Join two streams on a key, optionally with ``left_time <= right_time <= left_time + within``.

    Two bounded frames give the result that the streams would have at their end.

    With ``within`` (seconds) and ``delay`` (watermark) rows leave the state once no
    partner can come. Without them an inner join keeps every row for ever, which
    must be asked for with ``unbounded_state``.

    Within a time range, a row only meets state rows of its own and one neighbouring
    stretch of time, not all rows of its key: the start of the stretch joins the
    key. That alone spreads a hot key over its history. Where one stretch of one key
    is still too much for a task, name the key in ``hot``: its rows are dealt over
    ``salts`` groups, at the price of as many copies of their partners.

    Copies are made of the side that the join does not keep, so every kept row is
    judged once. A full join keeps both sides; here it is a left join plus the unmatched
    rows of a right join. ``full_interval_join`` does it with one join and half the state,
    for results that are read through ``settle_full``.
    """
    kind = _kind(how)
    ranged = within is not None
    streaming = left.isStreaming or right.isStreaming
    if ranged and (left_time is None or right_time is None):
        raise ValueError("a time range needs both time columns")
    if ranged and streaming and delay is None:
        raise ValueError("a time range on streams needs a watermark delay")
    _require("stream-stream with watermark and range" if ranged else "stream-stream", kind)
    if not ranged and streaming and not unbounded_state:
        raise ValueError("without a time range the state grows for ever; pass unbounded_state=True to accept it")

    if ranged and streaming:
        left = left.withWatermark(left_time, delay)
        right = right.withWatermark(right_time, delay)
    if kind == "full":
        both = _spread_join(left, right, left_key, right_key, "left", left_time, right_time, within, hot, salts)
        marked = left.withColumn("_met", F.lit(True))
        kept = _spread_join(marked, right, left_key, right_key, "right", left_time, right_time, within, hot, salts)
        return both.unionByName(kept.where(F.col("_met").isNull()).drop("_met"))
    return _spread_join(left, right, left_key, right_key, kind, left_time, right_time, within, hot, salts)


def full_interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    left_time: str,
    right_time: str,
    within: int,
    delay: str | None = None,
    hot: Sequence = (),
    salts: int = 8,
) -> DataFrame:
    """Full join within a time range by a single (stateful) join; read it through ``settle_full``.

    Arguments are those of ``join_streams``. Left rows stand once in the state, right rows
    once per stretch that they may meet, and per salt of a hot key. A pair comes out once, and
    so does a lone left row. A right row comes out once for each of its copies that met
    nothing. All copies of a row leave the state together, as that depends on its time alone,
    so in any finished batch either all lone copies of a row are there or none, and a row is
    lone if all its copies are.
    """
    if left.isStreaming or right.isStreaming:
        if delay is None:
            raise ValueError("a time range on streams needs a watermark delay")
        left, right = left.withWatermark(left_time, delay), right.withWatermark(right_time, delay)
    columns = left.columns + right.columns
    many = F.col(right_key).isin(list(hot)) if hot else F.lit(False)
    right = right.withColumn("_copies", F.when(many, F.lit(2 * salts)).otherwise(F.lit(2)))
    joined = _spread_join(
        left.withColumn("_left", F.lit(True)), right, left_key, right_key, "full", left_time, right_time, within, hot, salts,
        keep=["_left", "_copies", "_rsalt", "_rslot"],
    )
    return joined.select(*columns, "_left", "_copies", F.struct("_rsalt", "_rslot").alias("_copy"))


def settle_full(stored: DataFrame, right_columns: Sequence[str]) -> DataFrame:
    """The rows of a full join from what ``full_interval_join`` gave.

    Lone copies of right rows are grouped by all their columns, which must be of types that can
    be grouped; equal rows come back as often as they were there.
    """
    columns = [c for c in stored.columns if c not in ("_left", "_copies", "_copy")]
    met = stored.where(F.col("_left").isNotNull()).select(*columns)
    lone = stored.where(F.col("_left").isNull()).groupBy(*right_columns, "_copies")
    lone = lone.agg(F.count(F.lit(1)).alias("_n"), F.size(F.collect_set("_copy")).alias("_lone"))
    times = (F.col("_n") / F.col("_copies")).cast("int")
    lone = lone.where(F.col("_lone") == F.col("_copies")).withColumn("_n", F.explode(F.array_repeat(F.lit(0), times)))
    return met.unionByName(lone.select(*right_columns), allowMissingColumns=True)


def _spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    kind: str,
    left_time: str | None,
    right_time: str | None,
    within: int | None,
    hot: Sequence,
    salts: int,
    keep: Sequence[str] = (),
) -> DataFrame:
    columns = left.columns if kind == "left_semi" else left.columns + right.columns
    columns = list(dict.fromkeys([*columns, *keep]))
    keeps_right = kind == "right"
    condition = F.col(left_key) == F.col(right_key)

    if keeps_right:
        left = _replicated(left, left_key, hot, salts, "_lsalt")
        right = _salted(right, right_key, hot, salts, "_rsalt")
    else:
        left = _salted(left, left_key, hot, salts, "_lsalt")
        right = _replicated(right, right_key, hot, salts, "_rsalt")
    condition = condition & (F.col("_lsalt") == F.col("_rsalt"))

    if within is not None:
        start_left, start_right = _stretch(left, left_time, within), _stretch(right, right_time, within)
        if keeps_right:  # a left row can meet right rows of its own stretch and the next
            left = left.withColumn("_lslot", F.explode(F.array(start_left, start_left + within)))
            right = right.withColumn("_rslot", start_right)
        else:
            left = left.withColumn("_lslot", start_left)
            right = right.withColumn("_rslot", F.explode(F.array(start_right - within, start_right)))
        upper = F.col(left_time) + F.expr(f"INTERVAL '{int(within)}' SECOND")
        condition = (
            condition
            & (F.col("_lslot") == F.col("_rslot"))
            & (F.col(right_time) >= F.col(left_time))
            & (F.col(right_time) <= upper)
        )
    return left.join(right, condition, kind).select(*columns)
