"""Tables with a primary key: written batch by batch, read at any time, compacted beside the writer.

Below the table's folder::

    layout.json                   keys, order and number of buckets, fixed at the first start
    log/BATCH=7/BUCKET=3/...      the rows of one batch, each key once
    base/VERSION=2/BUCKET=3/...   one row per key of all batches up to a version's last one
    manifest/000000000002.json    a version: its last batch, and the version of each bucket

A batch costs its own size. A version is one new manifest, written when all its files are
there, so readers see either the old or the new one. Buckets that no batch has touched stay
with the version that wrote them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.session import delete_path, entries, move_path, path_exists, read_text, write_text

BATCH, BUCKET, VERSION = "millrace_batch", "millrace_bucket", "millrace_version"
BASE = -1
BUCKETS = 64


@dataclass(frozen=True)
class State:
    """What a reader goes by: a version, and the finished batches after it."""

    version: int = 0
    through: int = BASE
    buckets: dict[int, int] = field(default_factory=dict)
    batches: tuple[int, ...] = ()


class KeyedTable:
    """A table whose newest row per key counts.

    Newest is by ``order_by`` and then by batch: of rows with equal order the later batch
    wins, nulls are oldest. Without ``order_by`` the later batch always wins; that is allowed
    for batches that hold no key twice, such as grouped results, which ``unique`` states.
    Null keys are equal to each other. ``buckets`` bounds the tasks of reading one bucket and
    is fixed when the table is made: take about one per GB of the table.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        schema: StructType,
        order_by: Sequence[str] = (),
        *,
        unique: bool = False,
        buckets: int = BUCKETS,
    ) -> None:
        if not order_by and not unique:
            raise ValueError("name order_by columns, or state with unique=True that no batch holds a key twice")
        self._spark, self._path, self._keys, self._order = spark, path, list(keys), list(order_by)
        self._schema = schema
        given = {"keys": self._keys, "order_by": self._order, "buckets": buckets}
        stored = read_text(spark, f"{path}/layout.json")
        if stored is None:
            write_text(spark, f"{path}/layout.json", json.dumps(given))
        else:
            found = json.loads(stored)
            if {**given, "buckets": found["buckets"]} != found:
                raise ValueError(f"the table at {path} was made with {stored}")
            given = found
        self._buckets = given["buckets"]

    # --- writing ---

    def sink(self) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` body that files a batch under its number.

        A repeated batch replaces its own files, and one that a version already holds is
        filed again without effect.
        """
        return self.write

    def write(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*self._schema.fieldNames())
        if self._order:
            newest = [F.desc_nulls_last(c) for c in self._order]
            alike = F.desc(F.xxhash64(*rows.columns))  # the same one of equal rows when repeated
            first = F.row_number().over(Window.partitionBy(*self._keys).orderBy(*newest, alike))
            rows = rows.withColumn("_first", first).where("_first = 1").drop("_first")
        self._file(rows.withColumn(BUCKET, self._bucket()), f"{self._path}/log/{BATCH}={batch_id}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self._keys), F.lit(self._buckets))

    def _file(self, rows: DataFrame, folder: str) -> None:
        """Rows by bucket; adaptive execution gives a bucket as many tasks as its size asks for."""
        rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)

    # --- reading ---

    def state(self) -> State:
        """The newest version and the batches finished since then."""
        names = [n for n in entries(self._spark, f"{self._path}/manifest") if n.endswith(".json")]
        found = json.loads(read_text(self._spark, f"{self._path}/manifest/{names[-1]}")) if names else {}
        buckets = {int(k): v for k, v in found.get("buckets", {}).items()}
        version, through = found.get("version", 0), found.get("through", BASE)
        batches = sorted(int(n.split("=")[1]) for n in entries(self._spark, f"{self._path}/log") if n.startswith(BATCH))
        done = [b for b in batches if b > through and path_exists(self._spark, f"{self._log(b)}/_SUCCESS")]
        return State(version, through, buckets, tuple(done))

    def rows(self) -> DataFrame:
        """The newest row of every key."""
        return self._newest(self.state())

    def lookup(self, *key: object) -> DataFrame:
        """The newest row of one key; reads its bucket alone."""
        one = self._spark.createDataFrame([key], StructType([self._schema[k] for k in self._keys]))
        bucket = one.select(self._bucket()).first()[0]
        same = [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(self._keys, key, strict=True)]
        found = self._newest(self.state(), [bucket])
        for condition in same:
            found = found.where(condition)
        return found

    def _log(self, batch: int) -> str:
        return f"{self._path}/log/{BATCH}={batch}"

    def _read(self, base: str, paths: list[str], mark: str) -> DataFrame:
        marks = [StructField(mark, LongType()), StructField(BUCKET, LongType())]
        schema = StructType([*self._schema.fields, *marks])
        if not paths:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def _newest(self, state: State, only: Sequence[int] | None = None) -> DataFrame:
        """Rows of the base that no later row replaces, and the rows of the log that win.

        Which batch wins is found on keys, order and batch number alone. Whole rows are then
        joined with the winners, so no payload is ever aggregated, and where the log is small
        against the base, Spark can broadcast its keys and leave the base where it lies.
        """
        fields, keys = self._schema.fieldNames(), self._keys
        held = {b: v for b, v in state.buckets.items() if only is None or b in only}
        base = self._read(
            f"{self._path}/base", [f"{self._path}/base/{VERSION}={v}/{BUCKET}={b}" for b, v in sorted(held.items())], VERSION
        )
        if not state.batches:
            return base.select(*fields)
        log = self._read(f"{self._path}/log", [self._log(b) for b in state.batches], BATCH)
        if only is not None:
            log = log.where(F.col(BUCKET).isin(list(only)))
        if self._order:
            asked = log.select(*keys).distinct()
            narrow = log.select(*keys, *self._order, BATCH)
            rivals = base.select(*keys, *self._order, F.lit(BASE).cast("long").alias(BATCH))
            narrow = narrow.unionByName(_matching(rivals, asked, keys, "left_semi"))
            wins = narrow.groupBy(*keys).agg(F.max_by(BATCH, F.struct(*self._order, BATCH)).alias("_wins"))
        else:
            wins = log.groupBy(*keys).agg(F.max(BATCH).alias("_wins"))
        kept = _matching(base, wins.where(F.col("_wins") != BASE), keys, "left_anti") if held else None
        won = _matching(log, wins, keys, "inner").where(F.col(BATCH) == F.col("_wins")).select(*fields)
        return won if kept is None else kept.select(*fields).unionByName(won)

    # --- versions ---

    def compact(self) -> int:
        """Write the next version from all finished batches; the writer may go on meanwhile.

        Only buckets that these batches touch are written anew. Returns the newest version's
        number, which stays the same if there is nothing new. Of two compactions at once one
        fails when it publishes, without effect.
        """
        state = self.state()
        if not state.batches:
            return state.version
        touched = set()
        for batch in state.batches:
            touched |= {int(n.split("=")[1]) for n in entries(self._spark, self._log(batch)) if n.startswith(BUCKET)}
        version = state.version + 1
        target = f"{self._path}/base/{VERSION}={version}"
        self._file(self._newest(state, sorted(touched)).withColumn(BUCKET, self._bucket()), target)
        written = {int(n.split("=")[1]) for n in entries(self._spark, target) if n.startswith(BUCKET)}
        buckets = state.buckets | dict.fromkeys(written, version)
        manifest = {"version": version, "through": max([state.through, *state.batches]), "buckets": buckets}
        draft = f"{self._path}/manifest/_draft-{uuid.uuid4().hex}"
        write_text(self._spark, draft, json.dumps(manifest))
        move_path(self._spark, draft, f"{self._path}/manifest/{version:012d}.json")
        return version

    def vacuum(self) -> None:
        """Delete what only older versions need. Call it when no reader of an older one is left."""
        state = self.state()
        used = set(state.buckets.values())
        for name in entries(self._spark, f"{self._path}/base"):
            if name.startswith(VERSION) and int(name.split("=")[1]) <= state.version and int(name.split("=")[1]) not in used:
                delete_path(self._spark, f"{self._path}/base/{name}")
        for name in entries(self._spark, f"{self._path}/log"):
            if name.startswith(BATCH) and int(name.split("=")[1]) <= state.through:
                delete_path(self._spark, f"{self._path}/log/{name}")


def _matching(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on the keys, where null equals null; keeps the columns of ``rows`` and those added by ``other``."""
    renamed = other.select(*(F.col(k).alias(f"_other_{k}") for k in keys), *(c for c in other.columns if c not in keys))
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_other_{k}"))
        same = one if same is None else same & one
    return rows.join(renamed, same, how).drop(*(f"_other_{k}" for k in keys))
