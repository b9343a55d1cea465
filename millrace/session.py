"""Session construction and the shared folder that streaming runs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str,
    master: str | None = None,
    *,
    shuffle_partitions: int | None = None,
    time_zone: str = "UTC",
    log_level: str = "WARN",
    checkpoint_dir: str | None = None,
    large_state: bool = True,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or fetch) a session.

    ``shuffle_partitions`` is fixed for the life of a stateful checkpoint, so size
    it for the largest state the query will hold, not for the first batch.
    ``large_state`` keeps streaming state in RocksDB (off heap, changelog uploads)
    instead of in executor heap.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir is not None:
        settings["spark.checkpoint.dir"] = checkpoint_dir
    if large_state:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        settings["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A temporary local folder is used only on a local master with nothing set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared folder for one run."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str) -> tuple:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def full_uri(spark: SparkSession, path: str) -> str:
    """The path with the scheme and host that Spark resolves it to, the same on every executor."""
    _, fs, target = _hadoop(spark, path)
    return fs.makeQualified(target).toUri().toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    _, fs, target = _hadoop(spark, path)
    return bool(fs.exists(target))


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file in any file system Spark knows; None if there is none."""
    jvm, fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole, replacing what was there."""
    _, fs, target = _hadoop(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def make_folder(spark: SparkSession, path: str) -> None:
    _, fs, target = _hadoop(spark, path)
    fs.mkdirs(target)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within one file system; raises where the target exists."""
    jvm, fs, old = _hadoop(spark, source)
    new = jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, sorted; none if it does not exist."""
    _, fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def delete_path(spark: SparkSession, path: str) -> None:
    _, fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a run folder below the shared folder once its result is no longer needed."""
    if not full_uri(spark, path).startswith(full_uri(spark, shared_folder(spark)).rstrip("/") + "/"):
        raise ValueError(f"{path} is not below the shared folder")
    delete_path(spark, path)
