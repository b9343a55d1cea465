import os
import subprocess
import sys
import types

import pytest

from millrace.session import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
from millrace import build_session, run_folder
spark = build_session("app-name", conf={"spark.master": "local[2]", "spark.ui.enabled": "false"}, shuffle_partitions=3)
get = spark.conf.get
place = run_folder(spark, "r")
spark.range(2).write.parquet(place)
print("FACTS", spark.sparkContext.appName, spark.sparkContext.master, get("spark.sql.shuffle.partitions"),
      get("spark.sql.session.timeZone"), "RocksDB" in get("spark.sql.streaming.stateStore.providerClass"),
      spark.read.parquet(place).count())
"""


def test_build_session_in_a_fresh_process():
    done = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=120, cwd=ROOT)
    assert "FACTS app-name local[2] 3 UTC True 2" in done.stdout, done.stderr[-2000:]


WRITER_SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # the driver knows the package, its Python workers do not
import pyarrow as pa
from millrace import build_session, run_folder
from millrace.session import full_uri
from millrace.streaming import RowWriter, await_end
from millrace.streaming.sinks import ParquetConnection
spark = build_session("w", "local[2]", conf={{"spark.ui.enabled": "false"}}, shuffle_partitions=2)
place = full_uri(spark, run_folder(spark, "w"))
spark.range(3).write.parquet(place + "/in")
shape = pa.schema([("id", pa.int64())])
writer = RowWriter(lambda part, batch: ParquetConnection(place + "/out", shape, part, batch))
stream = spark.readStream.schema("id BIGINT").parquet(place + "/in")
options = dict(checkpointLocation=place + "/c")
await_end(stream.writeStream.foreach(writer).options(**options).trigger(availableNow=True).start(), 60)
print("ROWS", spark.read.parquet(place + "/out").count())
"""


def test_row_writers_need_no_package_on_the_workers(tmp_path):
    environment = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", WRITER_SCRIPT.format(root=ROOT)],
        capture_output=True, text=True, timeout=120, cwd=tmp_path, env=environment,
    )
    assert "ROWS 3" in done.stdout, done.stderr[-2000:]


def _fake(master, conf=None, folder=None):
    context = types.SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
    return types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda name, default=None: conf or default), sparkContext=context
    )


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_fake("spark://host:7077"))
    assert shared_folder(_fake("spark://host:7077", conf="hdfs:///jobs/")) == "hdfs:///jobs"
    assert shared_folder(_fake("yarn", folder="hdfs:///other")) == "hdfs:///other"
