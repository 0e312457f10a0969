"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder every lineage cut and intermediate table goes to."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "starloom") -> SparkSession:
    """Local session for tests and the bench, with a folder of this machine for
    intermediate tables. On a cluster, use the cluster's own session; the library
    never creates one itself."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("STARLOOM_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):  # one machine: its own folder is shared
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="starloom-ckpt-"))
    return spark


def cluster_conf(input_bytes: int, target_partition_bytes: int = 512 << 20,
                 scan_split_bytes: int = 512 << 20) -> dict[str, str]:
    """Session settings sized from the input volume, for a cluster session.

    Shuffles start with about one partition per ``target_partition_bytes`` of
    input (the widest shuffle here moves at most about the input volume), so
    a partition fits in executor memory with little spill while the number of
    reducers stays manageable for map-output tracking; AQE then merges small
    partitions toward half that size and splits skewed join partitions. Scans
    read ``scan_split_bytes`` per task.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Intermediate tables must
    lie where every executor sees them, so an unset folder is an error: no folder
    of the driver's machine is taken instead."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    return path


def once(fn):
    """Call ``fn`` at most once (thread-safe); later calls return its result."""
    lock, box = threading.Lock(), []

    def get():
        with lock:
            if not box:
                box.append(fn())
            return box[0]
    return get


_scopes, _made, _lock = 0, [], threading.Lock()


#: Codec of large intermediate tables: they are written once and read a few times.
SCRATCH_CODEC = "zstd"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    with _lock:
        if _scopes:
            _made.append(path)
    return path


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes the scratch tables made inside when the last open scope ends."""
    global _scopes
    with _lock:
        _scopes += 1
    try:
        yield
    finally:
        with _lock:
            _scopes -= 1
            done = [] if _scopes else _made[:]
            if not _scopes:
                _made.clear()
        for path in done:
            delete_path(spark, path)


def _located(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = _located(spark, path)
    return files.exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    files, at = _located(spark, path)
    files.delete(at, True)
