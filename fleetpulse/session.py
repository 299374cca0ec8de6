"""Spark session settings and shared-folder helpers.

Everything in the package works on whatever session the caller hands in;
``build_session`` is a convenience for tests, the bench and local runs.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the package relies on. UTC is required: epoch-millisecond columns
# and timestamps are converted back and forth and must agree with the oracle.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Streaming state lives in RocksDB so that large windows spill to disk
    # instead of sitting on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

ROCKSDB_PROVIDER = BASE_CONF["spark.sql.streaming.stateStore.providerClass"]


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "fleetpulse", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("FLEETPULSE_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only when it is unset (local tests) a scratch folder is made.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="fleetpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def workers_import(spark: SparkSession, root: str) -> None:
    """Put ``root`` on the import path of Python workers started from now on
    (where the package is neither installed nor shipped with --py-files)."""
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for stream
    checkpoints and intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"



def ensure_rocksdb_state(spark: SparkSession) -> None:
    """State operators with several state variables (transformWithState)
    need the RocksDB state store; switch the session to it for the queries
    started afterwards (a running query keeps the provider it began with)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)


def start_with_partitions(writer, spark: SparkSession, state_partitions: int | None):
    """Start a streaming query with ``state_partitions`` shuffle (and state)
    partitions and its state in RocksDB, so that it spills to disk whatever
    session it runs on. A query keeps what it first started with (it runs on
    a copy of the session's settings), so the session's own settings are put
    back right after the start."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def default_state_partitions(spark: SparkSession) -> int:
    """One state partition per core the cluster offers."""
    return max(1, int(spark.sparkContext.defaultParallelism))


def drop_dead_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a plan when the driver's garbage
    collector finds it unused, which a large heap puts off for many jobs
    (``spark.cleaner.periodicGC.interval``: half an hour); this is that
    collection, now. What Python or a listener still lets go goes next time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def files_in(spark: SparkSession, path: str) -> int:
    """How many data files lie in a folder."""
    files, where = _file_system(spark, path)
    return sum(f.isFile() and not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(where))


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of a shared folder, as Spark itself resolves it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark."""
    files, where = _file_system(spark, path)
    files.create(where, True).close()


def write_number(spark: SparkSession, path: str, value: int) -> None:
    """One number as a small file of its own (replaced as a whole)."""
    files, where = _file_system(spark, path)
    out = files.create(where, True)
    out.writeLong(int(value))
    out.close()


def read_number(spark: SparkSession, path: str) -> int | None:
    """What ``write_number`` left there; None without a file."""
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return int(stream.readLong())
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """A folder of the package's own, if it is there."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    files, where = _file_system(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if not files.rename(where, target):
        raise OSError(f"could not move {path} to {to}")
