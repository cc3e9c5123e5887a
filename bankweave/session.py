"""Session settings, shared work folders and small file-system helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are tuned for.  Join sides are never hinted for broadcast: the
# planner broadcasts a side only when its measured size is under
# autoBroadcastJoinThreshold and otherwise shuffles, splitting skewed partitions.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM does not compile methods beyond this size, so a larger generated loop is slower than none.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


_LOCAL: list[tempfile.TemporaryDirectory] = []


def shuffle_partitions(input_bytes: int, target: int = 128 << 20, least: int = 200) -> int:
    """Shuffle partitions for a job over ``input_bytes``; adaptive execution merges the small ones."""
    return max(least, -(-input_bytes // target))


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Set the session's shuffle partitions by the size of its inputs, unless they are set already."""
    known = spark.conf.get("spark.sql.shuffle.partitions")
    if spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        return int(known)
    total = 0
    for path in paths:
        fs, p = _fs(spark, path)
        total += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    n = shuffle_partitions(total)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def build_session(master: str | None = None, app: str = "bankweave", **extra: str) -> SparkSession:
    """Session with the settings above; give ``spark.sql.shuffle.partitions`` by ``shuffle_partitions``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as the block lasts."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def adaptive(spark: SparkSession):
    """Adaptive execution inside a micro-batch, whose session Spark has taken it from for the sake of the stream's state.

    Without it the rebalance before a write is ignored, and every task writes a file into every day.  The stream's own part of a
    micro-batch is planned already and stays as it is.
    """
    return setting(spark, "spark.sql.adaptive.enabled", "true")


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may fall
    back to a temporary folder, because there the driver and the tasks share a disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    _LOCAL.append(tempfile.TemporaryDirectory(prefix="bankweave-", ignore_cleanup_errors=True))  # removed at exit
    spark.sparkContext.setCheckpointDir(_LOCAL[-1].name)
    return _LOCAL[-1].name


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that its lineage ends there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def partition_values(spark: SparkSession, table: str, column: str) -> list[str]:
    """Values of a first-level partition column, from the folder names alone."""
    fs, p = _fs(spark, table)
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the parent of the target is made if there is none."""
    fs, p = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def data_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes of every data file at any depth, by its name below the folder; hidden files are left out, as Spark's readers do."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return {}
    root, found = fs.getFileStatus(p).getPath().toString().rstrip("/"), {}
    waiting = [p]
    while waiting:
        for status in fs.listStatus(waiting.pop()):
            name = status.getPath().getName()
            if name.startswith(("_", ".")) and "=" not in name:
                continue
            if status.isDirectory():
                waiting.append(status.getPath())
            else:
                found[status.getPath().toString()[len(root) + 1 :]] = status.getLen()
    return found


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small file, there as a whole or not at all."""
    fs, p = _fs(spark, path + ".part")
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    delete_path(spark, path)
    move_path(spark, path + ".part", path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    held = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(held)).decode()
    finally:
        held.close()
