"""Session helpers: a local session for tests/bench, and the shared scratch folder.

Every job that must cut lineage or write an intermediate table writes under the
folder the cluster names in ``spark.checkpoint.dir``. We only set our own folder
when the session has none (local tests, the bench), never on a configured cluster.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "sparkmine") -> SparkSession:
    """A local session configured like the tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. A session on this machine alone gets a folder of its
    own if it has none; elsewhere executors couldn't see it, so there it is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="sparkmine-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table inside the shared folder; it is
    deleted with the enclosing ``scratch`` block, if there is one."""
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    if _OPEN:
        _OPEN[-1].paths.append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop's FileSystem of ``path``, ``path`` as it names one)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, if it is there."""
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint.

    The rows are cached while the checkpoint is taken, so the file-writing pass reads
    them back instead of recomputing the plan a second time."""
    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested session settings for a cluster run over ``input_bytes`` of input:
    file splits of ``partition_bytes``, enough shuffle partitions that each holds about
    that much before AQE coalesces small ones, and AQE skew-join splitting on. Apply
    with ``SparkSession.builder.config(map=...)`` when building the cluster session."""
    parts = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


# Largest size of a computed table that is broadcast to a join; anything larger goes
# through a shuffle join.
BROADCAST_BYTES = 32 << 20


def fits_broadcast(rows: int, row_bytes: int = 64) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """``broadcast(df)`` when its counted ``rows`` of about ``row_bytes`` each are within
    ``BROADCAST_BYTES``, else ``df`` unchanged (Spark then plans a shuffle join)."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if fits_broadcast(rows, row_bytes) else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """What a ``with scratch(spark)`` block has written or cached."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: list[tuple[str, str]] = []  # (name, path)
        self.paths: list[str] = []
        self.cached: list[DataFrame] = []

    def clear(self) -> None:
        for df in self.cached:
            df.unpersist()
        for name, _ in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in self.paths:
            delete_path(self.spark, path)
        self.tables, self.cached, self.paths = [], [], []


_OPEN: list[Scratch] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Frees the level tables, their files and the cached frames of the miners that ran in
    the block, when it ends. Results must be read, or written, inside the block, since
    they read those tables lazily. Without a block they stay until the session ends (the
    files until somebody clears the checkpoint folder)."""
    scope = Scratch(spark)
    _OPEN.append(scope)
    try:
        yield scope
    finally:
        _OPEN.remove(scope)
        scope.clear()


def cached(df: DataFrame) -> DataFrame:
    """``df`` persisted in memory and on disk until the enclosing ``scratch`` block ends."""
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    if _OPEN:
        _OPEN[-1].cached.append(out)
    return out


def bucketed_table(df: DataFrame, key: str, buckets: int, name: str = "level", aligned: bool = False) -> DataFrame:
    """Write ``df`` as a parquet table bucketed by ``key`` into the shared checkpoint
    folder and read it back. Like ``cut_lineage`` it ends the lineage and survives
    executor loss; in addition the scan reports hash partitioning on ``key``, so a
    join of two such tables (same key, same bucket count) runs without an exchange.

    ``aligned``: the rows are hash-partitioned by ``key`` into ``buckets`` already. Other
    rows are repartitioned first, so that a bucket is one file and not one from each task."""
    spark = df.sparkSession
    table = f"sparkmine_{name}_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, table)
    rows = df if aligned else df.repartition(buckets, key)
    rows.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    if _OPEN:
        _OPEN[-1].tables.append((table, path))
    return spark.table(table)
