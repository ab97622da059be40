"""Session defaults, the shared working folder and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "scholia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only in local mode (tests) a scratch folder is made and set where none is named; on a cluster a
    machine-local folder would be useless to the other machines, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="scholia-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


_STAGED: list[str] = []
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: a written table is read from its own files."""
    before = spark.conf.get(SWEEP, None)
    spark.conf.set(SWEEP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SWEEP)
        else:
            spark.conf.set(SWEEP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    An iteration then starts from files every executor can read, so it survives the loss of any of
    them, its plan stays short, and later readers prune columns.
    """
    path = work_path(df.sparkSession, "stage")
    _STAGED.append(path)
    with swept(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` has written, once no result reads them any more; others stay."""
    for table in tables:
        path = getattr(table, "_staged", None)
        if path in _STAGED:
            _STAGED.remove(path)
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_bucketed(df: DataFrame, buckets: int, *keys: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder in buckets of ``keys``, and its name (drop it when it isn't needed).

    Joins and groups on the keys then read it where it lies: the other side alone is shuffled.
    """
    path, name = work_path(df.sparkSession, "buckets"), f"bucketed_{uuid.uuid4().hex}"
    _STAGED.append(path)
    with swept(df.sparkSession):
        df.write.option("path", path).option("compression", "zstd").bucketBy(buckets, *keys).saveAsTable(name)
    out = df.sparkSession.table(name)
    out._staged = path
    return out, name


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables that ``cut_lineage`` has written so far; call it when no result needs them any more."""
    n = len(_STAGED)
    while _STAGED:
        _delete(spark, _STAGED.pop())
    return n


def parallelism(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give Python-heavy stages at least one partition per core.

    For plain scans only, where the partitions are known without running anything. A scan of large files
    has enough of them and passes through without a shuffle.
    """
    n = parallelism(df.sparkSession)
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n, *keys) if keys else df.repartition(n)
