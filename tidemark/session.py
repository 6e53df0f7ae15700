"""Session settings, and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Day boundaries must be the same whether a day comes from a window, a cast or a truncation,
# so every entry point pins the zone.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where that costs the group-by above it a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    Taken from ``spark.checkpoint.dir``. Only a local-mode session may fall back to a temporary folder: on
    a cluster that would be a different disk on every machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[context.applicationId]


def new_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_scratch = threading.local()


# Shuffle files of a query go as soon as it has ended, where Spark knows the setting.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_and_clean(df: DataFrame, path: str) -> None:
    """Write a table whose rows no later step makes again, and drop the shuffle files that made them."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)


def _write_once(df: DataFrame, label: str) -> str:
    path = new_dir(df.sparkSession, label)
    write_and_clean(df, path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and makes later passes over the same rows read columns
    instead of repeating the plan.
    """
    path = _write_once(df, label)
    for paths in getattr(_scratch, "open", []):
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Like :func:`materialize` for a frame whose plan needs tables of its own: those are deleted afterwards."""
    with scratch_tables(spark):
        df = build()
        path = _write_once(df, label)
    for paths in getattr(_scratch, "open", []):
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete what :func:`materialize` wrote inside the block, for steps that store their own result."""
    paths: list[str] = []
    stack = _scratch.__dict__.setdefault("open", [])
    stack.append(paths)
    try:
        yield
    finally:
        stack.pop()
        for path in paths:
            files, location = file_system(spark, path)
            files.delete(location, True)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = file_system(spark, path)
    return files.exists(location)
