"""Writing tables and views: overwrite, append, idempotent batches, layer namespaces."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import file_system

LAYERS = ("bronze", "silver", "gold")


def create_layers(spark: SparkSession, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")


def create_table(spark: SparkSession, name: str, ddl: str, comment: str | None = None) -> None:
    """An empty typed table, left alone if it exists."""
    note = "" if comment is None else f" COMMENT {_quoted(comment)}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{note}")


def overwrite_table(df: DataFrame, name: str, comment: str | None = None) -> DataFrame:
    """Replace a managed table by ``df`` and return the written table, so later steps do not recompute it.

    Layers copy wide rows from table to table, so their files are packed more tightly than by default.
    """
    df.write.mode("overwrite").format("parquet").option("compression", "zstd").saveAsTable(name)
    if comment is not None:
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    return df.sparkSession.table(name)


def create_view(spark: SparkSession, name: str, query: str, comment: str | None = None) -> DataFrame:
    note = "" if comment is None else f" COMMENT {_quoted(comment)}"
    spark.sql(f"CREATE OR REPLACE VIEW {name}{note} AS {query}")
    return spark.table(name)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _write_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def overwrite_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay.

    Rebalancing gives each partition few files, and lets Spark split a partition that is much larger than
    the others over several tasks. Sorted files let scans for some values of ``sort_by`` skip the rest of them.
    """
    rows = df.hint("rebalance", *partitions)
    if sort_by:
        rows = rows.sortWithinPartitions(*partitions, *sort_by)
    _write_partitions(rows, path, partitions)


def write_batch(
    df: DataFrame, path: str, batch_id: int, partitions: Sequence[str] = (), rebalance: bool = True
) -> None:
    """Append a micro-batch under its own number; a repeated batch replaces its first attempt.

    Numbers belong to one checkpoint. Within a stream the table is claimed for its checkpoint, and a stream
    with another one is refused, as its numbers would replace rows of the first.
    """
    claim(df.sparkSession, path)
    spread = df.hint("rebalance", *partitions) if partitions and rebalance else df
    numbered = spread.withColumn("batch_id", F.lit(batch_id).cast("long"))
    _write_partitions(numbered, path, [*partitions, "batch_id"])


def publish_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    before: Callable[[], None] | None = None,
    aside: tuple[str, str] | None = None,
    partitions: Sequence[str] = (),
) -> None:
    """Append a micro-batch to a table that other streams read: all of it appears at once, and only once.

    Rows are written where no reader looks and then renamed into place, so a repeated batch finds its place taken and
    writes nothing, and a stream that follows never sees other files of the same rows. ``before`` runs when the rows are
    written but not yet in place; it may run again after a failure. ``aside`` names a column and another table, which
    gets the rows that have a value there.
    """
    spark = df.sparkSession
    claim(spark, path)
    files, place = file_system(spark, f"{path}/batch_id={batch_id}")
    if files.exists(place):
        return
    staged = f"{path}/_staged/batch_id={batch_id}"
    if aside is not None:
        df, partitions = df.withColumn("_aside", F.col(aside[0]).isNotNull()), ["_aside", *partitions]
    df.write.mode("overwrite").partitionBy(*partitions).parquet(staged)
    if before is not None:
        before()
    if aside is not None:
        _put(spark, f"{staged}/_aside=true", f"{aside[1]}/batch_id={batch_id}")
        staged = f"{staged}/_aside=false"
    _put(spark, staged, f"{path}/batch_id={batch_id}")


def _put(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder, over what a failed attempt has left; without a source the target is an empty folder."""
    files, place = file_system(spark, target)
    _, found = file_system(spark, source)
    files.delete(place, True)
    if not files.exists(found):
        files.mkdirs(place)
        return
    files.mkdirs(place.getParent())
    if not files.rename(found, place):
        raise RuntimeError(f"could not move {source} to {target}")


def claim(spark: SparkSession, path: str) -> None:
    """Let only the running stream's checkpoint write to ``path``. Outside of a stream nothing is claimed."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        return
    files, owner = file_system(spark, f"{path}/_owner")
    if not files.exists(owner):
        out = files.create(owner, False)
        out.write(bytearray(query.encode()))
        out.close()
    stored = files.open(owner)
    known = spark._jvm.org.apache.commons.io.IOUtils.toString(stored, "UTF-8")
    stored.close()
    if known != query:
        raise RuntimeError(f"{path} is written by the stream {known}; a new checkpoint needs a table of its own")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
