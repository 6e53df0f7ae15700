"""Small helpers shared by the operators: tables, Arrow batches, record groups."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8 bytes; NULL is empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def carried(columns: Sequence[str]) -> list[Column]:
    """Columns of the caller that pass through an operator untouched, as one struct; their names can't clash."""
    return [F.struct(*columns).alias("carried")] if columns else []


def text_or_carried(text_col: str, carry: Sequence[str]) -> list[Column]:
    """The text as a column of its own, unless it is carried anyway, so that no text moves twice."""
    return [] if text_col in carry else [F.col(text_col).cast("string").alias("text")]


def texts_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The text column that :func:`text_or_carried` chose."""
    return batch["text"] if "text" in batch.schema.names else batch["carried"].field(text_col).cast(pa.string())


def schema_with(rows: DataFrame, spec: str) -> T.StructType:
    """The ``id`` of the rows, the columns of ``spec``, and ``carried`` if the rows have it."""
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(spec)])
    return schema.add(rows.schema["carried"]) if "carried" in rows.columns else schema


def longs(column: pa.Array, null: int = 0) -> np.ndarray:
    """An integer column as int64, NULL as ``null``."""
    return column.cast(pa.int64()).fill_null(null).to_numpy(zero_copy_only=False)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``; a group may span batches.

    Yields one table per batch that holds all groups known to be complete, so that small groups can be handled
    together. At most one batch and the group still open are in memory.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = group_starts(batch, keys)
        same = bool(held) and all(held[-1][k][-1].as_py() == batch[k][0].as_py() for k in keys)
        if len(starts) == 1 and same:
            held.append(batch)
            continue
        last = int(starts[-1])
        if same:
            # The open group ends inside this batch.
            done = [*held, batch.slice(0, last)]
        else:
            done = [*held, batch.slice(0, last)] if held else [batch.slice(0, last)]
        done = [b for b in done if b.num_rows]
        if done:
            yield pa.Table.from_batches(done)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def group_starts(rows: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Indices at which a new group of equal integer keys begins."""
    n = rows.num_rows
    change = np.zeros(n, bool)
    if n:
        change[0] = True
    for key in keys:
        values = rows[key].to_numpy() if isinstance(rows, pa.Table) else rows[key].to_numpy(zero_copy_only=False)
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


_shipped: set[str] = set()


#: Bytes that a Python worker gets at once, so that its memory is bounded whatever the length of texts.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, also where it isn't installed or on their path, and bound what
    they get at once.

    The sources go out once for each application, by Spark's own file server. The session's bound on the bytes of
    a batch is lowered if it is higher, and never raised.
    """
    import tidemark

    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
    context = spark.sparkContext
    package = os.path.dirname(os.path.abspath(tidemark.__file__))
    root = os.path.dirname(package)
    on_path = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if root in on_path or context.applicationId in _shipped:
        return
    # Spark's file server reads it as long as the application runs.
    handle, archive = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    os.close(handle)
    atexit.register(os.remove, archive)
    with zipfile.ZipFile(archive, "w") as out:
        for place, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(place, name)
                out.write(path, os.path.relpath(path, root))
    context.addPyFile(os.path.realpath(archive))
    _shipped.add(context.applicationId)
