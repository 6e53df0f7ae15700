"""Columns of vectors: which take part, and as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither NULL nor empty nor zero, and no component NULL or not finite."""

    def finite(x: Column) -> Column:
        return F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x), F.lit(False))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors_of(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``vector`` (doubles) and ``ok``: whether the row takes part."""
    vector = F.col(vector_col).cast("array<double>")
    ok = usable(vector) & F.col(id_col).isNotNull()
    return rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), ok.alias("ok"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))
