"""Reading landing files, batch and streaming, into typed rows with lineage columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import LINEAGE_COLUMNS
from tidemark.operators.quality import Rule, rule_metrics, warn

CORRUPT = "_corrupt_record"
LINEAGE = LINEAGE_COLUMNS
# What typing could not keep: the columns and their raw texts, NULL for a row that fits.
REJECTED = "_rejected"
REJECTED_DDL = f"{REJECTED} ARRAY<STRUCT<column: STRING, text: STRING>>"


def typed(df: DataFrame, ddl: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast every column of the schema; a value that does not fit becomes NULL for the rules to judge.

    A failing cast must not stop a stream, and the key rules stop it where that is wanted.
    """
    schema = T.StructType.fromDDL(ddl)
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], *keep)


def _misfits(df: DataFrame, ddl: str) -> dict[str, Column]:
    """Per column that may fail to fit its type, whether a row's value does."""
    raw = {f.name: f.dataType for f in df.schema}
    return {
        f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in T.StructType.fromDDL(ddl)
        if raw[f.name] != f.dataType
    }


def typed_with_rejects(df: DataFrame, ddl: str, keep: Sequence[str] = ()) -> DataFrame:
    """:func:`typed` rows that keep, in ``REJECTED``, the raw text of each value that did not fit."""
    misfits = _misfits(df, ddl)
    none = F.lit(None).cast(T.StructType.fromDDL(REJECTED_DDL)[0].dataType)
    if misfits:
        found = [
            F.when(misfit, F.array(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"))))
            .otherwise(F.array().cast(T.StructType.fromDDL(REJECTED_DDL)[0].dataType))
            for c, misfit in misfits.items()
        ]
        any_misfit = reduce(lambda a, b: a | b, misfits.values())
        none = F.when(any_misfit, F.concat(*found))
    schema = T.StructType.fromDDL(ddl)
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], *keep, none.alias(REJECTED)
    )


def cast_rules(ddl: str) -> list[Rule]:
    """A rule per column that warns of rejected values, for rows of :func:`typed_with_rejects`."""
    names = T.StructType.fromDDL(ddl).names
    return [warn(c, f"{REJECTED} IS NULL OR NOT array_contains({REJECTED}.column, '{c}')") for c in names]


def rejects(rows: DataFrame, key: str) -> DataFrame:
    """(key, column, text) of every rejected value; the key is NULL where it is rejected itself."""
    return rows.where(F.col(REJECTED).isNotNull()).select(key, F.inline(REJECTED))


def cast_failures(df: DataFrame, ddl: str) -> DataFrame:
    """(column, n_rows, n_failed): values that :func:`typed` turns into NULL, in one pass."""
    counted = rule_metrics(typed_with_rejects(df, ddl), "", cast_rules(ddl))
    return counted.select(F.col("rule").alias("column"), "n_rows", F.col("n_violations").alias("n_failed"))


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the ingest time, fixed per query or micro-batch, and the file each row came from."""
    return df.withColumns(
        {"ingest_timestamp": F.current_timestamp(), "source_file_path": F.col("_metadata.file_path")}
    )


def read_parquet(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    reader = spark.read if ddl is None else spark.read.schema(ddl)
    return reader.parquet(path)


def stream_parquet(
    spark: SparkSession, path: str, ddl: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Rows appended to a table directory, as a stream."""
    reader = spark.readStream.schema(ddl)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def bronze(df: DataFrame, ddl: str) -> DataFrame:
    """Lineage first, while the file metadata is at hand, then the typed columns and what they reject."""
    return typed_with_rejects(with_lineage(df), ddl, keep=LINEAGE)
