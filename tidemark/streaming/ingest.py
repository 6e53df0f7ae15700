"""Continuous file ingest into bronze tables, with rule metrics and a quarantine for malformed lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import Rule
from tidemark.session import scratch_tables
from tidemark.sources.delimited import HEADER, LINE, parse_by_header, stream_csv_lines
from tidemark.sources.files import CORRUPT, LINEAGE, REJECTED, typed_with_rejects
from tidemark.sources.tables import write_batch
from tidemark.streaming.queries import append_with_rules, for_each_batch

_MALFORMED = "malformed"


def ingest_csv(
    spark: SparkSession,
    landing: str,
    ddl: str,
    target: str,
    checkpoint: str,
    *,
    purge: bool = False,
    max_files_per_trigger: int | None = None,
    required: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Ingest new CSV files by the names in their headers, malformed lines into a partition of their own; none are lost.

    Lines with a value that does not fit its type count as malformed, and so do all lines of files without one of the
    ``required`` columns.

    Without a trigger this is the on-demand form: take what is pending and stop.
    """
    lines = stream_csv_lines(spark, landing, purge=purge, max_files_per_trigger=max_files_per_trigger)

    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch_tables(spark):
            parsed = parse_by_header(batch, ddl, required)
            rows = typed_with_rejects(parsed, ddl, keep=(*LINEAGE, CORRUPT, LINE, HEADER))
            text = F.coalesce(CORRUPT, F.when(F.col(REJECTED).isNotNull(), F.col(LINE)))
            rows = rows.withColumn(CORRUPT, text).withColumn(_MALFORMED, text.isNotNull()).drop(LINE, REJECTED)
            write_batch(rows, target, batch_id, [_MALFORMED], rebalance=False)

    return for_each_batch(lines, store, checkpoint, trigger)


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """The well-formed lines that :func:`ingest_csv` has stored."""
    stored = spark.read.parquet(target)
    return stored.filter(f"{_MALFORMED} = 'false'").drop(_MALFORMED, CORRUPT, HEADER, "batch_id")


def quarantined(spark: SparkSession, target: str) -> DataFrame:
    """The malformed lines as text, with their lineage."""
    return spark.read.parquet(target).filter(f"{_MALFORMED} = 'true'").select(CORRUPT, *LINEAGE)


def ingest_with_rules(
    stream: DataFrame,
    dataset: str,
    rules: Sequence[Rule],
    target: str,
    metrics: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream under its rules, with one metrics row per rule and micro-batch.

    The counters ride along with the write, so the rows are read once. A violated fail rule stops the query
    with nothing of that batch in the target.
    """

    return append_with_rules(
        stream, lambda batch, counts: counts.enforce(batch, rules, dataset), target, metrics, checkpoint, dataset, trigger=trigger
    )
