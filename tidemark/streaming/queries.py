"""Starting streaming queries. Each call drains what is pending and stops; a scheduler may repeat it.

Interval triggers differ in nothing but the trigger, so callers that want a resident query pass one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import RuleCounts
from tidemark.session import scratch_tables
from tidemark.sources.tables import overwrite_partitions, publish_batch

PENDING = {"availableNow": True}


def append_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Materialise a stream as an append table; the file sink writes every row exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**(trigger or PENDING))
        .start()
    )


def for_each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch. A batch may be repeated after a failure, so the
    handler must write by batch number or by recomputed partition."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PENDING))
        .start()
    )


def store_counts(counts: RuleCounts, spark: SparkSession, path: str, stream: str, batch_id: int) -> None:
    """Store a micro-batch's counts under its stream and number; a repeated batch replaces its first counts."""
    frame = counts.frame(spark).coalesce(1).withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("long")})
    overwrite_partitions(frame, path, ["stream", "batch_id"])


def append_with_rules(
    stream: DataFrame,
    build: Callable[[DataFrame, RuleCounts], DataFrame],
    path: str,
    metrics: str,
    checkpoint: str,
    name: str,
    aside: tuple[str, str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Materialise a stream under its rules as an append table, every row exactly once.

    ``build(batch, counts)`` applies rules by ``counts.enforce``. The counts are stored, under ``name``, with the
    micro-batch: after its rows are written and before they appear, so whenever the driver dies, the counts of all
    that has appeared are there, and a repeated batch replaces its own. A violated fail rule stops the query with
    nothing of that batch in the table. For ``aside`` see :func:`publish_batch`.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        counts, spark = RuleCounts(), batch.sparkSession
        with scratch_tables(spark):
            publish_batch(
                build(batch, counts), path, batch_id, lambda: store_counts(counts, spark, metrics, name, batch_id), aside
            )

    return for_each_batch(stream, store, checkpoint, trigger)


def total_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Rows and violations per rule over all micro-batches."""
    totals = [F.sum(c).alias(c) for c in ("n_rows", "n_violations")]
    return spark.read.parquet(path).groupBy("dataset", "rule", "action").agg(*totals)
