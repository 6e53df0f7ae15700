"""The last record of every key, kept up to date by a stream of change records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import columns_of
from tidemark.operators.history import latest
from tidemark.session import materialize, scratch_tables
from tidemark.streaming.buckets import BUCKET, Buckets, bucket_of
from tidemark.streaming.queries import for_each_batch


class LatestTable:
    """One row per key: that with the greatest sequence value, ties decided by ``tiebreak``.

    Keys are dealt into :class:`Buckets`. A micro-batch merges its records with the rows of the buckets that they
    touch, and replaces those. As the merge keeps what comes last by sequence, records may come late, in any order
    and more than once. Choose as many buckets as make a micro-batch touch few.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        ddl: str,
        keys: Sequence[str],
        sequence: str,
        tiebreak: Sequence[str] = (),
        *,
        buckets: int = 256,
    ):
        self.spark, self.buckets, self.columns = spark, buckets, list(columns_of(ddl))
        self.keys, self.sequence, self.tiebreak = list(keys), sequence, list(tiebreak)
        self.rows = Buckets(spark, f"{root}/latest", f"{ddl}, {BUCKET} INT")

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest(rows, self.keys, self.sequence, self.tiebreak)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch of change records; the handler for ``for_each_batch``."""
        with scratch_tables(self.spark):
            records = batch.select(*self.columns, bucket_of(self.keys, self.buckets).alias(BUCKET))
            arrived = materialize(self._latest(records), "latest-arrived")
            touched = [row[0] for row in arrived.select(BUCKET).distinct().collect()]
            # A repeated micro-batch must not build on its first attempt.
            known = self.rows.read(touched, before=batch_id)
            self.rows.replace(self._latest(known.unionByName(arrived)), batch_id, touched)

    def read(self) -> DataFrame:
        return self.rows.read().drop(BUCKET)

    def follow(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return for_each_batch(stream, self.apply, checkpoint, trigger)
