"""A table of rows dealt into buckets by key, of which a micro-batch replaces some."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import exists, file_system
from tidemark.sources.tables import publish_batch

BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class Buckets:
    """Every micro-batch writes, under its own number, the buckets that it changed; the table is the newest of each.

    A version of a bucket never changes and appears by a rename with all others of its micro-batch, so whenever the
    driver dies, the last complete micro-batch is there. The version before the newest is kept for those who are still
    reading it, older ones are deleted. ``ddl`` has the bucket.
    """

    def __init__(self, spark: SparkSession, path: str, ddl: str):
        self.spark, self.path, self.ddl = spark, path, ddl

    def _versions(self) -> DataFrame:
        ddl = f"{self.ddl}, batch_id BIGINT"
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(self.path)

    def read(self, buckets: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """The newest version of each bucket, or of some of them, as it was before a micro-batch."""
        versions = self._versions()
        if buckets is not None:
            versions = versions.where(F.col(BUCKET).isin(list(buckets)))
        if before is not None:
            versions = versions.where(F.col("batch_id") < before)
        # Needs nothing but the names of the folders, and leaves a row per bucket.
        last = versions.groupBy(BUCKET).agg(F.max("batch_id").alias("batch_id"))
        return versions.join(last, [BUCKET, "batch_id"], "left_semi").drop("batch_id")

    def committed(self) -> int:
        """The last micro-batch that changed anything, -1 if there is none."""
        return self._versions().agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]

    def replace(self, rows: DataFrame, batch_id: int, buckets: Sequence[int]) -> None:
        """Store the new rows of all buckets that a micro-batch changed; a repeated one finds its place taken."""
        publish_batch(rows.hint("rebalance", BUCKET), self.path, batch_id, partitions=[BUCKET])
        versions = self._versions().where(F.col(BUCKET).isin(list(buckets))).select(BUCKET, "batch_id").distinct()
        per_bucket = versions.groupBy(BUCKET).agg(F.sort_array(F.collect_list("batch_id"), asc=False).alias("batches"))
        for number, batches in per_bucket.collect():
            for superseded in batches[2:]:
                files, place = file_system(self.spark, f"{self.path}/batch_id={superseded}/{BUCKET}={number}")
                files.delete(place, True)
