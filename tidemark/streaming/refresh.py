"""Keeping aggregate tables fresh by recomputing only what new facts touched."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import gold
from tidemark.session import exists, file_system
from tidemark.sources.tables import append, overwrite_partitions

Transform = Callable[[DataFrame], DataFrame]
BUCKET = "bucket"


def _read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) else None


def _of_days(rows: DataFrame, days: Iterable[date | None]) -> DataFrame:
    """Rows of a table that is partitioned by sale_date; None stands for rows without a day."""
    days = list(days)
    wanted = F.col("sale_date").isin([day for day in days if day is not None])
    if None in days:
        wanted = F.coalesce(wanted, F.lit(True))
    return rows.filter(wanted)


def _drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable) -> None:
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        files, place = file_system(spark, f"{path}/{column}={name}")
        files.delete(place, True)


class FreshTable:
    """A table by day, derived from a fact table that is partitioned by sale_date and batch_id.

    ``by_day`` turns facts into rows with a sale_date, which are the table; they are stored day by day.
    """

    def __init__(self, spark: SparkSession, facts: str, root: str, by_day: Transform):
        self.spark, self.facts, self.by_day = spark, facts, by_day
        self.days_path, self.progress_path = f"{root}/days", f"{root}/progress"

    def _refreshed_through(self) -> int:
        progress = _read_if_written(self.spark, self.progress_path)
        return -1 if progress is None else progress.agg(F.max("batch_id")).first()[0]

    def refresh(self, rewritten: Sequence[date | None] = ()) -> list[date | None]:
        """Bring the table up to date and return the days that were recomputed, None for facts without a day.

        New micro-batches are found by their numbers; ``rewritten`` names days whose facts were replaced in place.
        Progress is recorded last: a refresh that dies half-way is repeated with the same result.
        """
        facts = _read_if_written(self.spark, self.facts)
        if facts is None:
            return []
        through = self._refreshed_through()
        unseen = facts.filter(F.col("batch_id") > through)
        # Reads no column but the partition values, and leaves one row per touched day.
        touched = unseen.groupBy("sale_date").agg(F.max("batch_id").alias("batch_id")).collect()
        found = {row["sale_date"] for row in touched} | set(rewritten)
        days = sorted(found, key=lambda day: (day is not None, day))
        if not days:
            return []
        self._recompute(facts, unseen, days, list(rewritten))
        last = max([through, *(row["batch_id"] for row in touched)])
        append(self.spark.createDataFrame([(last,)], "batch_id BIGINT"), self.progress_path)
        return days

    def _totals_of(self, facts: DataFrame, days: Iterable[date | None]) -> DataFrame:
        # Event time decides the day again; the stored partition column only prunes the scan.
        return self.by_day(_of_days(facts, days).drop("sale_date", "batch_id"))

    def _recompute(
        self, facts: DataFrame, unseen: DataFrame, days: list[date | None], rewritten: list[date | None]
    ) -> None:
        overwrite_partitions(self._totals_of(facts, days), self.days_path, ["sale_date"])
        self._drop_emptied_days(facts, rewritten)

    def _drop_emptied_days(self, facts: DataFrame, rewritten: list[date | None]) -> None:
        """A day without facts is not among the partitions that get replaced."""
        if rewritten:
            left = {row[0] for row in _of_days(facts, rewritten).select("sale_date").distinct().collect()}
            _drop_partitions(self.spark, self.days_path, "sale_date", set(rewritten) - left)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.days_path)


class FreshByKey(FreshTable):
    """A table by key, such as one row per customer, made of rows by day and key.

    ``by_day`` gives those rows and ``overall`` the table; both have the ``keys``. Rows by day are stored day by day,
    sorted by a bucket of the keys, and the table is partitioned by that bucket. A refresh recomputes the touched days
    and then the buckets that hold keys of new facts: of the rows by day only those buckets are read, and other
    buckets of the table keep their files. As days are replaced whole, a value may also go down, or a row go away,
    where facts of a day were rewritten.
    """

    def __init__(
        self, spark: SparkSession, facts: str, root: str, by_day: Transform, overall: Transform, keys: Sequence[str],
        buckets: int = 64,
    ):
        super().__init__(spark, facts, root, by_day)
        self.overall, self.keys, self.buckets = overall, list(keys), buckets
        self.table_path = f"{root}/table"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _buckets_of(self, *parts: DataFrame | None) -> set[int]:
        """At most ``buckets`` numbers."""
        found: set[int] = set()
        for part in parts:
            if part is not None:
                found |= {row[0] for row in part.select(self._bucket()).distinct().collect()}
        return found

    def _recompute(
        self, facts: DataFrame, unseen: DataFrame, days: list[date | None], rewritten: list[date | None]
    ) -> None:
        before = _read_if_written(self.spark, self.days_path)
        # A rewritten day may have lost keys that only its old rows tell of, and gained others.
        changed = [unseen]
        if rewritten:
            changed += [_of_days(facts, rewritten), None if before is None else _of_days(before, rewritten)]
        buckets = self._buckets_of(*changed)
        totals = self._totals_of(facts, days).withColumn(BUCKET, self._bucket())
        overwrite_partitions(totals, self.days_path, ["sale_date"], sort_by=[BUCKET])
        self._drop_emptied_days(facts, rewritten)
        stored = _read_if_written(self.spark, self.days_path)
        stale = stored.filter(F.col(BUCKET).isin(sorted(buckets))).drop(BUCKET)
        overwrite_partitions(self.overall(stale).withColumn(BUCKET, self._bucket()), self.table_path, [BUCKET])
        if rewritten:
            left = {row[0] for row in stored.select(BUCKET).distinct().collect()}
            _drop_partitions(self.spark, self.table_path, BUCKET, buckets - left)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.table_path).drop(BUCKET)


def daily_store_sales(spark: SparkSession, facts: str, root: str) -> FreshTable:
    return FreshTable(spark, facts, root, gold.daily_store_sales)


def product_performance(spark: SparkSession, facts: str, root: str) -> FreshTable:
    return FreshByKey(spark, facts, root, gold.product_day_totals, gold.product_performance_from, ["product_id"])


def product_performance_max_category(spark: SparkSession, facts: str, root: str) -> FreshTable:
    return FreshByKey(
        spark, facts, root, gold.product_day_totals, gold.product_performance_max_category_from, ["product_id"]
    )


def customer_value(spark: SparkSession, facts: str, root: str) -> FreshTable:
    return FreshByKey(spark, facts, root, gold.customer_day_totals, gold.customer_value_from, ["customer_id"])
