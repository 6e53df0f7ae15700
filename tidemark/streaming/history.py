"""Dimension history kept in step with a stream of change records, on plain Parquet tables.

A micro-batch looks up the open version of each key that it has records of, and goes on from there: it closes
versions, opens others, and reads nothing that was closed before. A record that is not after the last one of its key
is late. Its key goes back to the last version that ended before the record, and the log is replayed from there;
versions after it are superseded by a cut. So the result is exact however late a record is, and other keys do
not notice.

Tables under ``root``::

    log/batch_id=            every change record, under the batch that brought it
    open/batch_id=/bucket=   the open versions of the buckets that a batch touched; the newest of each bucket counts
    closed/batch_id=         versions that a batch closed
    cuts/batch_id=           keys that went back, and the time from which their versions of earlier batches are void

The open versions are put in place last and at once, and closed versions and cuts count only up to the last batch
that has done so. A batch that died half-way is not seen, and is repeated with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.history import (
    CURRENT,
    END,
    START,
    history_of_every_change,
    history_of_tracked_columns,
)
from tidemark.operators.quality import enforce, fail
from tidemark.operators.slices import ROWS_PER_SLICE, join_by_keys
from tidemark.session import exists, materialize, scratch_tables
from tidemark.sources.tables import write_batch
from tidemark.streaming.buckets import BUCKET, Buckets, bucket_of
from tidemark.streaming.queries import for_each_batch

# The time from which the versions of a key are void, and the last record that stays, in one struct.
_FROM, _AFTER = "__from", "__after"


class HistoryTable:
    """``tracked`` as in :func:`history_of_tracked_columns`, or None for a version per change record.

    A micro-batch rewrites the open versions of the buckets it touches, one row per key, so choose enough buckets that
    it touches few.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        ddl: str,
        keys: Sequence[str],
        sequence: str,
        tiebreak: Sequence[str] = (),
        tracked: Sequence[str] | None = None,
        *,
        excluded: Sequence[str] = (),
        ignore_nulls: bool = True,
        buckets: int = 256,
        rows_per_slice: int = ROWS_PER_SLICE,
    ):
        self.spark, self.root = spark, root
        self.keys, self.sequence, self.tiebreak = list(keys), sequence, list(tiebreak)
        self.tracked, self.excluded, self.ignore_nulls = tracked, list(excluded), ignore_nulls
        self.buckets, self.rows_per_slice = buckets, rows_per_slice
        self.records = T.StructType.fromDDL(ddl)
        self.log_ddl = f"{ddl}, {BUCKET} INT, batch_id BIGINT"
        version = f"{ddl}, {BUCKET} INT, {START} TIMESTAMP, {END} TIMESTAMP, {CURRENT} BOOLEAN"
        self.version = T.StructType.fromDDL(version).names
        self.open = Buckets(spark, f"{root}/open", version)
        self.closed_ddl = f"{version}, batch_id BIGINT"
        key_types = ", ".join(f"`{k}` {self.records[k].dataType.simpleString()}" for k in keys)
        self.cuts_ddl = f"{key_types}, {BUCKET} INT, {_FROM} TIMESTAMP, batch_id BIGINT"

    def _read(self, table: str, ddl: str) -> DataFrame:
        path = f"{self.root}/{table}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(path)

    def _with_key(self, rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
        """Join by key, a NULL key being one like any other; ``others`` loses its keys."""
        return join_by_keys(rows, others, [*self.keys, BUCKET], how)

    def _order(self):
        return F.struct(self.sequence, *self.tiebreak)

    def _history(self, records: DataFrame) -> DataFrame:
        """Versions of records, and of versions to go on from, which have a start of their own."""
        options = {"sentinel": False, "rows_per_slice": self.rows_per_slice}
        if self.tracked is None:
            return history_of_every_change(
                records.drop(START), self.keys, self.sequence, self.tiebreak, **options
            )
        return history_of_tracked_columns(
            records,
            [BUCKET, *self.keys],
            self.sequence,
            self.tracked,
            self.tiebreak,
            ignore_nulls=self.ignore_nulls,
            started_at=START,
            **options,
        )

    def _as_records(self, log: DataFrame) -> DataFrame:
        return log.select(*self.records.names, BUCKET, F.col(self.sequence).alias(START))

    def _as_seeds(self, versions: DataFrame) -> DataFrame:
        return versions.select(*self.records.names, BUCKET, START)

    def _closed(self, through: int) -> DataFrame:
        """Closed versions up to a batch, without those that a later batch has cut off."""
        closed = self._read("closed", self.closed_ddl).where(F.col("batch_id") <= through)
        cuts = self._read("cuts", self.cuts_ddl).where(F.col("batch_id") <= through)
        void = cuts.withColumnsRenamed({k: f"__{k}" for k in [*self.keys, BUCKET, "batch_id"]})
        same = (F.col(BUCKET) == F.col(f"__{BUCKET}")) & (F.col("batch_id") < F.col("__batch_id"))
        for key in self.keys:
            same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
        after = F.col(_FROM).isNull() | (F.col(START) >= F.col(_FROM))
        return closed.join(void, same & after, "left_anti").select(*self.version)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of change records; the handler for ``for_each_batch``."""
        # Without a sequence value a record has no place in the history, and must not vanish either.
        known = fail("known_sequence", f"{self.sequence} IS NOT NULL")
        records = enforce(batch.select(*self.records.names), [known])
        records = records.withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        # Sorted by bucket, so that a scan for some buckets skips the rest of a file.
        by_bucket = records.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET)
        write_batch(by_bucket, f"{self.root}/log", batch_id)
        with scratch_tables(self.spark):
            self._merge(batch_id)

    def _merge(self, batch_id: int) -> None:
        arrived = self._read("log", self.log_ddl).where(F.col("batch_id") == batch_id).drop("batch_id")
        touched = [row[0] for row in arrived.select(BUCKET).distinct().collect()]
        if not touched:
            return
        # A repeated batch must not build on its first attempt.
        opened = materialize(self.open.read(touched, before=batch_id), "open-versions")
        first = arrived.groupBy(BUCKET, *self.keys).agg(F.min(self.sequence).alias("__first"))
        last = opened.select(*self.keys, BUCKET, F.col(self.sequence).alias("__last"))
        # One row per touched key.
        first = materialize(self._with_key(first, last, "left"), "touched-keys")
        late = first.where(F.col("__last") >= F.col("__first"))
        late_buckets = [row[0] for row in late.select(BUCKET).distinct().collect()]
        sources = [self._as_records(arrived), self._as_seeds(self._with_key(opened, first, "left_semi"))]
        cuts = None
        if late_buckets:
            cuts = materialize(self._cuts(late, late_buckets, batch_id), "cuts")
            sources = [self._with_key(source, cuts, "left_anti") for source in sources]
            sources += self._replayed(cuts, late_buckets, batch_id)
        # Stored, as the history goes over its records more than once.
        source = materialize(reduce(DataFrame.unionByName, sources), "replayed-records")
        versions = self._history(source).select(*self.version)
        if cuts is not None:
            # The version that a key went back to is there already.
            versions = self._with_key(versions, cuts, "left").where(
                F.col(_FROM).isNull() | (F.col(START) >= F.col(_FROM))
            )
        versions = materialize(versions.select(*self.version), "versions")
        self._append(versions.where(~F.col(CURRENT)), "closed", batch_id)
        if cuts is not None:
            self._append(cuts.drop(_AFTER), "cuts", batch_id)
        untouched = self._with_key(opened, first, "left_anti").select(*self.version)
        self.open.replace(versions.where(CURRENT).unionByName(untouched), batch_id, touched)

    def _append(self, rows: DataFrame, table: str, batch_id: int) -> None:
        by_bucket = rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET)
        write_batch(by_bucket, f"{self.root}/{table}", batch_id)

    def _cuts(self, late: DataFrame, buckets: list[int], batch_id: int) -> DataFrame:
        """Per late key, when the last version that ended before its first new record did so, and that version's row;
        NULL if there is none.

        A version without duration may share its time with others, so none of those is gone back to.
        """
        closed = self._closed(batch_id - 1).where(F.col(BUCKET).isin(buckets))
        before = self._with_key(closed, late, "inner").where(
            (F.col(START) < F.col(END)) & (F.col(END) < F.col("__first"))
        )
        whole = F.struct(*self.version)
        found = before.groupBy(BUCKET, *self.keys).agg(F.max_by(whole, F.col(END)).alias(_AFTER))
        found = found.withColumn(_FROM, F.col(_AFTER)[END])
        return self._with_key(late.select(*self.keys, BUCKET), found, "left")

    def _replayed(self, cuts: DataFrame, buckets: list[int], batch_id: int) -> list[DataFrame]:
        """The versions that late keys go back to, and all records after them."""
        log = self._read("log", self.log_ddl).where((F.col("batch_id") <= batch_id) & F.col(BUCKET).isin(buckets))
        order = F.struct(*[F.col(_AFTER)[c] for c in (self.sequence, *self.tiebreak)])
        after = F.col(_AFTER).isNull() | (self._order() > order)
        replayed = self._with_key(log, cuts, "inner").where(after)
        seeds = cuts.where(F.col(_AFTER).isNotNull()).select(f"{_AFTER}.*")
        return [self._as_records(replayed), self._as_seeds(seeds)]

    def read(self) -> DataFrame:
        """The whole history, without the excluded columns."""
        committed = self.open.committed()
        versions = self.open.read().unionByName(self._closed(committed))
        return versions.drop(BUCKET, *self.excluded)

    def current(self) -> DataFrame:
        """Open versions only; closed ones are not even listed."""
        return self.open.read().drop(BUCKET, *self.excluded)

    def follow(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return for_each_batch(stream, self.apply, checkpoint, trigger)
