"""Splitting the change log of a hot key into ordered segments.

A window over a key runs in one task, however many rows the key has. History operators therefore range-partition
the records of hot keys by (key, order), cut each sorted partition into segments, work on each (key, segment)
separately, and carry a small summary over the boundaries of segments. Where the boundaries fall changes only how the
work is spread, never a result. A partition holds many short segments, so the number of tasks and files follows from
the rows and from the session's partitions, not from the number of segments.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

SLICE = "__slice"
COPIES = "__copies"

ROWS_PER_SLICE = 2_000_000
# So many records of each segment are sampled on average to find hot keys.
_SAMPLES_PER_SLICE = 8
_SAMPLES_OF_HOT_KEY = 2 * _SAMPLES_PER_SLICE
_SEED = 20_240_101
_ROWS_PER_COPY_CHUNK = 100_000
# The row number of monotonically_increasing_id stands in these bits, the partition above them.
_ROW_BITS = 33


def join_by_keys(rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join by columns of both, a NULL being a value like any other; the columns of ``rows`` stay."""
    renamed = others.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    return rows.join(renamed, same, how).drop(*[f"__of_{k}" for k in keys])


@dataclass(frozen=True)
class HotKeys:
    """Keys with so many records that each needs more than one task.

    ``values`` has one row for each, at most one per two segments' worth of records; joins with it broadcast it only
    where Spark finds it small. ``copies`` tells whether masses of identical records were seen, which no boundary
    can separate.
    """

    values: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    n_records: int
    rows_per_slice: int
    copies: bool

    def only(self, log: DataFrame) -> DataFrame:
        """The records of hot keys; identical ones as one record with a count, if there are masses."""
        rows = join_by_keys(log, self.values, self.keys, "left_semi")
        if not self.copies:
            return rows.withColumn(COPIES, F.lit(1).cast("long"))
        # Combined on the map side: a million copies leave a task as one row.
        return rows.groupBy(*log.columns).agg(F.count(F.lit(1)).alias(COPIES))

    def without(self, log: DataFrame) -> DataFrame:
        return join_by_keys(log, self.values, self.keys, "left_anti")

    def segments(self, log: DataFrame) -> DataFrame:
        """The records of hot keys with the number of their segment, which rises with (keys, order).

        Written down, as another run of the exchange might draw other boundaries. A NULL is a value like any other,
        and the first.
        """
        at_once = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n_segments = 1 + self.n_records // self.rows_per_slice
        n_partitions = max(min(n_segments, at_once), 1 + self.n_records // ROWS_PER_SLICE)
        place = [*self.keys, *self.order]
        ranged = self.only(log).repartitionByRange(n_partitions, *place).sortWithinPartitions(*place)
        numbered = ranged.withColumn("__row", F.monotonically_increasing_id())
        in_partition = F.col("__row").bitwiseAND((1 << _ROW_BITS) - 1)
        before = F.col("__row") - in_partition
        cut = numbered.withColumn(SLICE, before + F.floor(in_partition / self.rows_per_slice)).drop("__row")
        return materialize(cut, "hot-key-segments")


def find_hot_keys(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> HotKeys | None:
    """Every key with many more than ``rows_per_slice`` records, or None without such a key.

    A few records per segment are sampled. Only key and order columns are scanned and only samples are
    shuffled: one short job when there is no hot key.
    """
    keys, order = list(keys), list(order)
    share = min(1.0, _SAMPLES_PER_SLICE / rows_per_slice)
    places = (
        log.select(*keys, *order)
        .filter(F.rand(_SEED) < share)
        .groupBy(*keys, *order)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_key = places.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("n").alias("heaviest"))
    hot = per_key.filter(F.col("n") >= _SAMPLES_OF_HOT_KEY)
    seen = hot.agg(F.sum("n").alias("n"), F.max("heaviest").alias("heaviest")).first()
    if seen["n"] is None:
        return None
    n_records = int(seen["n"] / share)
    values = materialize(hot.select(*keys), "hot-keys")
    copies = seen["heaviest"] >= _SAMPLES_OF_HOT_KEY
    return HotKeys(values, tuple(keys), tuple(order), n_records, rows_per_slice, copies)


def spread_copies(df: DataFrame) -> DataFrame:
    """Repeat every record as often as it was counted, in chunks that are dealt out over all tasks."""
    last_chunk = F.expr(f"({COPIES} - 1) div {_ROWS_PER_COPY_CHUNK}")
    chunked = df.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    left = F.col(COPIES) - F.col("__chunk") * _ROWS_PER_COPY_CHUNK
    in_chunk = F.sequence(F.lit(1).cast("long"), F.least(left, F.lit(_ROWS_PER_COPY_CHUNK)))
    return (
        chunked.hint("rebalance")
        .withColumn("__copy", F.explode(in_chunk))
        .drop("__chunk", "__copy", COPIES)
    )
