"""Pairs within buckets, in blocks of bounded size.

A bucket is a key that several rows share. Of a bucket with more rows than a block, every pair of chunks of its rows is a
block of its own, so no task holds more than two chunks of a bucket, and no pair of rows is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import group_starts

KEYS = ["key", "low", "high"]
#: Pairs that are compared at once.
PAIRS = 1 << 15


def shared_buckets(keyed: DataFrame, rows_per_block: int) -> DataFrame:
    """The rows (``key``, ``id``) of all keys that occur more than once, dealt to blocks: ``key``, ``low`` and
    ``high`` name a block, ``right`` tells which of its two chunks the row is of."""
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    chunks = F.ceil(F.col("n") / rows_per_block).cast("int")
    rows = keyed.join(counts, "key").select("key", "id", chunks.alias("chunks"))
    own = F.pmod(F.xxhash64("id", "key"), F.col("chunks")).cast("int")
    rows = rows.select("key", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    return rows.select(
        "key",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).alias("right"),
        "id",
    )


def in_blocks(rows: DataFrame) -> DataFrame:
    """Whole blocks in one partition each, sorted so that :func:`~tidemark.llm.rows.sorted_groups` can cut them."""
    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "right", "id")


def pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs to compare in the blocks of a table, some at a time; the first is never after the
    second. In a block of one chunk these are all pairs, else those of a left and a right row."""
    n = table.num_rows
    starts = group_starts(table, KEYS)
    ends = np.append(starts[1:], n)
    group = np.repeat(np.arange(len(starts)), ends - starts)
    row = np.arange(n)
    one = (table["low"].to_numpy() == table["high"].to_numpy())
    right = table["right"].to_numpy().astype(bool)
    first_right = ends - np.add.reduceat(right, starts) if n else ends
    begin = np.where(one, row + 1, first_right[group])
    count = np.where(one | ~right, ends[group] - begin, 0)
    total = np.cumsum(count)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS, "right")))
        part = count[low:high]
        if part.sum():
            left = np.repeat(row[low:high], part)
            ahead = np.arange(len(left)) - np.repeat(np.cumsum(part) - part, part)
            yield left, np.repeat(begin[low:high], part) + ahead
        low = high
