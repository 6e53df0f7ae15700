"""Fill-in-the-middle: documents cut at two line boundaries, the parts put in another order between marks.

The units of a text are its lines, each with its newline; a text of n lines has the boundaries 0 to n. A learned rank
index leads from the number of a boundary to its offset in code points: segments of a line, each as long as the line
stays within ``error`` of all its boundaries, predict the offset, and a stored residual of 16 bits for each boundary
corrects the prediction exactly. Prediction is the same double-precision product in Python, where the index is built,
and in the JVM, where it is used, so the corrected offset is exact. :func:`boundary_index` is built once; any number
of transformations, with other seeds or rates, cut by it without looking for lines again.

What is random comes from a hash of the seed and the document's id alone, so results do not depend on partitions, and a
task that runs again gives the same rows. Everything happens within a row: nothing is shuffled, and memory grows with
the longest text only.

A NULL text is empty; an empty text, one that holds a mark, and one that the rate leaves out are plain: the output is
the text, and there are no cuts. A NULL id counts as the word ``null``. Repeated rows are treated alike, rows of one
id are cut by the same hash; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import carried, ship, utf8

#: Code points by which a segment's line may miss a boundary.
ERROR = 64
#: Residuals have 16 bits; rounding the prediction down may add one to the error.
LARGEST_ERROR = (1 << 15) - 2
INDEX_DDL = "n BIGINT, first ARRAY<BIGINT>, at ARRAY<BIGINT>, slope ARRAY<DOUBLE>, residual ARRAY<SMALLINT>"
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"


@dataclass(frozen=True)
class Marks:
    """Strings in front of the parts. None may begin inside another, so that parts can be told apart again."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        starts = {m[:1] for m in marks}
        if "" in marks or len(set(marks)) < 3 or any(c in starts for m in marks for c in m[1:]):
            raise ValueError("marks must differ, and the first character of one must not occur later in any")

    def pattern(self) -> str:
        return "|".join(re.escape(m) for m in (self.prefix, self.suffix, self.middle))


def boundaries(text: bytes) -> np.ndarray:
    """The offsets of all boundaries in code points, from 0 to the length of the text."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == ord("\n")) + 1
    if len(data) and (not len(ends) or ends[-1] < len(data)):
        ends = np.append(ends, len(data))
    offsets = np.zeros(len(ends) + 1, np.int64)
    if len(ends):
        starts = np.concatenate(([0], ends[:-1]))
        np.cumsum(np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64), out=offsets[1:])
    return offsets


def fit(offsets: np.ndarray, error: int = ERROR) -> tuple[list[int], list[int], list[float], np.ndarray]:
    """The boundary and offset that each segment begins at, its slope, and the residuals of all boundaries.

    One pass: a segment keeps the range of slopes that pass within ``error`` of all its boundaries so far, and ends
    before the boundary that would leave none.
    """
    first, at, slope = [0], [int(offsets[0])], []
    low, high = 0.0, float("inf")
    for k, offset in enumerate(offsets[1:].tolist(), 1):
        steps, rise = k - first[-1], offset - at[-1]
        lowest, highest = max(low, (rise - error) / steps), min(high, (rise + error) / steps)
        if lowest > highest:
            slope.append((low + high) / 2)
            first.append(k)
            at.append(offset)
            low, high = 0.0, float("inf")
        else:
            low, high = lowest, highest
    slope.append((low + high) / 2 if high < float("inf") else 0.0)
    lengths = np.diff([*first, len(offsets)])
    steps = np.arange(len(offsets)) - np.repeat(first, lengths)
    predicted = np.repeat(at, lengths) + np.floor(np.repeat(slope, lengths) * steps).astype(np.int64)
    return first, at, slope, (offsets - predicted).astype(np.int16)


def boundary_index(text: Column, error: int = ERROR) -> Column:
    """The index of a text as a struct: how many lines it has, the segments, and the residuals."""
    if not 0 < error <= LARGEST_ERROR:
        raise ValueError(f"the error must be from 1 to {LARGEST_ERROR}")

    @F.arrow_udf(f"STRUCT<{INDEX_DDL.replace(' ', ':').replace(',:', ', ')}>")
    def index(texts: pa.Array) -> pa.Array:
        rows = []
        for value in utf8(texts):
            offsets = boundaries(value)
            first, at, slope, residual = fit(offsets, error)
            rows.append((len(offsets) - 1, first, at, slope, residual))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.int64(), *map(pa.list_, (pa.int64(), pa.int64(), pa.float64(), pa.int16()))]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.StructArray.from_arrays(arrays, ["n", "first", "at", "slope", "residual"])

    return index(text)


def offset_of(index: Column, boundary: Column) -> Column:
    """The offset of a boundary: what its segment predicts, plus its residual."""
    segment = F.size(F.filter(index["first"], lambda first: first <= boundary))
    steps = boundary - F.element_at(index["first"], segment)
    predicted = F.element_at(index["at"], segment) + F.floor(F.element_at(index["slope"], segment) * steps)
    return predicted + F.element_at(index["residual"], (boundary + 1).cast("int"))


def _numbers(seed: int, document: Column, count: int) -> list[Column]:
    """Unsigned 32-bit numbers, the leading groups of eight hex digits of a hash of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(document.cast("string"), F.lit("null")))
    digits = F.sha2(named.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def fill_in_middle(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    seed: int = 7,
    rate: int = 100,
    suffix_first: int = 50,
    marks: Marks = Marks(),
    error: int = ERROR,
) -> DataFrame:
    """One row per document: its id, ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` of a hundred documents are transformed, ``suffix_first`` of a hundred of those with the suffix in front.
    Columns of ``carry`` come along as the struct ``carried``.
    """
    ship(documents.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_col).alias("id"), text.alias("text"), *carried(carry))
    others = ["carried"] if carry else []
    h1, h2, h3, h4 = _numbers(seed, F.col("id"), 4)
    rows = rows.select("*", boundary_index(F.col("text"), error).alias("index"))
    n = F.col("index.n")
    one, other = F.pmod(h1, n + 1), F.pmod(h2, n + 1)
    plain = (n == 0) | (F.pmod(h3, F.lit(100)) >= rate)
    for mark in (marks.prefix, marks.suffix, marks.middle):
        plain = plain | F.contains("text", F.lit(mark))
    form = F.when(plain, PLAIN).when(F.pmod(h4, F.lit(100)) < suffix_first, SUFFIX_FIRST).otherwise(PREFIX_FIRST)
    rows = rows.select(
        "id", "text", *others, "index", n.alias("n"), form.alias("form"),
        F.least(one, other).alias("one"), F.greatest(one, other).alias("other"),
    )
    cut = F.col("form") != PLAIN
    rows = rows.select(
        "id", "text", *others, "n", "form",
        F.when(cut, offset_of(F.col("index"), F.col("one"))).alias("start"),
        F.when(cut, offset_of(F.col("index"), F.col("other"))).alias("end"),
    )

    def part(begin: Column, length: Column) -> Column:
        return F.substring(F.col("text"), begin.cast("int") + 1, length.cast("int"))

    start, end = F.col("start"), F.col("end")
    prefix = F.concat(F.lit(marks.prefix), part(F.lit(0), start))
    suffix = F.concat(F.lit(marks.suffix), part(end, F.length("text") - end))
    middle = F.concat(F.lit(marks.middle), part(start, end - start))
    output = (
        F.when(~cut, F.col("text"))
        .when(F.col("form") == PREFIX_FIRST, F.concat(prefix, suffix, middle))
        .otherwise(F.concat(suffix, prefix, middle))
    )
    return rows.select(
        F.col("id").alias(id_col), *others, "n", "form",
        start.alias("prefix_chars"), (end - start).alias("middle_chars"), output.alias("output"),
    )


def with_restored(transformed: DataFrame, marks: Marks = Marks()) -> DataFrame:
    """Adds ``restored``: the original text, from the output and its form alone."""
    parts, form = F.col("parts"), F.col("form")
    original = (
        F.when(form == PLAIN, F.col("output"))
        .when(form == PREFIX_FIRST, F.concat(parts[1], parts[3], parts[2]))
        .otherwise(F.concat(parts[2], parts[3], parts[1]))
    )
    split = transformed.select("*", F.split("output", marks.pattern(), -1).alias("parts"))
    return split.select(*transformed.columns, original.alias("restored"))


def digest(transformed: DataFrame, id_col: str = "doc_id", marks: Marks = Marks()) -> DataFrame:
    """Hashes of the output and of the text restored from it, in place of the output."""
    return with_restored(transformed, marks).select(
        id_col, "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )
