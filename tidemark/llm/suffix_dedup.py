"""Removes every byte covered by a string of 100 bytes that also starts earlier, over all documents.

Sorting the suffixes of all positions would move a hundred bytes for each byte of text. So only suffixes that can have a
partner are moved, and most of those as hashes:

* Of each string of 100 bytes the 32 bytes inside it with the smallest hash are its anchor. Equal strings have equal
  anchors at equal places. The strings of one anchor start at consecutive places; together they are a segment, of
  about 37 starts and 136 bytes.
* Segments meet by the hash of their anchor. Equal segments: all but the first are repeated as a whole. An anchor
  without a second segment is done. Where an anchor has several different segments, the first of each kind goes on.
* Those are cut from their texts. Sampled splitters range-partition them by the leading tokens of the suffix at the
  anchor (its 32 bytes, as four tokens), so equal strings are in one partition and none meets another across a
  boundary. There all suffixes of the segments, one for each start, are sorted by a multikey quicksort over their
  first 100 bytes, eight at a time; those that are alone drop out at every step. Of equal ones all but the first are repeated.

Passages that very many documents share would make very many segments meet. From a bounded sample of documents the 32
bytes that at least one in a hundred holds are learned, and are an anchor only where a string holds no others. This
changes which anchor is chosen, for all documents alike, and never the result.

Earlier means a smaller id, or the same document and an earlier start. NULL text is empty; a NULL id is the smallest
id. Rows that repeat an id and its text are one document: they don't repeat each other, and get equal results.
Texts that share an id are told apart by a 64-bit hash and their length, which also order them. Strings never cross documents. Each row of the
input gives one row; an empty table gives none. Memory of a task grows with its longest text, and with the segments of
the most frequent anchor that is not common: one task holds them all, about 1.4 KB for each that is sorted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import carried, group_starts, longs, schema_with, ship, sorted_groups, utf8
from tidemark.llm.shingles import mix
from tidemark.session import materialize, settle

LENGTH, ANCHOR = 100, 32
GRAMS = LENGTH - ANCHOR + 1
#: Documents in the sample, and the share of them that makes an anchor common.
SAMPLE, COMMON = 2000, 0.01
#: Bytes that are hashed at once; a longer text is hashed alone.
CHUNK = 1 << 18
#: Suffixes that are sorted at once.
SUFFIXES = 1 << 19
_COMMON_BIT = np.uint64(1 << 63)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(99).integers(1, 1 << 63, 256, dtype=np.uint64)
_NO_ID = -(1 << 63)
TOKENS = ["t0", "t1", "t2", "t3"]
#: What names a document, none of it ever NULL: the id, a hash of the text, its bytes. With a start it names a place.
DOCUMENT = ["doc", "h", "size"]
PLACE = [*DOCUMENT, "start"]


class _Hashes:
    """Hashes of any stretch of a buffer."""

    power = inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_Hashes.power) < n:
            for name, base in (("power", _STEP), ("inverse", np.uint64(pow(int(_STEP), -1, 1 << 64)))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(_Hashes, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_BYTE[data] * _Hashes.power[: n - 1], out=self.sums[1:])

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * _Hashes.inverse[:n])

    def stretches(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * _Hashes.inverse[start])


class Segments:
    """Segments of some documents: ``row`` (of the document), ``low`` and ``high`` (first and last start), ``anchor`` (its
    place), ``gram`` and ``content`` (hashes)."""

    def __init__(self, texts: list[bytes], common: np.ndarray):
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.row = self.low = self.high = self.anchor = np.zeros(0, np.int64)
        self.gram = self.content = np.zeros(0, np.uint64)
        if len(data) < LENGTH:
            return
        hashes = _Hashes(data)
        grams = hashes.windows(ANCHOR) & ~_COMMON_BIT
        grams = _mark_common(grams, common)
        least = _least_in_windows(grams, GRAMS)
        # A start belongs to a document if all 100 bytes do.
        row = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
        inside = np.arange(len(least)) + LENGTH <= begin[row + 1]
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
        low = np.flatnonzero(change)
        high = np.append(low[1:], len(least)) - 1
        real = inside[low]
        low, high = low[real], high[real]
        place = least[low]
        self.row, start = row[low], begin[row[low]]
        self.low, self.high, self.anchor = low - start, high - start, place - start
        self.gram = grams[place]
        shape = ((high - low) << 8 | place - low).astype(np.uint64)
        self.content = mix(hashes.stretches(low, high + LENGTH) ^ mix(shape))


def _mark_common(grams: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common grams come after all others."""
    if len(common):
        mask = np.zeros(1 << 16, bool)
        mask[common & np.uint64(0xFFFF)] = True
        maybe = np.flatnonzero(mask[(grams & np.uint64(0xFFFF)).astype(np.int64)])
        grams[maybe[np.isin(grams[maybe], common)]] |= _COMMON_BIT
    return grams


def _least_in_windows(values: np.ndarray, size: int) -> np.ndarray:
    """The place of the smallest value, the first of equal ones, in every window; windows double step by step."""
    place, least, width = np.arange(len(values), dtype=np.int32), values, 1
    while width < size:
        step = min(width, size - width)
        first = least[:-step] <= least[step:]
        place = np.where(first, place[:-step], place[step:])
        least = np.where(first, least[:-step], least[step:])
        width += step
    return place.astype(np.int64)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= CHUNK):
            size += len(texts[high])
            high += 1
        yield low, high
        low = high


def _keyed(documents: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """The names of documents (``DOCUMENT``), and ``text``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return documents.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.xxhash64(text).alias("h"),
        F.octet_length(text).alias("size"),
        text.alias("text"),
        *carried(carry),
    )


def common_grams(documents: DataFrame) -> np.ndarray:
    """Hashes of what at least one in a hundred sampled documents holds. ``documents`` are keyed."""
    total = documents.count()
    share = min(1.0, SAMPLE / max(total, 1))
    bound = int(share * (1 << 31)) if share < 1 else 1 << 32
    sample = documents.where(F.pmod(F.xxhash64(*DOCUMENT), F.lit(1 << 31)) < bound).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, n = [], 0
        for batch in batches:
            for text in utf8(batch["text"]):
                n += 1
                if len(text) >= LENGTH:
                    kinds.append(np.unique(_Hashes(np.frombuffer(text, np.uint8)).windows(ANCHOR) & ~_COMMON_BIT))
        values, counts = np.unique(np.concatenate(kinds), return_counts=True) if kinds else (np.zeros(0, np.uint64), np.zeros(0))
        found = values[counts >= max(2, COMMON * n)]
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["gram"])

    # The sample is of bounded size, and so is what it finds.
    found = sample.repartition(1).mapInArrow(count, "gram long").toPandas()["gram"]
    return found.to_numpy(np.int64).view(np.uint64)


def _segments(documents: DataFrame, common: np.ndarray) -> DataFrame:
    """A row per segment: hashes, document, ``start`` (the first) and ``shape`` (starts after the first, place of the
    anchor). Repeats within a batch are told at once: their ``gram`` is NULL."""
    shared = documents.sparkSession.sparkContext.broadcast(common)  # of a bounded sample

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch["text"])
            doc, h, size = (longs(batch[c]) for c in DOCUMENT)
            parts = []
            for low, high in _chunks(texts):
                s = Segments(texts[low:high], shared.value)
                row = s.row + low
                parts.append(
                    (s.gram.view(np.int64), s.content.view(np.int64), doc[row], h[row], size[row], s.low,
                     (s.high - s.low) << 8 | s.anchor - s.low)
                )
            if not parts:
                continue
            gram, content, *place, shape = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((*reversed(place), content, gram))
            gram, content, shape, place = gram[order], content[order], shape[order], [c[order] for c in place]
            same = np.zeros(len(gram), bool)
            same[1:] = (gram[1:] == gram[:-1]) & (content[1:] == content[:-1])
            # The first of equal ones in this batch may be a repeat of one elsewhere; the others are repeats anyway,
            # unless they are the same place of a row that occurs twice.
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
            copy = same & ~_other_place(place, first)
            told = same & ~copy
            keep = ~copy
            gram, content = pa.array(gram[keep], mask=told[keep]), pa.array(content[keep], mask=told[keep])
            yield pa.RecordBatch.from_arrays(
                [gram, content, *_place_arrays(place, keep), pa.array(shape[keep].astype(np.int32))],
                names=["gram", "content", *PLACE, "shape"],
            )

    return documents.mapInArrow(cut, f"gram long, content long, {_PLACE_SPEC}, shape int")


_PLACE_SPEC = "doc long, h long, size int, start int"


def _places(rows: pa.Table) -> list[np.ndarray]:
    return [rows[c].to_numpy() for c in PLACE]


def _other_place(place: list[np.ndarray], of: np.ndarray) -> np.ndarray:
    """Where a place is not that of row ``of``."""
    return np.logical_or.reduce([c != c[of] for c in place])


def _place_arrays(place: list[np.ndarray], rows: np.ndarray) -> list[pa.Array]:
    kinds = (np.int64, np.int64, np.int32, np.int32)
    return [pa.array(c[rows].astype(kind, copy=False)) for c, kind in zip(place, kinds, strict=True)]


def _meet(segments: DataFrame) -> DataFrame:
    """Segments that meet by their anchor: ``whole`` is true for repeats, false for the first of each kind where an
    anchor has several kinds."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["gram"]):
            kinds, grams = group_starts(table, ["gram", "content"]), group_starts(table, ["gram"])
            n = table.num_rows
            first = np.zeros(n, bool)
            first[kinds] = True
            place = _places(table)
            of = kinds[np.cumsum(first) - 1]
            repeat = _other_place(place, of)
            several = np.repeat(np.add.reduceat(first, grams) > 1, np.diff(np.append(grams, n)))
            keep = np.flatnonzero(repeat | first & several)
            yield pa.RecordBatch.from_arrays(
                [*_place_arrays(place, keep), pa.array(table["shape"].to_numpy()[keep]), pa.array(repeat[keep])],
                names=[*PLACE, "shape", "whole"],
            )

    rows = segments.where(F.col("gram").isNotNull())
    rows = rows.repartition("gram").sortWithinPartitions("gram", "content", *PLACE)
    return rows.mapInArrow(meet, f"{_PLACE_SPEC}, shape int, whole boolean")


def _cut_out(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of segments, with the four tokens of their anchor."""
    per_document = wanted.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("start", "shape")).alias("segments"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch["text"])
            segments = batch["segments"]
            flat, counts = segments.flatten(), np.array(segments.value_lengths())
            low, shape = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "shape"))
            row = np.repeat(np.arange(batch.num_rows), counts)
            more, anchor = shape >> 8, shape & 255
            cuts = [texts[r][a:b] for r, a, b in zip(row.tolist(), low.tolist(), (low + more + LENGTH).tolist(), strict=True)]
            heads = b"".join(c[p : p + ANCHOR] for c, p in zip(cuts, anchor.tolist(), strict=True))
            tokens = np.frombuffer(heads, ">u8").astype(np.uint64).reshape(-1, 4).view(np.int64)
            arrays = [pa.array(np.ascontiguousarray(tokens[:, k])) for k in range(4)]
            place = [*(longs(batch[c])[row] for c in DOCUMENT), low]
            arrays += [*_place_arrays(place, slice(None)), pa.array(shape.astype(np.int32)), pa.array(cuts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*TOKENS, *PLACE, "shape", "bytes"])

    spec = f"t0 long, t1 long, t2 long, t3 long, {_PLACE_SPEC}, shape int, bytes binary"
    return documents.join(per_document, DOCUMENT).select(*DOCUMENT, "text", "segments").mapInArrow(cut, spec)


#: Where the tokens of a string begin, those far from the middle first; the last ones overlap.
_ORDER = [0, 92, 8, 84, 16, 76, 24, 68, 32, 60, 40, 52, 48]


def equal_suffixes(words: np.ndarray, row: np.ndarray, start: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the suffixes at ``start`` of ``row`` within each ``group``, by their first 100 bytes.

    ``words[r, i]`` is the token of eight bytes at ``i``. Returns the suffixes that equal another, as indices, and a
    number for each set of equal ones, in order of these numbers.
    """
    left = np.arange(len(row))
    order = np.argsort(group, kind="stable")
    left, group = _shared(left[order], group[order], np.zeros(len(order), np.uint64))
    for at in _ORDER:
        token = words[row[left], start[left] + at]
        order = np.lexsort((token, group))
        left, group = _shared(left[order], group[order], token[order])
    return left, group


def _shared(left: np.ndarray, group: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split sorted groups by their token, and drop those that are alone."""
    new = np.ones(len(left), bool)
    new[1:] = (group[1:] != group[:-1]) | (token[1:] != token[:-1])
    number = np.cumsum(new) - 1
    shared = np.bincount(number, minlength=1)[number] > 1 if len(left) else new
    return left[shared], number[shared]


def _sort(cut: DataFrame) -> DataFrame:
    """Repeats among the suffixes of segments: ``DOCUMENT``, ``low`` and ``high`` (the last start)."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, TOKENS):
            groups = group_starts(table, TOKENS)
            n = table.num_rows
            group = np.repeat(np.arange(len(groups)), np.diff(np.append(groups, n)))
            *document, begins = _places(table)
            begins, shape = begins.astype(np.int64), table["shape"].to_numpy()
            more, anchor = (shape >> 8).astype(np.int64), (shape & 255).astype(np.int64)
            words = _words(table["bytes"].combine_chunks())
            rows, starts = [], []
            # Equal strings have their anchor at the same place, so those of each place can be sorted on their own.
            places = max(1, min(GRAMS, SUFFIXES // max(n, 1)))
            for low in range(0, GRAMS, places):
                first = np.maximum(anchor - (low + places - 1), 0)
                last = np.minimum(anchor - low, more)
                count = np.maximum(last - first + 1, 0)
                row = np.repeat(np.arange(n), count)
                start = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(row))
                equal, number = equal_suffixes(words, row, start, group[row] * 128 + anchor[row] - start)
                row, start = row[equal], start[equal]
                order = np.lexsort((begins[row] + start, *(c[row] for c in reversed(document)), number))
                row, start, number = row[order], start[order], number[order]
                first_of = np.maximum.accumulate(np.where(np.append(True, number[1:] != number[:-1]), np.arange(len(number)), 0)) if len(number) else number
                # A row that occurs twice gives the same place twice; that is no repeat.
                repeat = _other_place([*(c[row] for c in document), begins[row] + start], first_of)
                rows.append(row[repeat])
                starts.append(start[repeat])
            row, start = np.concatenate(rows), np.concatenate(starts)
            order = np.lexsort((start, row))
            row, start = row[order], start[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(row)) - 1 if len(begin) else begin
            low = begins[row[begin]]
            yield pa.RecordBatch.from_arrays(
                [*_place_arrays([*document, begins], row[begin])[:-1], pa.array(low + start[begin]), pa.array(low + start[end])],
                names=[*DOCUMENT, "low", "high"],
            )

    ranged = cut.repartitionByRange(*TOKENS).sortWithinPartitions(*TOKENS)
    return ranged.mapInArrow(sort, "doc long, h long, size int, low long, high long")


def _words(column: pa.Array) -> np.ndarray:
    """For each row the big-endian token of eight bytes at every place."""
    sizes = np.array(column.value_lengths() if hasattr(column, "value_lengths") else pa.compute.binary_length(column))
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    width = LENGTH + GRAMS
    padded = np.zeros((len(sizes), width + 8), np.uint8)
    padded[np.arange(width + 8)[None, :] < sizes[:, None]] = flat
    words = np.zeros((len(sizes), width), np.uint64)
    for k in range(8):
        words |= padded[:, k : k + width].astype(np.uint64) << np.uint64(56 - 8 * k)
    return words


def _repeats(keyed: DataFrame) -> DataFrame:
    """For each document (``DOCUMENT``) with repeated strings where they start: ``repeats``, of (low, high)."""
    segments = materialize(_segments(keyed, common_grams(keyed)), "segments")
    told = F.col("gram").isNull()
    met = materialize(_meet(segments), "met")
    sorted_out = _sort(_cut_out(keyed, met.where(~F.col("whole"))))
    columns = [*PLACE, "shape"]
    whole = met.where("whole").select(columns).union(segments.where(told).select(columns))
    low = F.col("start").cast("long")
    high = low + F.shiftright("shape", 8)
    repeats = whole.select(*DOCUMENT, low.alias("low"), high.alias("high")).unionByName(sorted_out)
    return repeats.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("low", "high")).alias("repeats"))


def remove_repeats(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per document: its id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``, the
    bytes that remain. Columns in ``carry`` come along as the struct ``carried``.

    A run may begin or end inside a character; :func:`as_text` leaves out what is left of such characters.
    """
    ship(documents.sparkSession)
    repeats = settle(documents.sparkSession, "repeats", lambda: _repeats(_keyed(documents, id_col, text_col)))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept, sizes = [], [], [], []
            for text, found in zip(utf8(batch["text"]), batch["repeats"], strict=True):
                runs = _runs(found.values) if found.is_valid else []
                sizes.append(len(text))
                spans.append(len(runs))
                removed.append(sum(b - a for a, b in runs))
                edges = [0, *(x for run in runs for x in run), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            arrays = [pa.array(c, pa.int64()) for c in (sizes, removed, spans)]
            more = ["carried"] if carry else []
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *arrays, pa.array(kept, pa.binary()), *(batch[c] for c in more)],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept", *more],
            )

    rows = _keyed(documents, id_col, text_col, carry).join(repeats, DOCUMENT, "left")
    rows = rows.withColumnRenamed("doc", "id").drop("h", "size")
    out = rows.mapInArrow(
        remove, schema_with(rows, "n_bytes long, n_removed long, n_spans long, kept binary")
    )
    own = F.when(F.col("id") != _NO_ID, F.col("id"))
    return out.withColumn("id", own).withColumnRenamed("id", id_col)


def as_text(kept: Column) -> Column:
    """The characters that are whole in ``kept``; what is left of others goes. U+FFFD takes its place first, so those that
    the text itself holds are written as an escape meanwhile."""
    text = kept.cast("string")
    for old, new in (("\1", "\1a"), ("\ufffd", "\1b")):
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.make_valid_utf8(text)
    for old, new in (("\ufffd", ""), ("\1b", "\ufffd"), ("\1a", "\1")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _runs(found: pa.StructArray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that start anywhere from ``low`` to ``high``."""
    low, end = found.field("low").to_numpy(), found.field("high").to_numpy() + LENGTH
    order = np.argsort(low, kind="stable")
    low, end = low[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, low[1:] > end[:-1]))
    last = np.append(new[1:], len(low)) - 1
    return list(zip(low[new].tolist(), end[last].tolist(), strict=True))
