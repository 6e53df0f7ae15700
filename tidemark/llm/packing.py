"""Packs examples into sequences under limits on tokens, segments and loss-bearing tokens at once.

Vector bin packing: a sequence has a capacity in each dimension, an example a demand. The next example of a
sequence is the one with the largest dot product of its demand and what is left of the capacity, both relative
to the limits, among those that fit. So an example that is large where there is much room goes first. Where examples may be
cut, the rest of a sequence is filled with the front of an example.

Each task packs its own examples, holding a bounded number of them, so nothing is shuffled and memory does not
grow with the input. What is left at the end of a task fills sequences whose lengths are powers of two, which
need no padding.

Packing of texts (:func:`pack_documents`): NULL text is empty and has only the closing id. Repeated rows are packed
as often as they occur. A very long text gives full sequences of its own and one remainder. An empty table gives no
sequence. Sequence ids are unique and the same on every run over the same files: the number of the task and a number
within it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import PIECES, Codec
from tidemark.llm.rows import ship

#: Examples that a task holds while it packs.
POOL = 1024


@dataclass(frozen=True)
class Limits:
    """Of a sequence: ``tokens``, ``segments`` and ``loss_tokens`` (None: as many as there are tokens)."""

    tokens: int = 2048
    segments: int = 512
    loss_tokens: int | None = None

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens or self.tokens], float)


class Packer:
    """Packs pieces (key, start, length, loss) into sequences; ``emit`` gets the pieces of each finished one.

    ``loss`` is the number of loss-bearing tokens of a piece; these are taken to be its last ones, as an answer
    follows its prompt.
    """

    def __init__(self, limits: Limits, emit, cut: bool):
        self.limits, self.emit, self.cut = limits, emit, cut
        self.capacity = limits.vector()
        self.demand = np.zeros((POOL + 2, 3))
        self.pieces: list[tuple] = []

    def add(self, key, start: int, length: int, loss: int) -> None:
        if self.cut:
            while length >= self.limits.tokens:
                front = self._front(self.limits.tokens, length, loss, self.capacity)
                self.emit([(key, start, front)], self.limits.tokens)
                start, length, loss = start + front, length - front, min(loss, length - front)
            if not length:
                return
        elif any(np.array([length, 1, loss]) > self.capacity):
            raise ValueError(f"example {key!r} is over the limits")
        self._hold((key, start, length, loss))
        if len(self.pieces) > POOL:
            self._fill()

    def _hold(self, piece: tuple) -> None:
        self.demand[len(self.pieces)] = (piece[2], 1, piece[3])
        self.pieces.append(piece)

    def _take(self, i: int) -> tuple:
        piece, last = self.pieces[i], self.pieces.pop()
        if i < len(self.pieces):
            self.pieces[i] = last
            self.demand[i] = self.demand[len(self.pieces)]
        return piece

    @staticmethod
    def _front(room: float, length: int, loss: int, left: np.ndarray) -> int:
        """The longest front of a piece that fits into ``room`` tokens and what is left of loss tokens."""
        return int(min(room, length, length - loss + left[2]))

    def _fill(self) -> None:
        """Pack one sequence from the pool."""
        left, sequence, size = self.capacity.copy(), [], 0
        while self.pieces and left[0] > 0 and left[1] > 0:
            demand = self.demand[: len(self.pieces)]
            fits = (demand <= left).all(axis=1)
            if fits.any():
                score = np.where(fits, demand / self.capacity @ (left / self.capacity), -1.0)
                key, start, length, loss = self._take(int(score.argmax()))
            elif self.cut:
                i = int(demand[:, 0].argmax())  # cutting the longest keeps pieces long
                key, start, whole, all_loss = self._take(i)
                length = self._front(left[0], whole, all_loss, left)
                if length <= 0:
                    self._hold((key, start, whole, all_loss))
                    break
                rest = min(all_loss, whole - length)
                loss = all_loss - rest
                self._hold((key, start + length, whole - length, rest))
            else:
                break
            sequence.append((key, start, length))
            left -= (length, 1, loss)
            size += length
        self.emit(sequence, size)

    def close(self) -> None:
        """Pack what is left. The last sequence is cut into powers of two, where cutting is allowed."""
        while self.pieces:
            demand = self.demand[: len(self.pieces)].sum(axis=0)
            if self.cut and (demand <= self.capacity).all():
                self._close_short(int(demand[0]))
                return
            self._fill()

    def _close_short(self, total: int) -> None:
        pieces, self.pieces = sorted(self.pieces, key=lambda p: -p[2]), []
        for bit in reversed(range(total.bit_length())):
            size, sequence = total & 1 << bit, []
            room = size
            while room:
                key, start, length, loss = pieces.pop(0)
                if length > room:
                    pieces.insert(0, (key, start + room, length - room, loss))
                    length = room
                sequence.append((key, start, length))
                room -= length
            if size:
                self.emit(sequence, size)


@lru_cache(maxsize=2)
def _encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a tokenizer file. Ids of tokens rise with the ranks of their merges in such files."""
    codec = Codec(path)
    rank = codec.rank
    merged = sorted(i for i in codec.ids.values() if rank[i] >= 0)
    if any(rank[a] > rank[b] for a, b in zip(merged, merged[1:], strict=False)):
        raise ValueError("ids must rise with ranks")
    return tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=codec.ids, special_tokens=codec.special)


PIECE_COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    limits: Limits = Limits(),  # noqa: B008
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: its document, its place there (``start``, ``length``) and in its sequence.

    ``end_id`` closes every document. With ``with_ids`` the packed little-endian ids of the piece follow.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        base = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        texts: dict[int, tuple] = {}  # ids of the documents that have tokens left
        state = {"sequence": 0, "row": 0}

        def emit(sequence, size) -> None:
            offset = 0
            for key, start, length in sequence:
                doc, ids, left = texts[key]
                part = ids[4 * start : 4 * (start + length)]
                more = (part,) if with_ids else ()
                total = len(ids) // 4
                rows.append((doc, start, length, zlib.crc32(part), total, base + state["sequence"], offset, *more))
                offset += length
                texts[key] = (doc, ids, left - length)
                if left == length:
                    del texts[key]
            state["sequence"] += 1

        packer = Packer(limits, emit, cut=True)
        for batch in batches:
            for doc, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = encoding.encode_to_numpy(text or "", allowed_special="all")
                ids = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                key, total = state["row"], len(ids) // 4
                state["row"] += 1
                texts[key] = (doc, ids, total)
                packer.add(key, 0, total, total)
                if len(rows) >= 4096:
                    yield out(rows)
                    rows.clear()
        packer.close()
        if rows:
            yield out(rows)

    spec = PIECE_COLUMNS + (", ids binary" if with_ids else "")
    ship(documents.sparkSession)
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    types = {"long": pa.int64(), "binary": pa.binary()}
    fields = [pa.field("id", {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind])]
    fields += [pa.field(n, types[t]) for n, t in (c.split() for c in spec.split(", "))]
    schema = pa.schema(fields)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    return source.mapInArrow(pack, f"id {kind}, {spec}").withColumnRenamed("id", id_col)


def pack_examples(
    examples: DataFrame, *, id_col: str, tokens_col: str, loss_col: str, limits: Limits = Limits()  # noqa: B008
) -> DataFrame:
    """Places whole examples of instruction data: one row each with ``sequence_id`` and ``offset``.

    ``tokens_col`` and ``loss_col`` count the tokens and the loss-bearing tokens of an example; NULL counts as none.
    Examples without tokens have no place and get NULL for both. An example over the limits fails the job.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        places: list[tuple] = []
        count = 0

        def emit(sequence, size) -> None:
            nonlocal count
            offset = 0
            for key, _, length in sequence:
                places.append((key, base + count, offset))
                offset += length
            count += 1

        packer = Packer(limits, emit, cut=False)
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("id", "tokens", "loss")), strict=True)
            for key, tokens, loss in rows:
                if tokens:
                    packer.add(key, 0, tokens, loss)
                else:
                    places.append((key, None, None))
            yield out(places)
            places.clear()
        packer.close()
        yield out(places)

    ship(examples.sparkSession)
    source = examples.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(tokens_col).cast("int"), F.lit(0)).alias("tokens"),
        F.coalesce(F.col(loss_col).cast("int"), F.lit(0)).alias("loss"),
    )
    kind = source.schema["id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def out(places: list[tuple]) -> pa.RecordBatch:
        ids, sequences, offsets = zip(*places, strict=True) if places else ([], [], [])
        arrays = [pa.array(ids, id_type), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "sequence_id", "offset"])

    return source.mapInArrow(pack, f"id {kind}, sequence_id long, offset long").withColumnRenamed("id", id_col)
