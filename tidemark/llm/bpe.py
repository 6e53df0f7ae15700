"""Byte-level BPE by backtracking: exact merges in time linear in the text, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives the longest token that starts at each byte. The encoder appends
that token if it is compatible with the token before it, tries shorter prefixes that are tokens if not, and steps back
where none fits. Two tokens are compatible if merging their joined bytes gives the same two tokens again; that
depends on the pair alone, so it is decided once for each pair and kept in a table. A sequence whose neighbours
are all compatible is the sequence that merges give.

Texts are first cut into the pieces in which merges happen, and the strings of special tokens are taken out. Pieces repeat,
so a bounded cache keeps their ids.

NULL text is empty and has no tokens. Rows are encoded one by one: repeated rows get the same ids, a very long text
costs memory in proportion to itself, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import ship, utf8

#: Entries of each of the two generations of a cache; pieces that are rarer than that are encoded again.
CACHE_ENTRIES = 250_000
#: Longer pieces are not kept.
CACHE_CHARS = 40
#: Entries of the pair table before it starts anew.
PAIR_ENTRIES = 1_000_000
# Fixed value: the pieces of byte-level vocabularies of this kind.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in vocabulary files: printable bytes for themselves, the others
    numbered from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    alphabet = {chr(b): b for b in printable}
    others = (b for b in range(256) if chr(b) not in alphabet)
    return alphabet | {chr(256 + i): b for i, b in enumerate(others)}


class _Cache(dict):
    """Computes what is missing and keeps it for two generations; what is used again moves to the new one."""

    def __init__(self, compute):
        self.compute, self.old = compute, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class _WhiteSpace(Exception):
    """A space is followed by more white space or by the end."""


class Codec:
    """A byte-level BPE vocabulary from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or splitter != splitter | {"type": "ByteLevel", "add_prefix_space": False}:
            raise ValueError("the file must hold a byte-level BPE without a prefix space")
        if spec["normalizer"] or model["dropout"] or model["ignore_merges"] or not splitter.get("use_regex", True):
            raise ValueError("normalisation, dropout and direct look-up are not supported")
        alphabet = _byte_alphabet()
        as_bytes = lambda s: bytes(alphabet[c] for c in s)
        self.ids = {as_bytes(token): i for token, i in model["vocab"].items() if all(c in alphabet for c in token)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("special tokens must be plain strings")
        for content in self.special:
            self.ids.pop(content.encode(), None)
        self._read_merges(model["merges"], as_bytes)
        self._read_prefixes()
        self.pairs: dict[tuple[int, int], bool] = {}
        by_id = {i: t for t, i in self.ids.items()} | {i: c.encode() for c, i in self.special.items()}
        size = max(by_id) + 1
        tokens = [by_id.get(i, b"") for i in range(size)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._pattern = regex.compile(PIECES)
        self._specials = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        self._piece_cache = _Cache(self._encode_piece)
        self._word_cache = _Cache(self._encode_word)

    def _read_merges(self, merges, as_bytes) -> None:
        """For each token the merge that makes it: rank, left and right part; bytes have rank -1."""
        size = max(self.ids.values()) + 1
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(merges):
            a, b = (as_bytes(part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.merged[left, right] = rank
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, left, right

    def _read_prefixes(self) -> None:
        """The automaton, and for each token the longest token that is a proper prefix of it."""
        self.length = [0] * len(self.rank)
        self.shorter = [-1] * len(self.rank)
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.length[i] = len(token)
            self.automaton.add_word(token.decode("latin-1"), i)
            for end in range(len(token) - 1, 0, -1):
                if token[:end] in self.ids:
                    self.shorter[i] = self.ids[token[:end]]
                    break
        self.automaton.make_automaton()

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` together gives ``a`` and ``b``.

        Looks back in time at the two parts that touch. As long as both are there, the merge of the two must not
        come before the merges that made them. Of equal merges the one further left comes first.
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            known = self.pairs[a, b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        rank, merged = self.rank, self.merged
        before = len(merged)  # a merge of the two at an earlier rank would have come first
        while True:
            if merged.get((a, b), before) < before:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                before, a = rank[a], self.right[a]
            else:
                before, b = rank[b] + 1, self.left[b]

    def encode_bytes(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        direct = self.ids.get(data)
        if direct is not None:
            return [direct]
        size = len(data)
        longest = [-1] * (size + 1)
        length, shorter, compatible = self.length, self.shorter, self.compatible
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end - length[token] + 1] = token  # matches come by their end, so the longest comes last
        open_ends = bytearray(b"\1") * (size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token >= 0:
                end = at + length[token]
                if open_ends[end] and (not out or compatible(out[-1], token)):
                    out.append(token)
                    at, token = end, longest[end]
                    break
                token = shorter[token]
            else:
                if not out:
                    raise ValueError("a byte is missing in the vocabulary")
                open_ends[at] = 0  # nothing leads on from here
                last = out.pop()
                at -= length[last]
                token = shorter[last]
        return out

    def _encode_piece(self, piece: str) -> bytes:
        return np.array(self.encode_bytes(piece.encode()), "<u4").tobytes()

    def _encode_pieces(self, text: str) -> bytes:
        return b"".join(map(self._piece_cache.__getitem__, self._pattern.findall(text)))

    def _encode_word(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise _WhiteSpace
        return self._encode_pieces(" " + word)

    def _encode_plain(self, text: str) -> bytes:
        # A space before a character that isn't white space begins a piece. So where that holds for every space,
        # words with the space before them can be cached whole.
        first, *words = text.split(" ")
        try:
            return self._encode_pieces(first) + b"".join(map(self._word_cache.__getitem__, words))
        except _WhiteSpace:
            return self._encode_pieces(text)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self._specials is None or not any(s in text for s in self.special):
            return self._encode_plain(text)
        parts = self._specials.split(text)
        return b"".join(
            np.uint32(self.special[p]).tobytes() if i % 2 else self._encode_plain(p) for i, p in enumerate(parts)
        )

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of tokens, gathered from one array by their offsets."""
        starts = self.offsets[ids]
        lengths = self.offsets[ids.astype(np.int64) + 1] - starts
        total = int(lengths.sum())
        if not total:
            return b""
        ends = np.cumsum(lengths)
        # The source of each byte: its place in the output, moved by where its token lies.
        return self.bytes[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)].tobytes()

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(np.frombuffer(ids, "<u4")).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a file, once for each Python worker."""
    return Codec(path)


def encode_documents(
    documents: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id and ``ids``, the token ids as packed little-endian unsigned 32-bit integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(vocabulary)
        for batch in batches:
            ids = [words.encode(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(ids, pa.binary())], names=["id", "ids"])

    ship(documents.sparkSession)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def decode_documents(
    encoded: DataFrame, vocabulary: str, *, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """One row per document: its id and its ``text``. NULL ids give an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(vocabulary)
        for batch in batches:
            texts = [words.decode(ids) for ids in utf8(batch["ids"])]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(texts, pa.string())], names=["id", "text"])

    ship(encoded.sparkSession)
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip_digest(
    documents: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encodes and decodes every document; one row each with the number of tokens and digests of ids and text.

    The same as decoding the result of :func:`encode_documents`, without passing ids between two Python steps.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(vocabulary)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch["text"].to_pylist():
                ids = words.encode(text or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(words.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    ship(documents.sparkSession)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(digest, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
