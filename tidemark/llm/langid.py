"""Language identification by prediction by partial matching (PPM) over bytes.

For each language a tree of contexts of up to three bytes holds how often each byte followed. A byte is coded in the
longest context that training saw: with its share there, or with the escape probability of that context (method C)
times its probability in the next shorter context, among the bytes not seen here. So every context has a proper
distribution, and the bits of a text are an exact code length. Statistics are frozen after training; the language with the
shortest code wins, ties go to the name that sorts first.

Training takes a bounded sample: of each language about ``max_documents`` documents, those whose hashed id is below a
bound that follows from their number; whole texts. Prediction reads whole texts of all rows, and nothing but the text.

NULL text, and text without a letter, is ``und`` with score 0, as is everything if there is nothing to learn from. With
a bound (:func:`train_with_bound`) so is text that fits no language.
Rows with a NULL id, text or language are not learned from. Repeated rows get the same prediction; a very long text
is scored in slices, so memory stays bounded; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import carried, schema_with, ship, text_or_carried, texts_of, utf8
from tidemark.session import materialize, scratch_tables

UNDETERMINED = "und"
ORDER = 3
#: Contexts of full length that were seen less often are left to the shorter ones.
LEAST_SEEN = 4
#: Range of hashed ids that a sample is a share of.
HASHES = 1 << 31
#: Positions scored at once.
SLICE = 1 << 18
_LETTER = regex.compile(r"\p{L}")
#: A text fits while its bits a byte are at most so many times those of the median training text, or no more than its own
#: eight; a text is judged as if it had at least so many bytes, as a shorter one tells too little.
TIMES_MEDIAN, OWN_BITS, LEAST_BYTES = 5.0, 8.0, 32


@dataclass
class Model:
    """Counts of byte sequences (three of context, one that follows) for each language; a context of zeros is a start."""

    languages: list[str]
    grams: list[np.ndarray]  # uint32, big-endian order of the four bytes
    counts: list[np.ndarray]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


class Scorer:
    """The model as tables: a context number for every three bytes, and bits by context, byte and language."""

    def __init__(self, model: Model):
        self.languages = model.languages
        grams = [np.stack([g >> s & 255 for s in (24, 16, 8, 0)], axis=1).astype(np.int64) for g in model.grams]
        seen = np.unique(np.concatenate([g.ravel() for g in grams]))
        unseen = 256 - len(seen)
        # Bytes never seen act alike everywhere, so they share one symbol.
        self.symbols = np.full(256, len(seen), np.int64)
        self.symbols[seen] = np.arange(len(seen))
        size = self.size = len(seen) + (unseen > 0)
        grams = [self.symbols[g] for g in grams]
        flat = np.full(size, 1 / 256)
        if unseen:
            flat[-1] = unseen / 256
        rows = [np.stack([self._blend(flat[None], g, c, 0) for g, c in zip(grams, model.counts, strict=True)], 1)[0]]
        # Order 0 has one context; each longer context starts as a copy of the one without its first byte.
        numbers = np.zeros(1, np.int64)
        tables = [rows[0][None]]  # (contexts, languages, symbols) by order
        first = 1
        for order in range(1, ORDER + 1):
            codes = [self._code(g[:, 3 - order : 3], size) for g in grams]
            space = size**order
            total = np.zeros(space)
            for code, count in zip(codes, model.counts, strict=True):
                total += np.bincount(code, count, space)
            kept = np.flatnonzero(total >= (LEAST_SEEN if order == ORDER else 1))
            parent = numbers[kept % size ** (order - 1)] if order > 1 else np.zeros(len(kept), np.int64)
            every = np.concatenate(tables)
            place = np.full(space, -1)
            place[kept] = np.arange(len(kept))
            table = every[parent]
            for k, (g, code, count) in enumerate(zip(grams, codes, model.counts, strict=True)):
                used = place[code] >= 0
                table[:, k] = self._blend(table[:, k], g[used], count[used], place[code[used]])
            tables.append(table)
            numbers = np.tile(numbers, size) if order > 1 else np.zeros(space, np.int64)
            numbers[kept] = first + np.arange(len(kept))
            first += len(kept)
        table = np.concatenate(tables)
        with np.errstate(divide="ignore"):
            bits = -np.log2(table)
        if unseen:
            bits[:, :, -1] += np.log2(unseen)
        self.bits = np.ascontiguousarray(bits.transpose(0, 2, 1).reshape(-1, len(self.languages)), np.float32)
        self.numbers = (numbers * size).astype(np.int32)

    @staticmethod
    def _code(columns: np.ndarray, size: int) -> np.ndarray:
        code = np.zeros(len(columns), np.int64)
        for k in range(columns.shape[1]):
            code = code * size + columns[:, k]
        return code

    def _blend(self, parent: np.ndarray, grams: np.ndarray, counts: np.ndarray, place) -> np.ndarray:
        """Distributions of contexts from their counts and the distributions of the shorter contexts."""
        seen = np.zeros_like(parent)
        np.add.at(seen, (place, grams[:, 3]), counts)
        total, kinds = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
        rest = np.where(seen > 0, 0, parent)
        others = rest.sum(axis=1, keepdims=True)
        escape = np.where(others > 0, kinds, 0)  # nothing is left to escape to if every byte was seen
        blended = (seen + escape * rest / np.where(others > 0, others, 1)) / np.maximum(total + escape, 1)
        return np.where(total > 0, blended, parent)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        pad = bytes(ORDER)
        joined = np.frombuffer(pad + pad.join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = ORDER + np.concatenate([[0], np.cumsum(sizes + ORDER)])[:-1]
        out = np.zeros((len(texts), len(self.languages)))
        for low in range(ORDER, len(joined), SLICE):
            high = min(low + SLICE, len(joined))
            codes = self.symbols[joined[low - ORDER : high]]
            context = codes[:-ORDER].copy()
            for k in range(1, ORDER):
                context = context * self.size + codes[k : k - ORDER]
            # Texts with bytes in this slice, and the padding after each, which is cut off.
            inside = np.flatnonzero((starts < high) & (starts + sizes > low) & (sizes > 0))
            if not len(inside):
                continue
            bits = self.bits[self.numbers[context] + codes[ORDER:]]
            begin = np.maximum(starts[inside], low) - low
            end = np.minimum(starts[inside] + sizes[inside], high) - low
            edges = np.stack([begin, end], axis=1).ravel()
            # reduceat needs every edge inside; a last edge at the end means "to the end".
            sums = np.add.reduceat(bits, edges[:-1] if edges[-1] == high - low else edges, axis=0, dtype=np.float64)
            out[inside] += sums[::2]
        return out


_scorers: dict[str, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    if model.key not in _scorers:
        _scorers.clear()
        _scorers[model.key] = Scorer(model)
    return _scorers[model.key]


def train(
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_documents: int = 600,
) -> Model:
    """Learn from about ``max_documents`` documents of each language, or all if there are fewer.

    What reaches the driver are counts of the sample, bounded by its size and not by the table's.
    """
    ship(labelled.sparkSession)
    return _count(_sample(labelled, id_col, text_col, lang_col, max_documents))


def _sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, max_documents: int) -> DataFrame:
    """What is learned from: ``text``, ``lang`` and ``order``, the hashed id."""
    rows = labelled.select(
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.col(id_col).cast("string")).alias("order"),
    ).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    sample = F.lit(False)
    for lang, total in totals.items():
        bound = int(min(1.0, max_documents / total) * HASHES)
        sample |= (F.col("lang") == lang) & (F.pmod(F.col("order"), F.lit(HASHES)) < bound)
    return rows.where(sample)


def _count(rows: DataFrame) -> Model:
    """The model of a sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = utf8(batch["text"]), np.array(batch["lang"].to_pylist())
            for lang in np.unique(langs):
                pad = bytes(ORDER)
                data = np.frombuffer(pad + pad.join(t for t, x in zip(texts, langs, strict=True) if x == lang), np.uint8)
                wide = data.astype(np.uint32)
                grams = wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]
                # Padding is context only; a real NUL byte after a real byte counts as padding, too.
                grams, counts = np.unique(grams[data[3:] > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )

    found = (
        rows.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(found["lang"].unique())
    of = {lang: found[found["lang"] == lang] for lang in languages}
    return Model(
        languages,
        [of[x]["gram"].to_numpy().astype(np.uint32) for x in languages],
        [of[x]["n"].to_numpy().astype(np.float64) for x in languages],
    )


def train_with_bound(
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_documents: int = 600,
) -> tuple[Model, float | None]:
    """The model of :func:`train`, and the most bits a byte that a text may take in its best language.

    Each half of the training texts is coded by what the other half taught, so no text is coded by itself. The bound
    is five times the median of their bits a byte, so it stays where less than half of them are junk, and never below
    the eight of a byte on its own. It is None where there is no such text.
    """
    spark = labelled.sparkSession
    ship(spark)
    half = F.pmod(F.shiftright("order", 33), F.lit(2))
    with scratch_tables(spark):
        rows = materialize(_sample(labelled, id_col, text_col, lang_col, max_documents), "training")  # of bounded size
        model = _count(rows)
        coded = []
        for k in (0, 1):
            other = _count(rows.where(half != k))
            if other.languages:
                coded.append(_bits_a_byte(rows.where(half == k), other))
        if not coded:
            return model, None
        median = coded[0].union(coded[-1]).agg(F.median("bits")).first()[0]
    return model, None if median is None else max(OWN_BITS, TIMES_MEDIAN * median)


def _bits_a_byte(rows: DataFrame, model: Model) -> DataFrame:
    """``bits``: of every text with a letter the bits a byte in its best language."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch["text"].to_pylist() if _LETTER.search(t)]
            if texts:
                bits = _scorer(shared.value).code_lengths(texts).min(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(bits / [len(t) for t in texts])], names=["bits"])

    return rows.select("text").mapInArrow(code, "bits double")


def has_letter(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))


def predict(
    documents: DataFrame,
    model: Model,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    bound: float | None = None,
) -> DataFrame:
    """One row per document: its id, ``lang_pred``, and ``score``, the probability of that language if all languages
    are equally likely beforehand. A text that takes more than ``bound`` bits a byte is ``und``. Columns in ``carry``
    come along as the struct ``carried``."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the training sample

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value) if shared.value.languages else None
        for batch in batches:
            texts = texts_of(batch, text_col).to_pylist()
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if scorer and t and _LETTER.search(t)]
            if known:
                encoded = [texts[i].encode() for i in known]
                bits = scorer.code_lengths(encoded)
                best = bits.argmin(axis=1)
                most = np.array([max(len(t), LEAST_BYTES) for t in encoded]) * (np.inf if bound is None else bound)
                fits = bits.min(axis=1) <= most
                share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                for i, b, s, fit in zip(known, best, share, fits, strict=True):
                    if fit:
                        names[i], scores[i] = scorer.languages[b], float(s)
            arrays = [batch["id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            more = [batch["carried"]] if carry else []
            yield pa.RecordBatch.from_arrays(
                arrays + more, names=["id", "lang_pred", "score"] + ["carried"] * len(more)
            )

    rows = documents.select(F.col(id_col).alias("id"), *text_or_carried(text_col, carry), *carried(carry))
    out = rows.mapInArrow(score, schema_with(rows, "lang_pred string, score double"))
    return out.withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    """The documents kept from training: a fold by the checksum of the id; a NULL id is in none."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
