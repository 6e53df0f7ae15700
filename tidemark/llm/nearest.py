"""Approximate nearest neighbours by cosine: multi-index hashing of learned binary codes, reranked with the vectors.

Codes are the signs of a vector under several rotations, each learned on a bounded sample so that little is lost by
taking signs. They are cut into substrings of 16 bits, and there is a table for every substring. A query looks up all
values that differ from its own in at most some bits; by the pigeonhole principle that retrieves every code within a
radius, and many beyond it. What is retrieved and within the learned total distance is reranked by exact cosine in
double precision. Both distances are the smallest that reach the wanted recall on the sample.

The tables are spread over shards by leading bits of the substring's value, more bits the more rows there are. A row goes
to one shard of each table, however many queries there are. A query goes only to the shards that can hold values near its
own. Rows take along their code and their unit vector in half precision, which rules out all that can't be among the
best; original vectors are fetched by joins for what is left. Shards with very many rows or queries, as many
near copies make, are cut into blocks that all meet. Equal vectors are one class: a query can have use for its smallest
ids only, so no more of them are indexed than are asked for, and one for the query itself.

A query that finds fewer rows than are asked for is compared with all rows of its length, in blocks.

Vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part, nor do rows with a NULL id or
vectors of another length than a query's. Rows that repeat an id are one candidate, with its best score. With fewer
candidates than asked for, all are returned. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.rows import ship, sorted_groups
from tidemark.llm.vectors import matrix, norms, vectors_of
from tidemark.session import materialize, settle

BITS = 16
#: Rows and queries of a shard, or of a block of one: on average, and at most twice as many.
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 1 << 14, 1 << 12
#: The number of the table in which every row is near every query.
ALL = -1
SAMPLE = 8192
SEED = 7


@dataclass(frozen=True)
class Codes:
    """Rotations by vector length, with what recall needs: errors in a substring, and distance in all."""

    rotations: dict[int, np.ndarray]
    errors: dict[int, int]
    radius: dict[int, int]

    def encode(self, unit: np.ndarray) -> np.ndarray:
        """Substrings of the codes of unit vectors, as rows of 16-bit numbers."""
        bits = unit @ self.rotations[unit.shape[1]] > 0
        spare = -bits.shape[1] % BITS
        packed = np.packbits(np.pad(bits, ((0, 0), (0, spare))), axis=1)
        return np.ascontiguousarray(packed).view(np.uint16)


def _learn_rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """A rotation under which the signs are close to the vectors, by turns of signs and best fit."""
    rotation = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(x.T @ np.sign(x @ rotation))
        rotation = left @ right
    return rotation


def _scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, exactly, so that no square of a component is out of range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def fit(vectors: DataFrame, *, bits: int = 256, recall: float = 0.97, k: int = 5, sample: int = SAMPLE) -> Codes:
    """Learn from about ``sample`` rows, those whose hash is below a bound; the first 256 are tried as queries."""
    usable = vectors.where("ok").select("id", "vector")
    bound = int(min(1.0, sample / max(usable.count(), 1)) * (1 << 31))
    hashed = F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 31))
    # Bounded by the sample: repeated rows share a hash and come once.
    rows = sorted(usable.where(hashed < bound).dropDuplicates().collect(), key=lambda r: (r["id"], r["vector"]))
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row["vector"]), []).append(row["vector"])
    codes = Codes({}, {}, {})
    for length, group in by_length.items():
        x = _scaled(np.array(group, float))
        unit = x / norms(x)[:, None]
        rng = np.random.default_rng([SEED, length])
        turns = [_learn_rotation(unit, rng) for _ in range(-(-bits // length))]
        codes.rotations[length] = np.concatenate(turns, axis=1)
        strings = codes.encode(unit)
        queries = min(256, len(unit))
        cosine = unit[:queries] @ unit.T
        cosine[np.arange(queries), np.arange(queries)] = -2
        best = np.argsort(-cosine, axis=1)[:, : min(k, len(unit) - 1)]
        differ = np.bitwise_count(strings[:queries, None] ^ strings[best])
        closest, total = differ.min(axis=2).ravel(), differ.sum(axis=2).ravel()
        # Each of the two may lose half of what recall allows.
        allowed = 1 - (1 - recall) / 2
        codes.errors[length] = int(np.quantile(closest, allowed, method="higher")) if closest.size else BITS
        codes.radius[length] = int(np.quantile(total, allowed, method="higher")) if total.size else strings.shape[1] * BITS
    return codes


def _masks(errors: int) -> np.ndarray:
    """All 16-bit numbers with at most so many bits set."""
    return np.array([sum(1 << b for b in c) for e in range(errors + 1) for c in combinations(range(BITS), e)], np.uint16)


def _spots(words: np.ndarray, bits: int, errors: int) -> np.ndarray:
    """The shards of each row: table and leading bits, for all values with at most so many errors there."""
    leading = words >> (BITS - bits) if bits else np.zeros_like(words)
    near = np.array([m for m in _masks(errors) if m < 1 << bits], np.uint16)
    spots = (np.arange(words.shape[1]) << BITS)[:, None] | (leading[:, :, None] ^ near)
    return spots.reshape(len(words), -1).astype(np.int32)


def _encoded(rows: DataFrame, shared, bits: int, asking: bool) -> DataFrame:
    """``id``, ``length``, ``vector`` (scaled by a power of two), ``size`` (its norm), ``unit`` (half precision), ``words``
    and ``spots``; the last two are empty for lengths that were not learned."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        for batch in batches:
            lengths = pc.list_value_length(batch["vector"]).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                x = _scaled(matrix(part["vector"]))
                size = norms(x)
                unit = x / size[:, None]
                words, spots = np.zeros((len(x), 0), np.uint16), np.zeros((len(x), 0), np.int32)
                if length in codes.rotations:
                    words = codes.encode(unit)
                    spots = _spots(words, bits, codes.errors[length] if asking else 0)
                ends = np.arange(len(x) + 1, dtype=np.int32)
                half = unit.astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["id"],
                        pa.array(np.full(len(x), length, np.int32)),
                        pa.ListArray.from_arrays(ends * length, pa.array(x.ravel())),
                        pa.array(size),
                        pa.array([u.tobytes() for u in half], pa.binary()),
                        pa.array([w.tobytes() for w in words], pa.binary()),
                        pa.ListArray.from_arrays(ends * spots.shape[1], pa.array(spots.ravel())),
                    ],
                    names=["id", "length", "vector", "size", "unit", "words", "spots"],
                )

    return rows.select("id", "vector").mapInArrow(
        encode, "id long, length int, vector array<double>, size double, unit binary, words binary, spots array<int>"
    )


def _stacked(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _slack(length: int) -> float:
    """How far a product of two unit vectors can be off, each rounded to half precision and summed in single."""
    return 2.0**-10 + length * 2.0**-22


def _near(codes: Codes, group: pa.Table, masks: dict, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query of a shard: its number, and places and rough cosines of the rows that may be among its best."""
    asks = int((group["kind"].to_numpy() == 0).sum())
    if not 0 < asks < len(group):
        return
    length, spot = group["length"][0].as_py(), group["spot"][0].as_py()
    ids, unit = group["id"].to_numpy(), _stacked(group["unit"], np.float16).astype(np.float32)
    row_ids, rows_unit = ids[asks:], unit[asks:]
    repeats = int(np.unique(row_ids, return_counts=True)[1].max())
    every = np.arange(len(row_ids))
    if spot != ALL:
        j, errors, radius = spot >> BITS, codes.errors[length], codes.radius[length]
        words = _stacked(group["words"], np.uint16)
        wide = np.pad(words, ((0, 0), (0, -words.shape[1] % 4))).view(np.uint64)
        rows_words, rows_wide = words[asks:], wide[asks:]
        values = rows_words[:, j]
        looked_up = len(masks[length]) < len(values)
        if looked_up:
            order = np.argsort(values, kind="stable")
            starts = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << BITS))])
    for i in range(asks):
        near = every
        if spot != ALL:
            own = words[i]
            if looked_up:
                wanted = (masks[length] ^ own[j]).astype(np.int64)
                high = starts[wanted + 1]
                count = high - starts[wanted]
                near = order[np.repeat(high - np.cumsum(count), count) + np.arange(count.sum())]
            else:
                near = np.flatnonzero(np.bitwise_count(values ^ own[j]) <= errors)
            near = near[np.bitwise_count(rows_wide[near] ^ wide[i]).sum(axis=1) <= radius]
            # A pair that several tables retrieve counts in the first of them.
            near = near[(np.bitwise_count(rows_words[near, :j] ^ own[:j]) > errors).all(axis=1)]
        near = near[row_ids[near] != ids[i]]
        rough = rows_unit[near] @ unit[i]
        most = k * repeats
        if most < len(near):
            best = rough >= np.partition(rough, len(rough) - most)[len(rough) - most] - 2 * _slack(length)
            near, rough = near[best], rough[best]
        yield i, near + asks, rough


def _pairs(queries: DataFrame, index: DataFrame, shared, k: int) -> DataFrame:
    """``query``, ``row``, the row's ``id``, and bounds of the cosine, ``least`` and ``most``; without what k ids beat."""
    shard = ["length", "spot"]
    columns = ["length", F.explode("spots").alias("spot"), "number", "id", "unit", "words"]
    asks, rows = queries.select(*columns), index.select(*columns)
    sizes = (
        asks.select(*shard, F.lit(1).alias("asks"), F.lit(0).alias("rows"))
        .unionAll(rows.select(*shard, F.lit(0), F.lit(1)))
        .groupBy(*shard).agg(F.sum("asks").alias("asks"), F.sum("rows").alias("rows"))
        .where((F.col("asks") > 2 * QUERIES_PER_BLOCK) | (F.col("rows") > 2 * ROWS_PER_BLOCK))
    )
    blocks = sizes.select(
        *shard,
        F.ceil(F.col("asks") / QUERIES_PER_BLOCK).cast("int").alias("ask_blocks"),
        F.ceil(F.col("rows") / ROWS_PER_BLOCK).cast("int").alias("row_blocks"),
    )
    crowded = materialize(blocks, "crowded-shards")  # its measured size decides how it is joined

    def dealt(part: DataFrame, own: str, other: str, kind: int) -> DataFrame:
        count = {c: F.greatest(F.coalesce(c + "_blocks", F.lit(1)), F.lit(1)) for c in ("ask", "row")}
        return part.join(crowded, shard, "left").select(
            *shard, "number", "id", "unit", "words", F.lit(kind).alias("kind"),
            F.pmod(F.xxhash64("number"), count[own]).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), count[other] - 1)).alias(other),
        )

    keys = [*shard, "ask", "row"]
    met = dealt(asks, "ask", "row", 0).unionByName(dealt(rows, "row", "ask", 1))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        masks = {length: _masks(errors) for length, errors in codes.errors.items()}
        for table in sorted_groups(batches, keys):
            marks = np.stack([table[c].to_numpy() for c in keys], axis=1)
            cuts = np.flatnonzero(np.any(marks[1:] != marks[:-1], axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(marks)], strict=True):
                group = table.slice(low, high - low)
                numbers, ids = group["number"].to_numpy(), group["id"].to_numpy()
                slack = _slack(group["length"][0].as_py())
                for i, near, rough in _near(codes, group, masks, k):
                    if len(near):
                        rough = rough.astype(float)
                        of = np.full(len(near), numbers[i])
                        out = [of, numbers[near], ids[near], rough - slack, rough + slack]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)

    names = ["query", "row", "id", "least", "most"]
    found = (
        met.repartition(*keys).sortWithinPartitions(*keys, "kind")
        .mapInArrow(find, "query long, row long, id long, least double, most double")
    )
    # The bar of a query: what its k-th best id reaches at least.
    found = found.repartition("query")
    first = F.row_number().over(W.partitionBy("query", "id").orderBy(F.desc("least"))) == 1
    place = F.row_number().over(W.partitionBy("query", "first").orderBy(F.desc("least")))
    bar = F.max(F.when(F.col("first") & (F.col("place") == k), F.col("least"))).over(W.partitionBy("query"))
    ranked = found.withColumn("first", first).withColumn("place", place).withColumn("bar", bar)
    return ranked.where(F.col("bar").isNull() | (F.col("most") >= F.col("bar"))).select(*names)


def search(
    embeddings: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    codes: Codes | None = None,
) -> DataFrame:
    """The ``k`` nearest rows of each query row: ``query_id``, ``rank`` (from 1), the id, and ``score``.

    Queries are the rows for which ``is_query`` holds; a query is no candidate of its own. Ties go to the smaller id.
    The result is a stored table.
    """
    spark = embeddings.sparkSession
    ship(spark)
    flagged = embeddings.select(id_col, vector_col, F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = vectors_of(flagged, id_col, vector_col).where("ok")
    queries = vectors_of(flagged.where("is_query"), id_col, vector_col).where("ok")
    codes = codes or fit(rows, k=k)
    found = settle(spark, "nearest", lambda: _search(spark, rows, queries, codes, k))
    return found.withColumnRenamed("id", id_col)


def _search(spark: SparkSession, rows: DataFrame, queries: DataFrame, codes: Codes, k: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(codes)  # a few rotations
    bits = min(BITS, max(0, -(-rows.count() // ROWS_PER_BLOCK) - 1).bit_length())
    # Spark applies this limit to a group before it shuffles it, so no task gets a large class.
    of_class = F.row_number().over(W.partitionBy("vector").orderBy("id"))
    kept = rows.dropDuplicates(["id", "vector"]).withColumn("place", of_class).where(F.col("place") <= k + 1)

    def numbered(part: DataFrame, asking: bool, label: str) -> DataFrame:
        # Numbers are stored with the rows, so they stay when a task is run again.
        coded = _encoded(part, shared, bits, asking)
        return materialize(coded.withColumn("number", F.monotonically_increasing_id()), label)

    index = numbered(kept, False, "index")
    asked = numbered(queries.dropDuplicates(["id", "vector"]), True, "queries")
    pairs = materialize(_pairs(asked, index, shared, k), "near-pairs")
    enough = pairs.groupBy("query").agg(F.countDistinct("id").alias("n")).where(F.col("n") >= k)
    short = asked.join(enough, asked["number"] == enough["query"], "left_anti")
    if not short.isEmpty():
        everywhere = F.array(F.lit(ALL)).alias("spots")
        scanned = [t.withColumn("spots", everywhere) for t in (short, index)]
        pairs = pairs.unionByName(_pairs(*scanned, shared, k))
    a = asked.selectExpr("number AS query", "id AS query_id", "vector AS a", "size AS a_size")
    b = index.selectExpr("number AS row", "vector AS b", "size AS b_size")
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    score = product / (F.col("a_size") * F.col("b_size"))
    scored = pairs.join(b, "row").join(a, "query").select("query_id", "id", score.alias("score"))
    best = scored.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "id", "score")
