"""Near-duplicate vectors: sign hashes of random hyperplanes, exact cosines, distributed components.

Equal vectors are one class from the start. Of each class every one of several tables has a bucket, named by the sides
of random hyperplanes on which its vector lies. Vectors that share a bucket are compared exactly, in double precision.
The number of planes follows the logarithm of the number of classes, so that buckets stay small as the input grows;
the number of tables follows from the planes and the chance that is allowed to miss a pair right at the threshold.
A pair that shares several buckets is counted in the first of them. Blocks report counts and the few links that join something
new, never all pairs.

Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with nothing, as do rows with a NULL
id. Vectors of different lengths never link. Rows that repeat an id and its vector count as one. Each row of the input
gives one row; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import KEYS, in_blocks, pairs, shared_buckets
from tidemark.llm.components import Forest, connected_components
from tidemark.llm.rows import ship, sorted_groups
from tidemark.llm.vectors import matrix, norms, vectors_of
from tidemark.session import materialize, settle

ROWS_PER_BLOCK = 1024
#: Bytes of a bucket's code, the first being the highest: enough for the most planes.
CODE_BYTES = 3
SEED = 20240607


def table_shape(classes: int, threshold: float, miss: float) -> tuple[int, int]:
    """Planes and tables: buckets hold few vectors, and a pair at the threshold shares none with chance ``miss``."""
    planes = min(24, max(6, math.ceil(math.log2(max(classes, 2))) + 1))
    same = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(miss) / math.log1p(-same))


@lru_cache(maxsize=8)
def _planes(length: int, planes: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, length]).standard_normal((length, planes * tables))


def near_duplicates(
    embeddings: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    miss: float = 2e-4,
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` (the smallest id reachable) and ``kept``.

    The result is written to the shared folder, and all tables on the way to it are deleted.
    """
    ship(embeddings.sparkSession)
    return settle(
        embeddings.sparkSession,
        "near-duplicates",
        lambda: _near_duplicates(embeddings, id_col, vector_col, threshold, miss),
    )


def _near_duplicates(embeddings: DataFrame, id_col: str, vector_col: str, threshold: float, miss: float) -> DataFrame:
    rows = vectors_of(embeddings, id_col, vector_col)
    usable = rows.where("ok")
    classes = usable.groupBy("vector").agg(F.min("id").alias("id"), F.countDistinct("id").alias("n"))
    planes, tables = table_shape(classes.count(), threshold, miss)

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(planes, dtype=np.int64)
        for batch in batches:
            codes: list = [None] * batch.num_rows
            lengths = np.array(batch["vector"].value_lengths())
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                x = matrix(batch["vector"].take(pa.array(at)))
                sign = x @ _planes(int(length), planes, tables) > 0
                code = (sign.reshape(len(at), tables, planes) @ weights).astype(">u4")
                for i, c in zip(at, code, strict=True):
                    codes[i] = c.view(np.uint8).reshape(tables, 4)[:, 1:].tobytes()
            arrays = [batch["id"], batch["vector"], batch["n"], pa.array(codes, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "vector", "n", "codes"])

    # Codes are computed once and kept, so that all later steps see the same ones.
    classes = materialize(
        classes.select("id", "vector", "n").mapInArrow(
            sides, "id long, vector array<double>, n long, codes binary"
        ),
        "vector-classes",
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))
    keyed = classes.select("id", F.size("vector").alias("length"), "codes", every.alias("t"))
    keyed = keyed.select(_bucket(tables, planes).alias("key"), "id")
    # A row takes along only the codes of the tables before its own: they tell whether a pair has met already.
    before = F.substring("codes", F.lit(1), (F.shiftright("key", planes) % tables).cast("int") * CODE_BYTES)
    shared = shared_buckets(keyed, ROWS_PER_BLOCK).join(classes, "id")
    blocks = in_blocks(shared.withColumn("codes", before))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for table in sorted_groups(batches, KEYS):
            ids = table["id"].to_numpy()
            number = (table["key"].to_numpy() >> planes) % tables
            codes, n = _by_table(table["codes"].to_pylist(), tables), table["n"].to_numpy()
            vectors = table["vector"].combine_chunks()
            lengths = np.array(vectors.value_lengths())
            counts = np.zeros(table.num_rows, np.int64)
            links: list[tuple[int, int]] = []
            for length in np.unique(lengths):
                # Buckets are of one length each; a table may hold several buckets.
                of_length = np.flatnonzero(lengths == length)
                part = table.take(pa.array(of_length)) if len(of_length) < table.num_rows else table
                x = matrix(part["vector"])
                size = norms(x)
                for a, b in pairs(part):
                    cosine = np.einsum("ij,ij->i", x[a], x[b]) / (size[a] * size[b])
                    near = np.flatnonzero(cosine >= threshold)
                    a, b = of_length[a[near]], of_length[b[near]]
                    first = ~((codes[a] == codes[b]) & (codes[a] >= 0)).any(axis=1)
                    a, b = a[first], b[first]
                    np.add.at(counts, a, n[b])
                    np.add.at(counts, b, n[a])
                    links += [p for p in zip(ids[a].tolist(), ids[b].tolist(), strict=True) if forest.join(*p)]
            some = np.flatnonzero(counts)
            own, other = zip(*links, strict=True) if links else ((), ())
            a = np.concatenate([ids[some], np.array(own, np.int64)])
            b = np.concatenate([ids[some], np.array(other, np.int64)])
            n_links = np.concatenate([counts[some], np.zeros(len(own), np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n_links)], names=["a", "b", "n"])

    found = materialize(blocks.mapInArrow(compare, "a long, b long, n long"), "vector-links")
    linked = found.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    components = connected_components(found.where("a != b"))
    facts = (
        classes.select("id", "vector", "n")
        .join(linked, "id", "left")
        .join(components.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "vector",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    single = rows.where(~F.col("ok")).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    out = usable.join(facts, "vector").select("id", "n_links", "component_id").unionByName(single)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))


def _bucket(tables: int, planes: int):
    code = F.conv(F.hex(F.substring("codes", F.col("t") * CODE_BYTES + 1, F.lit(CODE_BYTES))), 16, 10).cast("long")
    return F.shiftleft(F.col("length").cast("long") * tables + F.col("t"), planes).bitwiseOR(code)


def _by_table(codes: list[bytes], tables: int) -> np.ndarray:
    """The codes of rows by table; those after the given ones are -1."""
    out = np.full((len(codes), tables), -1, np.int32)
    sizes = np.array([len(c) // CODE_BYTES for c in codes], np.int64)
    flat = np.frombuffer(b"".join(codes), np.uint8).reshape(-1, CODE_BYTES).astype(np.int32)
    out[np.arange(tables) < sizes[:, None]] = flat[:, 0] << 16 | flat[:, 1] << 8 | flat[:, 2]
    return out
