"""Near-duplicate documents: min-hash signatures, a multi-index Hamming join, links confirmed on full shingle sets.

A document's signature has the lowest 16 bits of its smallest shingle hash under each of 32 functions. Two sets of
Jaccard similarity ``J`` agree in each place with chance ``J``, so a pair at 0.75 differs in 8 places on average, and in more
than 17 with chance 1.6e-4. The join finds every pair of signatures that differ in at most 17 places: cut into 9
chunks, they differ in at most one place of some chunk, so they agree on that chunk with one place left out. Each
signature therefore has one key for every chunk and every place that is left out.

Documents with equal sets are one class from the start. Keys that one class alone has are dropped; buckets are compared in
blocks of bounded size. First every class proposes its nearest partners, one with a smaller and one with a larger id; these are
confirmed on the full sets, which connects most of what belongs together. Then all other pairs within the distance that
still lie in different components are confirmed inside their blocks, but for those that cannot be links because too
many of their shingles are nobody else's. So no link that could change a component is left out, and the many pairs
inside a large group of near copies are neither confirmed one by one nor written anywhere.

Sets: A-Z in lower case, words are runs of bytes other than space and 0x09 to 0x0D, shingles are five words; with fewer words
the whole sequence is one. NULL text, and text without words, has an empty set and links with nothing, as do rows with
a NULL id (their component is NULL). Rows that repeat an id are judged by their own texts; as links they count as
one document. Each row of the input gives one row; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import KEYS, in_blocks, pairs, shared_buckets
from tidemark.llm.components import Forest, connected_components
from tidemark.llm.rows import ship, sorted_groups, utf8
from tidemark.llm.shingles import mix, shingle_sets
from tidemark.session import materialize, settle

WORDS = 5
PLACES, CHUNKS, ERRORS = 32, 9, 1
RADIUS = CHUNKS * (ERRORS + 1) - 1
ROWS_PER_BLOCK = 1024

_rng = np.random.default_rng(11)
_FACTORS = _rng.integers(0, 1 << 31, PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _rng.integers(0, 1 << 32, PLACES, dtype=np.uint32)
#: For each key the places that must agree: a chunk without one of its places.
KEPT = [
    [p for p in chunk if p != left_out]
    for chunk in (c.tolist() for c in np.array_split(np.arange(PLACES), CHUNKS))
    for left_out in chunk
]
_MUST = np.array([[p in kept for p in range(PLACES)] for kept in KEPT])


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the smallest hash under every function."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    least = (x[None, :] * _FACTORS[:, None] + _TERMS[:, None]).min(axis=1)
    return (mix(least.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def signatures(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n`` (size of the set), ``h1`` and ``h2`` (a hash of the set), ``sig`` (packed places)."""
    ship(documents.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h1, h2, sig = [], [], [], []
            for shingles in shingle_sets(utf8(batch["text"]), WORDS):
                n.append(len(shingles))
                h1.append(int(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                h2.append(int(mix(shingles + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).astype(np.int64)))
                sig.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(sig, pa.binary())],
                names=["id", "n", "h1", "h2", "sig"],
            )

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(sign, "id long, n long, h1 long, h2 long, sig binary")


def _keys(classes: DataFrame) -> DataFrame:
    """``key`` and ``id``: one row for every class and every way to leave out a place."""
    factors = mix(np.arange(1, _MUST.size + 1, dtype=np.uint64)).reshape(_MUST.shape) | np.uint64(1)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _places(batch["sig"]).astype(np.uint64)
            hashed = np.stack([mix((sig[:, k] * f[k]).sum(axis=1) + f[0]) for k, f in zip(KEPT, factors, strict=True)], axis=1)
            ids = batch["id"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashed.ravel().view(np.int64)), pa.array(np.repeat(ids, len(KEPT)))], names=["key", "id"]
            )

    return classes.select("id", "sig").mapInArrow(keys, "key long, id long")


def _places(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, PLACES)


def _close_pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows and distance of the pairs in blocks that are within the radius, where their first common key is this one."""
    sig = _places(table["sig"])
    n, key = table["n"].to_numpy(), table["key"].to_numpy()
    own = _key_numbers(sig, key)
    for a, b in pairs(table):
        # A set of less than three quarters of the other's size can't be similar enough.
        fits = 4 * np.minimum(n[a], n[b]) >= 3 * np.maximum(n[a], n[b])
        a, b = a[fits], b[fits]
        differ = sig[a] != sig[b]
        distance = differ.sum(axis=1)
        near = np.flatnonzero(distance <= RADIUS)
        a, b, differ, distance = a[near], b[near], differ[near], distance[near]
        first = (differ @ _MUST.T.astype(np.float32) == 0).argmax(axis=1) == own[a]
        yield a[first], b[first], distance[first]


def _key_numbers(sig: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which of its keys each row is here for."""
    factors = mix(np.arange(1, _MUST.size + 1, dtype=np.uint64)).reshape(_MUST.shape) | np.uint64(1)
    number, wide = np.full(len(sig), -1), sig.astype(np.uint64)
    for v, (kept, f) in enumerate(zip(KEPT, factors, strict=True)):
        same = mix((wide[:, kept] * f[kept]).sum(axis=1) + f[0]).view(np.int64) == key
        number[same & (number < 0)] = v
    return number


def _nearest(blocks: DataFrame) -> DataFrame:
    """For each class its nearest partner with a smaller and with a larger id: ``a`` (smaller), ``b``.

    The smaller ones connect all of a group; with the larger ones, whoever has a partner is in a pair.
    """

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, KEYS):
            ids = table["id"].to_numpy()
            best: list[np.ndarray] = []
            for a, b, distance in _close_pairs(table):
                low, high = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])
                both = [np.stack([high, distance, low], axis=1), np.stack([low, distance, high], axis=1)]
                down, up = (_first_by(np.concatenate([x, y])) for x, y in zip(both, best or both, strict=True))
                best = [down, up]
            found = np.concatenate(best) if best else np.zeros((0, 3), np.int64)
            columns = (pa.array(np.ascontiguousarray(c)) for c in found.T)
            yield pa.RecordBatch.from_arrays([*columns], names=["own", "distance", "other"])

    proposed = blocks.mapInArrow(propose, "own long, distance long, other long")
    nearest = F.min(F.struct("distance", "other"))["other"]
    chosen = proposed.groupBy("own", F.col("other") < F.col("own")).agg(nearest.alias("other"))
    return chosen.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).distinct()


def _first_by(rows: np.ndarray) -> np.ndarray:
    """The first row, in order of all columns, of each value of the first column."""
    rows = rows[np.lexsort(rows.T[::-1])]
    return rows[np.append(True, rows[1:, 0] != rows[:-1, 0])] if len(rows) else rows


def _unsettled(blocks: DataFrame) -> DataFrame:
    """The rows of blocks that have a close partner in another component, ``key``, ``low``, ``high``, ``right``, ``id``.

    With a column ``shared`` pairs that cannot be links don't count: two sets have at most those shingles in common
    that either shares with anyone, and a link takes three sevenths of the sum of their sizes.
    """
    columns = [*KEYS, "right", "id"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, KEYS):
            found = np.zeros(table.num_rows, bool)
            for a, b in _apart(table):
                found[a] = found[b] = True
            yield from table.select(columns).filter(pa.array(found)).to_batches()

    return blocks.mapInArrow(find, blocks.select(columns).schema)


def _apart(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of close pairs in different components that can be links."""
    component, n = table["component"].to_numpy(), table["n"].to_numpy()
    shared = table["shared"].to_numpy() if "shared" in table.column_names else n
    for a, b, _ in _close_pairs(table):
        can = (component[a] != component[b]) & (7 * np.minimum(shared[a], shared[b]) >= 3 * (n[a] + n[b]))
        yield a[can], b[can]


def _own_shingles(sets: DataFrame) -> DataFrame:
    """For each ``id`` of several sets how many of its shingles no other set has, as ``own``. An id that occurs with
    several texts is left out."""
    once = sets.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows = 1").select("id")
    holders = sets.select("id", F.explode("set").alias("shingle")).groupBy("shingle")
    single = holders.agg(F.count(F.lit(1)).alias("holders"), F.min("id").alias("id")).where("holders = 1")
    return single.groupBy("id").agg(F.count(F.lit(1)).alias("own")).join(once, "id", "left_semi")


def _across(blocks: DataFrame) -> DataFrame:
    """Links between different components, of the close pairs in blocks: ``a``, ``b``. At most one for each two
    components that a task has not joined yet."""

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for table in sorted_groups(batches, KEYS):
            ids, component, n = (table[c].to_numpy() for c in ("id", "component", "n"))
            flat = np.unique(table["set"].combine_chunks().flatten().to_numpy(), return_inverse=True)[1]
            ends = np.cumsum(n)
            mark = np.zeros(len(flat) + 1, bool)
            links: list[tuple[int, int]] = []
            for a, b in _apart(table):
                for left in np.unique(a):
                    others = b[a == left]
                    own = flat[ends[left] - n[left] : ends[left]]
                    mark[own] = True
                    sizes = n[others]
                    inner = np.repeat(ends[others] - sizes - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    common = np.add.reduceat(mark[flat[inner]], np.cumsum(sizes) - sizes, dtype=np.int64)
                    mark[own] = False
                    for right in others[100 * common >= 75 * (n[left] + sizes - common)]:
                        if forest.join(int(component[left]), int(component[right])):
                            links.append((int(ids[left]), int(ids[right])))
            columns = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return blocks.mapInArrow(cross, "a long, b long")


def _confirmed(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidates whose full sets are similar enough."""
    a, b = sets.select(F.col("id").alias("a"), F.col("set").alias("x")), sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
    both = candidates.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(100 * common >= 75 * (F.size("x") + F.size("y") - common)).select("a", "b")


def _sets(documents: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Shingle sets of the wanted ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(utf8(batch["text"]), WORDS)]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # The wanted ids grow with the documents, so they are not broadcast, however few they are.
    rows = rows.join(wanted.hint("merge"), "id", "left_semi")
    return rows.mapInArrow(cut, "id long, set array<long>").where(F.size("set") > 0)


def _links_across(buckets: DataFrame, classes: DataFrame, components: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components so far, found by looking at all close pairs that lie in two of them.

    Each step leaves fewer rows to the next one, and only the last takes sets along, for rows that need them.
    """
    joined = classes.join(components.withColumnRenamed("node", "id"), "id", "left")
    joined = joined.withColumn("component", F.coalesce("component", "id"))
    rows = materialize(_unsettled(in_blocks(buckets.join(joined, "id"))), "unsettled")
    ids = rows.select("id").distinct()
    own = _own_shingles(sets.join(ids, "id", "left_semi"))
    joined = joined.join(ids, "id", "left_semi").join(own, "id", "left")
    # A partner has at least three quarters of the shingles, all of them shared.
    joined = joined.withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0))).where("4 * shared >= 3 * n")
    joined = materialize(joined, "unsettled")
    rows = materialize(_unsettled(in_blocks(rows.join(joined, "id"))), "unsettled")
    with_sets = joined.join(sets, "id").where(F.size("set") == F.col("n"))
    return materialize(_across(in_blocks(rows.join(with_sets, "id"))), "links")


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` (the smallest id reachable) and ``kept``.

    The result is written to the shared folder, and all tables on the way to it are deleted.
    """
    return settle(
        documents.sparkSession, "near-duplicates", lambda: _near_duplicates(documents, id_col=id_col, text_col=text_col)
    )


def _near_duplicates(documents: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    signed = materialize(signatures(documents, id_col=id_col, text_col=text_col), "signatures")
    present = signed.where(F.col("id").isNotNull() & (F.col("n") > 0))
    # Stored, so that joins with it are dealt out by all of their keys, and Spark can split a large class.
    least = materialize(present.groupBy("h1", "h2").agg(F.min("id").alias("rep")), "least")
    # Of a class the document with the smallest id stands for all.
    classes = present.join(least.select("h1", "h2", F.col("rep").alias("id")), ["h1", "h2", "id"], "left_semi")
    classes = materialize(classes.select("id", "n", "sig").dropDuplicates(["id", "sig"]), "classes")
    buckets = materialize(shared_buckets(_keys(classes), ROWS_PER_BLOCK), "buckets")

    proposed = materialize(_nearest(in_blocks(buckets.join(classes, "id"))), "proposed")
    # Whoever has a close partner is in a proposal, so these sets are all that confirming needs.
    wanted = proposed.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = materialize(_sets(documents, wanted, id_col, text_col), "sets")
    links = materialize(_confirmed(proposed, sets), "links")
    components = connected_components(links)

    more = _links_across(buckets, classes, components, sets)
    if not more.isEmpty():
        components = connected_components(links.union(more))
    labels = least.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    labels = materialize(labels.select("h1", "h2", F.coalesce("component", "rep").alias("component")), "labels")
    # An empty set has no class, and a NULL id no component. All empty sets look alike, so they stay out of the join.
    some = signed.where("n > 0").join(labels.hint("merge"), ["h1", "h2"], "left").select("id", "n", "component")
    none = signed.where("n = 0").select("id", "n", F.lit(None).cast("long").alias("component"))
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    out = some.unionByName(none).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))

