"""How filters interact: for every order of five filters, what each step removes, alone and with the others.

A document's mask tells which filters it fails. In a given order, the first filter of the order that is in the mask
removes it. Orders that agree up to that step are neighbours in lexicographic order, as their Lehmer ranks share the
leading digits, so a mask's step covers intervals of ranks. For each part (a value of ``part_col``) the counts of a mask
are added at the first rank of its intervals and taken away behind the last; running sums over the 120 ranks then give
all orders at once. The work for a part depends on its masks, at most 32, and not on its documents.

Filters: A fewer than 200 words; B fewer than half of the words distinct; C more than 2 % of the code points are A-Z; D
holds one of ``#$%&*|``; E the text equals that of a document with a smaller id, anywhere in the table. Words are maximal
runs without white space, in either case.

A NULL text is empty, a NULL part the empty string. A NULL id is smaller than none and has none that is smaller; rows
that repeat an id are documents of their own, none a copy of the other by E. Several labels of an id count as
one, which is good or toxic if any is; labels of no document and NULL labels count for nothing. An empty table gives an
empty result.

At scale: texts are read once and never moved, only their digests are. First ids of digests and counts of masks combine
on the map side; texts that many documents share, be it a third of them, are spread by Spark's skew join, whose sides
are plain scans. What reaches a task of a part is at most 32 rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import ship
from tidemark.session import materialize

FILTERS = "ABCDE"
# The white space, the bounds and the characters of the filters.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COUNTED = ("n", "good", "toxic")
RESULT_DDL = (
    "part STRING, filter_order STRING, step INT, kept BIGINT, removed BIGINT, redundant BIGINT, unique_fails BIGINT,"
    " good_lost BIGINT, toxic_lost BIGINT, shapley BIGINT"
)


def rank_of(order: str, filters: str = FILTERS) -> int:
    """The lexicographic rank of an order of ``filters``: its Lehmer digits, weighted by factorials.

    A leading part of an order has the rank of the first order that begins with it.
    """
    left, rank = list(filters), 0
    for letter in order:
        digit = left.index(letter)
        rank += digit * factorial(len(left) - 1)
        left.pop(digit)
    return rank


def intervals(mask: Iterable[str], filters: str = FILTERS) -> list[tuple[int, int, int]]:
    """(step, first rank, rank behind the last) of all runs of orders in which ``mask`` is removed at that step."""
    fails, found = set(mask), []
    passed = [f for f in filters if f not in fails]
    for step in range(1, len(passed) + 2) if fails else ():
        width = factorial(len(filters) - step)
        for before in permutations(passed, step - 1):
            for letter in sorted(fails):
                start = rank_of("".join((*before, letter)), filters)
                found.append((step, start, start + width))
    return found


def audit_of(counts: dict[frozenset[str], np.ndarray], filters: str = FILTERS) -> dict[str, np.ndarray]:
    """The columns of the result for one part, as arrays of orders by steps, from counts of each mask.

    A count holds all documents of the mask, the good ones and the toxic ones.
    """
    n, orders = len(filters), [*map("".join, permutations(filters))]
    change = np.zeros((len(_COUNTED), n, len(orders) + 1), np.int64)
    for mask, count in counts.items():
        for step, start, end in intervals(mask, filters):
            change[:, step - 1, start] += count
            change[:, step - 1, end] -= count
    lost = np.cumsum(change, axis=2)[:, :, :-1].transpose(0, 2, 1)
    letter = np.array([[filters.index(f) for f in order] for order in orders])
    total = sum((int(c[0]) for c in counts.values()), 0)
    fails = np.array([sum(int(c[0]) for m, c in counts.items() if f in m) for f in filters])
    alone = np.array([int(counts.get(frozenset(f), [0])[0]) for f in filters])
    removed = lost[0]
    share = np.zeros(n, np.int64)
    np.add.at(share, letter.ravel(), removed.ravel())
    return {
        "kept": total - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": fails[letter] - removed,
        "unique_fails": alone[letter],
        "good_lost": lost[1],
        "toxic_lost": lost[2],
        "shapley": share[letter],
    }


def _text_fails(text: Column) -> list[Column]:
    """Filters A to D by the words and characters of a text."""
    words = F.col("words")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return [
        n_words < LEAST_WORDS,
        100 * n_distinct < LEAST_DISTINCT * n_words,
        100 * capitals > MOST_CAPITALS * F.length(text),
        F.rlike(text, F.lit(SYMBOLS)),
    ]


def judged(
    documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """(part, mask, good, toxic) per document; bit i of the mask is set if it fails filter i."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_col).alias("id"), part.alias("part"), text.alias("text"))
    split = F.filter(F.split("text", WHITE_SPACE), lambda word: word != "")
    rows = rows.select("id", "part", "text", split.alias("words"))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(_text_fails(F.col("text")))]
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    facts = rows.select("id", "part", digest.alias("digest"), sum(bits, F.lit(0)).alias("bits"))
    facts = materialize(facts, "audit-facts")

    first = facts.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    shared = materialize(first.where("n > 1").select("digest", "first"), "audit-first")
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = materialize(known, "audit-labels")
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    # Neither side is broadcast, as both grow with the documents.
    facts = facts.join(shared.hint("merge"), "digest", "left").join(known.hint("merge"), "id", "left")
    return facts.select(
        "part", (F.col("bits") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def audit_filters(
    documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """One row per part, order of filters and step, with the counts of :func:`audit_of`."""
    ship(documents.sparkSession)
    rows = judged(documents, labels, id_col=id_col, text_col=text_col, part_col=part_col)
    counts = rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )

    def audit(part: pa.Table) -> pa.Table:
        by_mask = {}
        for mask, *count in zip(*(part[c].to_pylist() for c in ("mask", *_COUNTED)), strict=True):
            by_mask[frozenset(f for i, f in enumerate(FILTERS) if mask >> i & 1)] = np.array(count, np.int64)
        columns = audit_of(by_mask)
        orders, n = [*map("".join, permutations(FILTERS))], len(FILTERS)
        return pa.table({
            "part": pa.array([part["part"][0].as_py()] * len(orders) * n, pa.string()),
            "filter_order": pa.array([order for order in orders for _ in range(n)], pa.string()),
            "step": pa.array([*range(1, n + 1)] * len(orders), pa.int32()),
            **{name: pa.array(values.ravel(), pa.int64()) for name, values in columns.items()},
        })

    return counts.groupBy("part").applyInArrow(audit, RESULT_DDL)
