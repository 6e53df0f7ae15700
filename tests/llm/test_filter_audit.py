import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from tests.llm.tables import CLASHING, LONG, ODD, PASSAGE
from tidemark.llm.filter_audit import FILTERS, audit_filters, audit_of, intervals, rank_of

ORDERS = ["".join(p) for p in permutations(FILTERS)]
LABELS = "doc_id long, quality int, toxic int"


def masks(rows):
    least = {}
    for doc, _, text in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    for doc, part, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = (
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            re.search("[#$%&*|]", text) is not None,
            doc is not None and least[text] < doc,
        )
        yield doc, part or "", {f for f, failed in zip(FILTERS, fails, strict=True) if failed}


def brute_force(rows, labels):
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    found, share = {}, Counter()
    judged = list(masks(rows))
    for part in {p for _, p, _ in judged}:
        docs = [(d, mask) for d, p, mask in judged if p == part]
        for order in ORDERS:
            left = docs
            for step, f in enumerate(order, 1):
                gone = [(d, m) for d, m in left if f in m]
                left = [(d, m) for d, m in left if f not in m]
                share[part, f] += len(gone)
                found[part, order, step] = [
                    len(left), len(gone), sum(f in m for _, m in docs) - len(gone), sum(m == {f} for _, m in docs),
                    sum(d in good for d, _ in gone if d is not None), sum(d in toxic for d, _ in gone if d is not None),
                ]
    return sorted((p, o, s, *v, share[p, o[s - 1]]) for (p, o, s), v in found.items())


def run(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs = docs.selectExpr("*", *[f"'x' AS `{c}`" for c in (*CLASHING, "mask", "part", "good", "bits", "words", "digest", "first")])
    got = audit_filters(docs.repartition(3), spark.createDataFrame(labels, LABELS).selectExpr("*", "1 AS id", "2 AS good"))
    return sorted(map(tuple, got.collect()))


def test_ranks_are_lexicographic():
    assert [rank_of(order) for order in ORDERS] == list(range(120))
    assert rank_of("B") == 24 and rank_of("EA") == 96


def test_intervals_cover_each_order_once():
    for mask in ("A", "CE", "BCD", "ABCDE"):
        removed = {}
        for step, start, end in intervals(mask):
            for rank in range(start, end):
                assert rank not in removed
                removed[rank] = step
        assert removed == {r: min(order.index(f) for f in mask) + 1 for r, order in enumerate(ORDERS)}
    assert intervals("") == []


def test_small_case_by_hand():
    counts = {frozenset("A"): np.array([3, 1, 0]), frozenset("AB"): np.array([2, 0, 2]), frozenset(): np.array([5, 5, 0])}
    got = audit_of(counts, "AB")
    assert got["removed"].tolist() == [[5, 0], [2, 3]] and got["kept"].tolist() == [[5, 5], [8, 5]]
    assert got["redundant"].tolist() == [[0, 2], [0, 2]] and got["unique_fails"].tolist() == [[3, 0], [0, 3]]
    assert got["shapley"].tolist() == [[8, 2], [2, 8]] and got["toxic_lost"].tolist() == [[2, 0], [2, 0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["word", "Word", "A", "x#", "é", "漢字", "50%", "plain", "UPPER"]

    def text():
        kind = rng.random()
        if kind < 0.35:
            return "one text that a third of all documents share"
        base = [f"w{i}" for i in range(rng.randint(100, 300))] if kind < 0.7 else []
        return rng.choice([" ", "\n", "\t \x0b"]).join(base + [rng.choice(words) for _ in range(rng.randint(0, 150))])

    rows = [(i, rng.choice(["a", "b", None, ""]), text()) for i in range(400)]
    rows += rng.sample(rows, 20)
    labels = [(rng.randint(0, 500), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)]
    assert run(spark, rows, labels) == brute_force(rows, labels)


def test_odd_rows(spark):
    rows = [(i, lang, text) for i, text, lang in ODD] + [(100, None, PASSAGE), (101, "", LONG), (102, "fr", LONG + "#")]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (9, None, None), (12345, 1, 1)]
    assert run(spark, rows, labels) == brute_force(rows, labels)


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    rows = [(1, "s", "a"), (2, "s", "a")]
    assert run(spark, rows, []) == brute_force(rows, [])
