import numpy as np
import pytest

from tests.llm.tables import smallest_reachable
from tidemark.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows, threshold=0.95):
    def cosine(a, b):
        return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))

    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    vectors = {k: np.array(v) for k, v in rows if usable(v)}
    linked = lambda a, b: len(vectors[a]) == len(vectors[b]) and cosine(vectors[a], vectors[b]) >= threshold
    component = smallest_reachable(vectors, linked)
    links = {a: sum(a != b and linked(a, b) for b in vectors) for a in vectors}
    return {k: (links.get(k, 0), component.get(k, k)) for k, _ in rows}


def found(df, **more):
    rows = embedding_dedup.near_duplicates(df, **more).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows if r["vec_id"] is not None)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(8)
    rows = []
    for center in rng.standard_normal((12, 16)):
        rows += [center + rng.standard_normal(16) * s for s in rng.uniform(0, 0.35, 12)]
    rows += [rows[0], rows[0] * 3, -rows[0]]
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(rows)]


def test_equals_brute_force(spark, clustered):
    df = spark.createDataFrame(clustered, SCHEMA)
    assert found(df, miss=1e-6) == brute_force([r[:2] for r in clustered])


def test_blocks_of_any_size_give_the_same(spark, clustered, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "ROWS_PER_BLOCK", 7)
    df = spark.createDataFrame(clustered, SCHEMA)
    assert found(df, miss=1e-6) == brute_force([r[:2] for r in clustered])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 2.0, 0.0]), (11, [1.0, -2.0]), (12, [1.0, 2.0, 0.001])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    # Extra columns with internal names; a repeated row and a NULL id change nothing for the others.
    more = spark.createDataFrame([(1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)], SCHEMA)
    df = df.union(more).selectExpr("*", "1 AS id", "2 AS vector", "3 AS n", "4 AS key", "5 AS ok", "6 AS codes")
    expected = brute_force(rows) | {None: (0, None)}
    assert found(df) == expected
    assert embedding_dedup.near_duplicates(df).count() == len(rows) + 2


def test_empty_table(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
