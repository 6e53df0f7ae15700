import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import nearest

SCHEMA = "vec_id long, embedding array<double>"


def exact(x, ids, query, k=5):
    size = np.linalg.norm(x, axis=1)
    score = x @ x[query] / (size * size[query])
    order = [i for i in np.lexsort((ids, -score)) if i != query][:k]
    return [int(ids[i]) for i in order], score[order]


def test_recall_on_hard_vectors(spark, testdata):
    """Random vectors have no near neighbours, so recall is as hard as it gets."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    table = df.orderBy("vec_id").toPandas()
    x, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    hits = total = 0
    rows = nearest.search(df, F.col("vec_id") % 20 == 0).collect()
    for query in ids[ids % 20 == 0]:
        mine = sorted((r for r in rows if r["query_id"] == query), key=lambda r: r["rank"])
        best, _ = exact(x, ids, int(np.searchsorted(ids, query)))
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        hits += len({r["vec_id"] for r in mine} & set(best))
        total += 5
        for r in mine:
            a, b = x[np.searchsorted(ids, r["vec_id"])], x[np.searchsorted(ids, query)]
            assert abs(r["score"] - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
    assert hits / total >= 0.9


def test_blocks_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(nearest, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(nearest, "QUERIES_PER_BLOCK", 2)
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rng.standard_normal((60, 8)))]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # copies of a query: ties by id
    got = nearest.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["rank"]) for r in got] == [(100, 1), (101, 2), (102, 3), (103, 4), (104, 5)]


def test_shards_of_a_query_hold_all_near_values():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 16, (200, 4)).astype(np.uint16)
    bits, errors = 6, 2
    rows, asked = nearest._spots(words, bits, 0), nearest._spots(words, bits, errors)
    assert rows.shape == (200, 4)  # one shard in each table, whatever the number of queries
    assert asked.shape == (200, 4 * (1 + 6 + 15))
    for q, shards in zip(words[:20], asked, strict=False):
        near = np.bitwise_count(words ^ q) <= errors
        assert np.isin(rows[near], shards).all()


def test_few_found_means_all_are_compared(spark, monkeypatch):
    monkeypatch.setattr(nearest, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(nearest, "QUERIES_PER_BLOCK", 4)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((150, 12))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], SCHEMA)
    codes = nearest.fit(nearest.vectors_of(df, "vec_id", "embedding"))
    codes.errors[12], codes.radius[12] = 0, 0
    rows = nearest.search(df, F.col("vec_id") % 10 == 0, codes=codes).collect()
    for query in range(0, 150, 10):
        mine = sorted((r for r in rows if r["query_id"] == query), key=lambda r: r["rank"])
        best, score = exact(x, np.arange(150), query)
        assert [r["vec_id"] for r in mine] == best
        assert np.allclose([r["score"] for r in mine], score, atol=1e-12)


def test_near_copies_crowd_a_shard(spark, monkeypatch):
    """A third of the rows share their codes, so their shards are cut into blocks; huge and tiny vectors lose nothing."""
    monkeypatch.setattr(nearest, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(nearest, "QUERIES_PER_BLOCK", 2)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((240, 16))
    x[::3] = x[0] + 1e-6 * rng.standard_normal((80, 16))
    x[10], x[11] = x[10] * 1e200, x[11] * 1e-200
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], SCHEMA)
    rows = nearest.search(df, F.col("vec_id") % 6 == 0).collect()
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    hits = 0
    for query in range(0, 240, 6):
        mine = sorted((r for r in rows if r["query_id"] == query), key=lambda r: r["rank"])
        best, score = exact(unit, np.arange(240), query)
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        hits += sum(r["score"] >= score[-1] - 1e-12 for r in mine)
    assert hits >= 0.9 * 5 * 40


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [1.0, 0.1]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (None, [1.0, 0.0]), (6, [1.0, 0.0, 0.0]), (50, [0.5, 0.5]), (100, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS vector", "3 AS score", "true AS is_query")
    got = nearest.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(0, 1), (0, 50), (50, 1), (50, 0)]


def test_empty_table(spark):
    assert nearest.search(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
