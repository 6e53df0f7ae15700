import random

import pytest

from tests.llm.tables import ODD, PASSAGE, no_documents, odd_documents, shingles, smallest_reachable
from tidemark.llm import minhash


def brute_force(rows):
    sets = {k: shingles(t) for k, t in rows}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)

    component = smallest_reachable(sets, linked)
    return {k: (len(s), component[k], component[k] == k) for k, s in sets.items()}


def found(df):
    return {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(df).collect()}


def near_copies(seed):
    """Chains of edited copies, shuffled ids, and a passage that most share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(25):
        text = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        texts.append(list(text))
        for _ in range(rng.randint(0, 5)):
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
            texts.append(list(text))
    texts = [" ".join(t).upper() if rng.random() < 0.3 else "\n".join(t) for t in texts]
    texts = [f"{PASSAGE}{t}" if rng.random() < 0.5 else t for t in texts]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [1024, 5])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "ROWS_PER_BLOCK", block)
    rows = near_copies(block)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df) == brute_force(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):
        text = list(base)
        for at in rng.sample(range(100), rng.randint(0, 2)):
            text[at] = f"x{rng.random()}"
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df) == brute_force(rows)


def test_every_close_pair_of_signatures_shares_a_key():
    rng = random.Random(3)
    for _ in range(2000):
        differ = set(rng.sample(range(minhash.PLACES), minhash.RADIUS))
        assert any(not differ & set(kept) for kept in minhash.KEPT)


def test_odd_rows(spark):
    got = [tuple(r) for r in minhash.near_duplicates(odd_documents(spark)).collect()]
    with_id = {k: t for k, t, _ in ODD if k is not None}
    expected = brute_force(with_id.items())
    rows = [(k, *expected[k]) if k is not None else (None, len(shingles(t)), None, True) for k, t, _ in ODD]
    assert sorted(map(repr, got)) == sorted(map(repr, rows))


def test_empty_table(spark):
    assert minhash.near_duplicates(no_documents(spark)).collect() == []


def test_chance_of_a_missed_link_is_the_documented_one():
    from math import comb

    missed = sum(comb(minhash.PLACES, k) * 0.25**k * 0.75 ** (minhash.PLACES - k) for k in range(minhash.RADIUS + 1, minhash.PLACES + 1))
    assert f"{missed:.1e}" == "1.6e-04"
    assert "1.6e-4" in minhash.__doc__
