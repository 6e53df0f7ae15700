import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.tables import no_documents, odd_documents
from tidemark.llm import fill_middle
from tidemark.llm.fill_middle import Marks, boundaries, digest, fill_in_middle, fit, with_restored


def brute_force(doc, text, rate=100, suffix_first=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    named = "null" if doc is None else str(doc)
    digits = hashlib.sha256(f"{seed}:{named}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < suffix_first:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(seed=3, n=150):
    rng = random.Random(seed)
    parts = ["a", "é", "漢", "😀", "\n", "\n\n", "\r\n", " ", "<", "<S", "P>", "word " * 40, "x" * 3000, "\n" * 50]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*made, None, "", "\n", "a<P>b\nc", "<S>", "no\nmark <M", "\n" * 30_000, "é\n" * 20_000 + "end", "long line " * 50_000]


@pytest.mark.parametrize("rate, suffix_first, seed", [(100, 50, 7), (60, 0, 7), (0, 50, 7), (100, 100, 12)])
def test_equals_brute_force(spark, rate, suffix_first, seed):
    rows = list(enumerate(texts()))
    got = fill_in_middle(
        spark.createDataFrame(rows, "doc_id long, text string"), rate=rate, suffix_first=suffix_first, seed=seed
    )
    got = with_restored(got).collect()
    assert {r["doc_id"]: tuple(r)[1:-1] for r in got} == {i: brute_force(i, t, rate, suffix_first, seed) for i, t in rows}
    assert {r["doc_id"]: r["restored"] for r in got} == {i: t or "" for i, t in rows}


@pytest.mark.parametrize("error", [1, 64, fill_middle.LARGEST_ERROR])
def test_index_predicts_within_its_error_and_corrects_exactly(error):
    rng = random.Random(5)
    for kind in range(40):
        lengths = [rng.choice([1, 1, 80, rng.randint(1, 10 ** rng.randint(1, 6))]) for _ in range(rng.randint(0, 400))]
        lengths = [80] * 300 if kind == 0 else lengths
        offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))).astype(np.int64)
        first, at, slope, residual = fit(offsets, error)
        assert len(first) == len(at) == len(slope) and len(residual) == len(offsets)
        for k, offset in enumerate(offsets):
            s = max(i for i, f in enumerate(first) if f <= k)
            predicted = at[s] + int(np.floor(slope[s] * (k - first[s])))
            assert predicted + int(residual[k]) == int(offset) and abs(int(residual[k])) <= error + 1
    assert len(fit(np.arange(100_000) * 7, error)[0]) == 1


def test_boundaries_are_code_points():
    assert boundaries("é\n漢😀\n\nend".encode()).tolist() == [0, 2, 5, 6, 9]
    assert boundaries(b"").tolist() == [0]


def test_odd_rows_and_clashing_columns(spark):
    docs = odd_documents(spark)
    got = fill_in_middle(docs, carry=["text", "id", "n"]).collect()
    assert len(got) == docs.count()
    for r in got:
        assert tuple(r[c] for c in ("n", "form", "prefix_chars", "middle_chars", "output")) == brute_force(r["doc_id"], r["carried"]["text"])
        assert r["carried"]["id"] == r["carried"]["n"] == "x"
    assert digest(fill_in_middle(docs)).count() == len(got)


def test_other_ids_and_marks(spark):
    df = spark.createDataFrame([("a", "one\ntwo\nthree\n"), ("b", "<P>x\ny")], "name string, body string")
    marks = Marks("[p", "[s", "[m")
    got = with_restored(fill_in_middle(df, id_col="name", text_col="body", marks=marks), marks).collect()
    assert {r["name"]: r["restored"] for r in got} == {"a": "one\ntwo\nthree\n", "b": "<P>x\ny"}
    assert all(r["form"] != "plain" for r in got)
    for bad in (("", "b", "c"), ("a", "a", "c"), ("<P<S", "<S", "<M"), ("ab", "ba", "c")):
        with pytest.raises(ValueError):
            Marks(*bad)
    with pytest.raises(ValueError):
        fill_in_middle(df, id_col="name", text_col="body", error=1 << 15)


def test_no_documents(spark):
    assert fill_in_middle(no_documents(spark)).collect() == []


def test_nothing_is_shuffled(spark):
    plan = digest(fill_in_middle(odd_documents(spark).coalesce(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange hash" not in plan
