from functools import cache

import numpy as np
from pyspark.sql import functions as F

from tests.llm.tables import no_documents, odd_documents
from tidemark.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.where(~langid.held_out()))
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert len(rows) > 200 and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_model(counts, order):
    """A model from a dictionary of counts of four bytes."""
    languages = sorted(counts)
    grams = [np.array([int.from_bytes(k, "big") for k in counts[x]], np.uint32) for x in languages]
    return langid.Model(languages, grams, [np.array(list(counts[x].values()), float) for x in languages])


def reference_bits(counts, text, shortest_kept):
    """Prediction by partial matching, one byte at a time. ``shortest_kept``: contexts of full length in use."""

    @cache
    def probability(context, byte):
        if context is None:
            return 1 / 256
        seen = {}
        for gram, n in counts.items():
            if gram[3 - len(context) : 3] == context:
                seen[gram[3]] = seen.get(gram[3], 0) + n
        shorter = context[1:] if context else None
        if not seen or len(context) == 3 and context not in shortest_kept:
            return probability(shorter, byte)
        rest = sum(probability(shorter, b) for b in range(256) if b not in seen)
        escape = len(seen) if rest > 1e-12 else 0
        total = sum(seen.values()) + escape
        return seen[byte] / total if byte in seen else escape / total * probability(shorter, byte) / rest

    data = bytes(3) + text
    return -sum(np.log2(probability(data[i - 3 : i], data[i])) for i in range(3, len(data)))


def test_code_lengths_equal_a_plain_version():
    def grams(text):
        data, out = bytes(3) + text, {}
        for i in range(len(data) - 3):
            out[data[i : i + 4]] = out.get(data[i : i + 4], 0) + 1
        return out

    counts = {"a": grams(b"abab abba aabb ab" * 2), "b": grams(b"bcbc cbbc ccb" * 2)}
    scorer = langid.Scorer(plain_model(counts, 3))
    totals = {}
    for one in counts.values():
        for gram, n in one.items():
            totals[gram[:3]] = totals.get(gram[:3], 0) + n
    kept = {c for c, n in totals.items() if n >= langid.LEAST_SEEN}
    texts = [b"abc abz", b"zzz", b"b", b"", b"abab abba"]
    got = scorer.code_lengths(texts)
    for text, row in zip(texts, got, strict=True):
        assert np.allclose(row, [reference_bits(counts[x], text, kept) for x in ("a", "b")], rtol=1e-4)


def test_slices_change_nothing(monkeypatch):
    counts = {"a": {b"\0\0\0a": 3, b"\0\0ab": 2, b"\0aba": 2}, "b": {b"\0\0\0c": 3}}
    scorer = langid.Scorer(plain_model(counts, 3))
    texts = [b"abababab" * 5, b"", b"c", b"abc" * 40, b""]
    whole = scorer.code_lengths(texts)
    monkeypatch.setattr(langid, "SLICE", 7)
    assert np.allclose(scorer.code_lengths(texts), whole)


def test_odd_rows(spark):
    df = odd_documents(spark)
    model = langid.train(df)
    got = [tuple(r) for r in langid.predict(df, model).collect()]
    assert len(got) == df.count()
    und = {r[0] for r in got if r[1] == "und"}
    assert und >= {2, 3, 4, 12} and not und & {1, 5, 6, 7, 10} and all(r[2] == 0 for r in got if r[1] == "und")
    assert {r[1] for r in got} == {"en", "fr", "und"}


def test_nothing_to_learn_from(spark):
    model = langid.train(no_documents(spark))
    assert {r["lang_pred"] for r in langid.predict(odd_documents(spark), model).collect()} == {"und"}
    assert langid.predict(no_documents(spark), model).collect() == []


def test_folds(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,)], "doc_id long").select(langid.held_out().alias("x"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("c"))
    assert [(r["x"], r["c"] is not None and r["c"] % 4 == 2) for r in rows.collect()] == [(b, b) for b in [False, *[r["c"] % 4 == 2 for r in rows.collect()[1:]]]]
