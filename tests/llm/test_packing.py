import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.tables import ODD, no_documents, odd_documents
from tidemark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    encoded = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, 1], "<u4").tobytes() for e in encoded]


def check(pieces, documents, limit=2048):
    """Pieces cover each document once, sequences have no gap and are nearly full."""
    left = sorted(documents)
    by_sequence, by_document = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for sequence in by_sequence.values():
        sequence.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in sequence])
        assert [p["offset"] for p in sequence] == [0, *ends[:-1]] and ends[-1] <= limit
    padded = [sum(p["length"] for p in s) for s in by_sequence.values()]
    padding = sum(limit - n for n in padded if n & (n - 1))
    for p in pieces:
        by_document.setdefault((p["doc_id"], p["doc_tokens"], p["start"]), []).append(p)
    whole = []
    for doc, total in {(p["doc_id"], p["doc_tokens"]) for p in pieces}:
        at, out = 0, b""
        copies = len(by_document[doc, total, 0])
        while at < total:
            same = by_document.get((doc, total, at))
            assert same, (doc, at)
            at += same[0]["length"]
            out += same[0]["ids"]
        whole += [(doc, out)] * copies
    assert sorted(map(repr, whole)) == sorted(map(repr, left))
    assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] for p in pieces)
    return padding, sum(padded)


def test_real_texts(spark, testdata):
    df = spark.read.parquet(f"{testdata}/documents.parquet").repartition(3)
    rows = df.select("doc_id", "text").collect()
    pieces = packing.pack_documents(df, PATH, with_ids=True).collect()
    padding, tokens = check(pieces, list(zip([r[0] for r in rows], ids_of([r[1] for r in rows]), strict=True)), 2048)
    assert padding <= 0.001 * tokens


def test_odd_rows(spark):
    # Rows that repeat an id and a text are cut at different places; give them ids of their own to tell them apart.
    odd = odd_documents(spark).selectExpr("coalesce(doc_id, -1) * 100 + row_number() OVER (ORDER BY doc_id, text) AS doc_id", "text", "id", "n")
    rows = odd.collect()
    pieces = packing.pack_documents(odd, PATH, with_ids=True).collect()
    check(pieces, list(zip([r["doc_id"] for r in rows], ids_of([r["text"] for r in rows]), strict=True)))
    plain = packing.pack_documents(odd_documents(spark), PATH).collect()
    assert {r["doc_id"] for r in plain} == {k for k, _, _ in ODD}
    assert sum(r["length"] for r in plain) == sum(len(i) // 4 for i in ids_of([t for _, t, _ in ODD]))


def test_empty_table(spark):
    assert packing.pack_documents(no_documents(spark), PATH).collect() == []


@pytest.mark.parametrize("cut", [True, False])
def test_all_limits_hold(cut):
    rng = np.random.default_rng(3)
    limits = packing.Limits(tokens=100, segments=4, loss_tokens=40)
    out = []
    packer = packing.Packer(limits, lambda pieces, size: out.append((pieces, size)), cut)
    examples = {}
    for key in range(3000):
        tokens = int(rng.integers(1, 400 if cut else 60))
        loss = int(rng.integers(0, min(tokens, 40) + 1))
        examples[key] = (tokens, loss)
        packer.add(key, 0, tokens, loss)
    packer.close()
    seen = {}
    for pieces, size in out:
        assert size == sum(length for _, _, length in pieces) <= 100 and 0 < len(pieces) <= 4
        loss = 0
        for key, start, length in pieces:
            tokens, tail = examples[key]
            loss += max(0, start + length - max(start, tokens - tail))
            seen.setdefault(key, []).append((start, length))
        assert loss <= 40
    for key, (tokens, _) in examples.items():
        at = 0
        for start, length in sorted(seen[key]):
            assert start == at
            at += length
        assert at == tokens
    if not cut:
        assert all(len(v) == 1 for v in seen.values())


def test_examples(spark):
    rows = [(i, 10 + i % 50, i % 10, "x") for i in range(200)] + [(300, None, 5, "x"), (301, 0, None, "x")]
    df = spark.createDataFrame(rows, "ex long, size int, learned int, id string")
    limits = packing.Limits(tokens=128, segments=5, loss_tokens=20)
    got = packing.pack_examples(df, id_col="ex", tokens_col="size", loss_col="learned", limits=limits).collect()
    assert len(got) == len(rows)
    assert all((r["sequence_id"] is None) == (r["ex"] >= 300) for r in got)
    with pytest.raises(Exception, match="over the limits"):
        packing.pack_examples(
            spark.createDataFrame([(1, 500, 0)], "ex long, size int, learned int"),
            id_col="ex", tokens_col="size", loss_col="learned", limits=limits,
        ).collect()
