"""The registered queries against their SQL, and against the brute-force versions where SQL can't tell."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from tests.llm.test_chat import brute_force as replayed
from tests.llm.test_nearest import exact
from tests.oracle import connect, duck_rows, spark_rows
from tidemark.llm.queries import ORACLES, QUERIES, VOCABULARY


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, testdata, name):
    assert spark_rows(QUERIES[name](spark, testdata)) == duck_rows(connect(testdata), ORACLES[name])


def test_every_query_has_sql_or_a_brute_force_version():
    tested = {name.removeprefix("test_").split("_")[0] for name in globals() if name.startswith("test_op")}
    assert {q.split("_")[0] for q in QUERIES if q not in ORACLES} == tested


def table(spark, testdata, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{testdata}/{name}.parquet").select(*columns).collect()]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encoded(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    found = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in found], [tokenizer.decode(e.ids, skip_special_tokens=False) for e in found]


def test_op2_equals_the_library(spark, testdata):
    docs = table(spark, testdata, "documents", "doc_id", "text")
    ids, decoded = encoded([t for _, t in docs])
    expected = {
        (doc, len(i), sha(np.array(i, "<u4").tobytes()), sha(d.encode()))
        for (doc, _), i, d in zip(docs, ids, decoded, strict=True)
    }
    got = QUERIES["op2_bpe"](spark, testdata).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(docs)


def test_op4_equals_a_plain_replay(spark, testdata):
    text = "</s>[INST] ok [/INST]"
    rows = table(spark, testdata, "conversations", "conv_id", "turn", "role", "text")
    rows += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    columns = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    got = QUERIES["op4_chat_format"](spark, testdata).collect()
    assert {r["conv_id"]: tuple(r[c] for c in columns) for r in got} == replayed(rows)
    assert len(got) == len({r[0] for r in rows}) and all(r["formatted_chars"] > 0 for r in got)


def test_op5_places_every_id_once(spark, testdata):
    docs = table(spark, testdata, "documents", "doc_id", "text")
    ids = {doc: np.array([*i, 1], "<u4") for (doc, _), i in zip(docs, encoded([t for _, t in docs])[0], strict=True)}
    pieces = QUERIES["op5_packing"](spark, testdata).collect()
    by_document, by_sequence = {}, {}
    for p in pieces:
        by_document.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
        assert p["ids_crc32"] == zlib.crc32(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]].tobytes())
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
    assert set(by_document) == set(ids)
    for doc, parts in by_document.items():
        parts.sort(key=lambda p: p["start"])
        assert [p["start"] for p in parts] == [0, *np.cumsum([p["length"] for p in parts])[:-1]]
        assert sum(p["length"] for p in parts) == len(ids[doc])
    padding = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in parts])
        assert [p["offset"] for p in parts] == [0, *ends[:-1]] and ends[-1] <= 2048
        padding += 2048 - ends[-1] if ends[-1] & (ends[-1] - 1) else 0
    assert padding <= 0.001 * sum(map(len, ids.values()))


def test_op9_finds_the_nearest(spark, testdata):
    rows = sorted(table(spark, testdata, "embeddings", "vec_id", "embedding"))
    x, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    got = {}
    for r in QUERIES["op9_nearest_neighbours"](spark, testdata).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == {int(i) for i in ids if i % 50 == 0}
    hits = 0
    for query, found in got.items():
        best, _ = exact(x, ids, int(np.searchsorted(ids, query)))
        assert sorted(found) == [1, 2, 3, 4, 5]
        order = [found[rank] for rank in sorted(found)]
        assert order == sorted(order, key=lambda f: (-f[1], f[0]))
        hits += len(set(best) & {i for i, _ in order})
        a = x[np.searchsorted(ids, query)]
        for i, score in order:
            b = x[np.searchsorted(ids, i)]
            assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
    assert hits >= 0.95 * 5 * len(got)


def test_op10_predicts_held_out_languages(spark):
    testdata = "/root/testdata/sf0.01"
    docs = {d: (lang, text) for d, lang, text in table(spark, testdata, "documents", "doc_id", "lang", "text")}
    got = QUERIES["op10_language_id"](spark, testdata).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    known = {lang for lang, _ in docs.values() if lang}
    right = total = 0
    for r in got:
        lang, text = docs[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        letters = any(c.isalpha() for c in text or "")
        assert r["lang_pred"] in known if letters else r["lang_pred"] == "und"
        if r["held_out"] and lang:
            right, total = right + (r["lang_pred"] == lang), total + 1
    assert total > 200 and right >= 0.99 * total
