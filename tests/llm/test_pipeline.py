import pytest

import corpus_pipeline
from tests.llm import test_minhash, test_secret_scan, test_suffix_dedup
from tests.llm.tables import no_documents, odd_documents
from tidemark.llm import secret_scan
from tidemark.session import materialize


@pytest.fixture(scope="module")
def stages(spark):
    """Input of the first stage, and what each stage gave."""
    directory = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    planted = [(10**6 + i, f"planted{i} words{i} of{i} a text{i} with token = 'abcdefgh{i}' inside{i}", "en", "x", 0) for i in range(5)]
    out = [docs.unionByName(spark.createDataFrame(planted, docs.schema))]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], directory), name))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:5])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_language_stage_keeps_what_has_letters(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after == {k: t for k, t in before.items() if t and any(c.isalpha() for c in t)}


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    expected = test_minhash.brute_force(before.items())
    assert texts(stages[2]) == {k: t for k, t in before.items() if expected[k][2]}
    assert len(before) > len(texts(stages[2]))


def test_passages_are_removed(stages):
    before, after = texts(stages[2]), texts(stages[3])
    for (key, _), (_, _, _, kept) in test_suffix_dedup.brute_force(before.items()).items():
        assert after.pop(key) == kept.decode("utf-8", "ignore")
    assert not after


def test_secrets_are_masked(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    changed = 0
    for key, text in before.items():
        spans = test_secret_scan.expected(text)
        changed += bool(spans)
        assert (text == after[key]) == (not spans)
        assert spans == [] or "[secret]" in after[key]
    assert changed >= 5
    assert all(secret_scan.BASE_RULES[0].kind not in [k for k, _, _ in test_secret_scan.expected(t)] for t in after.values())


def test_every_token_is_packed(stages):
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == set(texts(stages[4]))
    total = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert sum(r["length"] for r in rows) == sum(total.values())


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == stages[5].columns
    pieces = {(r["doc_id"], r["doc_tokens"]) for r in stages[5].collect() if r["doc_id"] < 10**6}
    assert {(r["doc_id"], r["doc_tokens"]) for r in got.collect()} == pieces


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_odd_rows(spark, make):
    docs = make(spark).selectExpr("*", "'s' AS source", "cast(NULL AS BIGINT) AS n_chars")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, "/none"), name)
        if name != "packing":
            assert docs.columns == columns
    if make is no_documents:
        assert docs.collect() == []
    else:
        assert {1, 5, 6, 10} <= {r["doc_id"] for r in docs.collect()}


def test_near_duplicates_are_judged_row_by_row(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(40)) for x in "abc")
    near = a.replace("a39", "other")
    rows = [(None, c), (None, c), (None, c + "more"), (3, a), (3, a), (7, near), (10, a), (10, b), (11, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.selectExpr("*", "'en' AS lang", "'x' AS row", "0L AS n_chars")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "/none")
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    group = [r for r in found if r[1] in (c, c + "more")]
    assert len(group) == 1
    assert sorted((r for r in found if r not in group), key=repr) == sorted([(3, a), (10, b), (11, ""), (None, "")], key=repr)


def test_language_stage_drops_what_fits_no_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    clean = [(10**6, "The thing is that there are others on the other end.", "en", "x", 0), (10**6 + 1, "Ä", "de", "x", 0)]
    junk = [(None, "#$%^&*() 1203 x )(*&^%$ 98@!~ " * 5, None, "x", 0), (10**6 + 2, "\u4e8e" * 60, None, "x", 0)]
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(spark.createDataFrame(clean + junk, docs.schema)), "")
    found = texts(kept)
    assert found.keys() >= {10**6, 10**6 + 1} | {r["doc_id"] for r in docs.where("text rlike '[a-z]'").collect()}
    assert not found.keys() & {None, 10**6 + 2}


def test_language_stage_with_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, "12 3"), (3, None), (None, "ß")], "doc_id long, text string")
    docs = docs.selectExpr("*", "cast(NULL AS STRING) AS lang")
    assert texts(corpus_pipeline.identify_language(spark, docs, "")) == {1: "some words", None: "ß"}
    # All labelled rows are held out.
    held = spark.range(100).where(corpus_pipeline.langid.held_out("id")).selectExpr("id AS doc_id", "'a text' AS text", "'en' AS lang")
    assert corpus_pipeline.identify_language(spark, held, "").count() == held.count() > 0


def test_passages_stage_leaves_replacement_characters(spark):
    passage = "a passage \ufffd that two documents share, " * 5
    rows = {1: "clean \ufffd text", 2: passage + "one\ufffd", 3: "two\ufffd" + passage, 4: "\ufffd"}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").selectExpr("*", "0L AS n_chars")
    kept = corpus_pipeline.drop_repeated_passages(spark, docs, "")
    expected = {k: v[3].decode("utf-8", "ignore") for (k, _), v in test_suffix_dedup.brute_force(rows.items()).items()}
    assert texts(kept) == expected
    assert expected[1] == rows[1] and len(expected[3]) < len(rows[3])
