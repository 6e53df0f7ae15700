import hashlib

import pytest

from tests.llm.tables import no_documents, odd_documents, random_documents
from tidemark.llm import suffix_dedup


def brute_force(rows):
    """(id, text) in order of ids, rows that repeat both once: bytes, removed, runs, what is kept."""
    seen, out = set(), {}
    for key, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for at in range(len(data) - 99):
            string = hashlib.blake2b(data[at : at + 100], digest_size=16).digest()
            if string in seen:
                covered[at : at + 100] = b"\1" * 100
            seen.add(string)
        runs = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out[key, text] = (len(data), sum(covered), runs, bytes(x for x, c in zip(data, covered, strict=True) if not c))
    return out


def results(df):
    kept = suffix_dedup.remove_repeats(df, carry=["text"])
    return [
        ((r["doc_id"], r["carried"]["text"]), (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])))
        for r in kept.collect()
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = random_documents(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert dict(results(df)) == brute_force(rows)


def test_common_passages_only_choose_other_anchors(spark, monkeypatch):
    rows = random_documents(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = brute_force(rows)
    for share in (0.0, 2.0):
        monkeypatch.setattr(suffix_dedup, "COMMON", share)
        assert dict(results(df)) == expected


def test_odd_rows(spark):
    df = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = results(df)
    assert sorted(map(repr, (k for k, _ in found))) == sorted(map(repr, rows))
    # The two rows with a NULL id are apart by their texts, and short of 100 bytes.
    assert dict(found) == brute_force(rows)


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(no_documents(spark)).collect() == []


def test_whole_characters(spark):
    row = spark.sql("SELECT unhex('a9c3a96f6bc3') AS kept").select(suffix_dedup.as_text(F_col("kept")).alias("t")).first()
    assert row["t"] == "éok"


def test_replacement_characters_of_the_text_stay(spark):
    kept = ["a\ufffdb".encode(), b"\x01a\x01b\x01" + "\ufffd\x01".encode(), b"\xa9\xef\xbf\xbd\xe6\xbc", b"\xf0\x9f\xef\xbf\xbd\xc3\xa9\xbd"]
    rows = spark.createDataFrame([(k,) for k in map(bytearray, kept)], "kept binary")
    got = [r["t"] for r in rows.select(suffix_dedup.as_text(F_col("kept")).alias("t")).collect()]
    assert got == [k.decode("utf-8", "ignore") for k in kept]


def test_texts_whose_hashes_share_half_their_bits(spark):
    from pyspark.sql import functions as F

    passage = "".join(chr(97 + i * i % 23) for i in range(50)) + " a passage that both of them begin with, and nobody else has it " * 2
    texts = spark.range(300000).select(F.concat(F.lit(passage), "id").alias("text"))
    pairs = texts.groupBy(F.shiftright(F.xxhash64("text"), 32)).agg(F.collect_list("text").alias("two")).where("size(two) = 2")
    for two in [r["two"] for r in pairs.limit(2).collect()]:
        df = spark.createDataFrame([(None, t) for t in two] + [(None, two[0])], "doc_id long, text string").repartition(3)
        removed = {}
        for (_, text), (_, n, _, _) in results(df):
            removed.setdefault(text, set()).add(n)
        # One of the two has the passage first; the row that repeats an id and its text is no other document.
        assert sorted(map(sorted, removed.values()))[0] == [0]
        assert min(sorted(map(sorted, removed.values()))[1]) >= len(passage)
    assert pairs.count() > 0


def F_col(name):
    from pyspark.sql import functions as F

    return F.col(name)
