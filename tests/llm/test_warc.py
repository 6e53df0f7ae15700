import base64
import glob
import gzip
import hashlib
import random
import re
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.llm.tables import CLASHING
from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string"
LONG = "<p>très long</p>\r\n\r\n" * 20_000
ODD = [
    (5, "http://a/", "same"),
    (3, "http://b/", "same"),
    (3, "http://b/", "same"),
    (9, None, None),
    (7, "http://c/\r\nWARC-Type: revisit\r\n\r\nx", ""),
    (None, "http://d/", "same"),
    (None, None, None),
    (1, "http://e/", LONG),
    (2, "http://e/", LONG),
    (-4, "http://f/", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"),
    (11, "http://g/", "é漢😀 \x00 ퟿"),
    (12, "", "alone"),
]


def brute_force(rows, revisit_from=0):
    order = lambda i: (i is None, i or 0)
    first, seen, out = {}, set(), []
    for i, _, html in rows:
        first[html or ""] = min(first.get(html or "", i), i, key=order)
    for i, _, html in rows:
        html = html or ""
        data, known = html.encode(), first[html]
        here = len(data) < revisit_from or (i == known and html not in seen)
        if i == known:
            seen.add(html)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, *(("response", None) if here else ("revisit", known))))
    return sorted(out, key=repr)


def pages(spark, rows):
    clashing = [f"'x' AS `{c}`" for c in (*CLASHING, "number", "digest", "bytes", "payload", "first", "header", "sha1")]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", *clashing).repartition(3)


def told(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("revisit_from", [0, 1, 5, 10**9])
def test_odd_rows(spark, revisit_from):
    assert told(warc.round_trip(pages(spark, ODD), revisit_from=revisit_from)) == brute_force(ODD, revisit_from)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    contents = [None, "", *("x" * rng.randint(1, 300) for _ in range(30))]
    # A third of the rows share one payload.
    rows = [(i, f"http://h/{i}", "hot" if rng.random() < 0.35 else rng.choice(contents)) for i in rng.sample(range(10_000), 500)]
    assert told(warc.round_trip(pages(spark, rows))) == brute_force(rows)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages(spark, []), path)
    assert warc.digest(spark, path).collect() == [] and warc.read_payloads(spark, path).collect() == []


def test_text_ids(spark):
    rows = [("b:>\r\n%", "u", "same"), ("a ü", "v", "same"), ("", "w", "same")]
    df = spark.createDataFrame(rows, "name string, link string, body string")
    got = warc.round_trip(df, id_col="name", url_col="link", payload_col="body")
    assert {r["name"]: (r["record_type"], r["refers_to"]) for r in got.collect()} == {
        "": ("response", None), "a ü": ("revisit", ""), "b:>\r\n%": ("revisit", ""),
    }


def read_file(data):
    """A plain reader of WARC files, by the lengths that the records state."""
    at, found = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        fields = dict(re.findall(rb"\r\n([\w-]+): ([^\r]*)", data[at:end]))
        length = int(fields[b"Content-Length"])
        block = data[end : end + length]
        assert data[end + length : end + length + 4] == b"\r\n\r\n"
        http, payload = block.split(b"\r\n\r\n", 1)
        found.append((fields, int(re.search(rb"Content-Length: (\d+)", http)[1]), payload))
        at = end + length + 4
    return found


@pytest.mark.parametrize("compression, opener", [("none", open), ("gzip", gzip.open)])
def test_files_are_warc(spark, tmp_path, compression, opener):
    path, target = str(tmp_path / "archive"), str(tmp_path / "files")
    warc.write_archive(pages(spark, ODD), path)
    warc.write_files(spark, path, target, compression)
    found = []
    for file in glob.glob(f"{target}/part-*"):
        with opener(file, "rb") as data:
            found += read_file(data.read())
    assert len(found) == len(ODD) == len({f[b"WARC-Record-ID"] for f, _, _ in found})
    by_id = {f[b"WARC-Record-ID"]: payload for f, _, payload in found}
    expected = {(html or "").encode() for _, _, html in ODD}
    assert {p for f, _, p in found if f[b"WARC-Type"] == b"response"} == expected
    for fields, length, payload in found:
        if fields[b"WARC-Type"] == b"revisit":
            assert payload == b"" and fields[b"WARC-Refers-To"] in by_id
            payload = by_id[fields[b"WARC-Refers-To"]]
        assert len(payload) == length
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(payload).digest())


def test_payloads_are_stored_once_and_originals_come_back(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages(spark, ODD), path)
    stored = [bytes(r["payload"]) for r in warc.read_payloads(spark, path).collect()]
    assert sorted(stored) == sorted({(html or "").encode() for _, _, html in ODD})
    originals = sorted(bytes(r["payload"]) for r in warc.read_originals(spark, path).collect())
    assert originals == sorted((html or "").encode() for _, _, html in ODD)


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages(spark, ODD), path)
    stored = spark.read.parquet(f"{path}/payloads")
    changed = stored.withColumn("payload", F.when(F.length("payload") > 1000, F.lit(b"other")).otherwise(F.col("payload")))
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-changed/headers")
    changed.write.parquet(f"{path}-changed/payloads")
    with pytest.raises(PySparkException, match="damaged payload"):
        warc.digest(spark, f"{path}-changed").collect()
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-lost/headers")
    stored.where(F.length("payload") < 1000).write.parquet(f"{path}-lost/payloads")
    with pytest.raises(PySparkException, match="no payload of record"):
        warc.digest(spark, f"{path}-lost").collect()


def test_shuffled_payloads_go_with_their_write(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {n for f in disk.getAllFiles().mkString(",").split(",") if (n := f.split("/")[-1]).startswith("shuffle_")}
    before = shuffled()
    warc.write_archive(pages(spark, ODD), f"{tmp_path}/archive")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
