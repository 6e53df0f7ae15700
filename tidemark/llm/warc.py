"""A content-addressed archive of WARC records: every payload once, exact record headers apart, records by joins.

An archive is a folder of two Parquet tables. ``headers`` has a row per record: its number, the digest its payload is
stored under, and, to the byte, all that stands in front of the payload (the WARC header and the HTTP header of the
block). ``payloads`` has the bytes of every distinct payload once, under their SHA-256 digest. A payload comes out only
if its bytes still have the digest and the length they were stored under; otherwise reading fails.

Of the records with equal payloads of at least ``revisit_from`` bytes, that with the smallest id is a ``response`` and
the others are ``revisit`` records that name it; all smaller payloads are responses. A NULL id comes last; of records
that repeat an id, one (the smallest number) comes first, and the others revisit that id. A NULL payload is empty, and a
NULL URL has an empty target. An empty table gives an archive without records.

At scale: payloads are hashed where they are read. To find first copies only digests move, combined on the map side.
The one shuffle of payloads to the store drops copies within each task before it. Records that share a digest, be it a
third of all, are spread by Spark's skew join: no step needs all records of a payload in one task, and both sides of
each join by digest are plain scans, as splitting needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize, new_dir, scratch_tables, write_and_clean

RESPONSE, REVISIT = "response", "revisit"
#: Line ends, the profile of a revisit record, the base 32 alphabet.
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_ID = "urn:record:"


def sha1_base32(payload: Column) -> Column:
    """The SHA-1 digest in base 32, without a prefix. Five hex digits are twenty bits, or four digits of base 32."""
    hex_digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hex_digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*groups), _DIGITS, BASE32)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _escaped(text: Column) -> Column:
    """A line end inside a header field would begin another one; neither belongs in a URL."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(document: Column, number: Column) -> Column:
    named = F.url_encode(F.coalesce(document.cast("string"), F.lit("")))
    return F.concat(F.lit(f"<{_ID}"), named, F.when(document.isNull(), ":none:").otherwise(":"), number.cast("string"), F.lit(">"))


def _header(date: str) -> Column:
    """Everything in front of the payload: the WARC header, an empty line, the HTTP header, an empty line."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        _field("Content-Length", F.col("bytes").cast("string")), F.lit(CRLF),
    )
    revisits = F.col("first.number") != F.col("number")
    refers = F.concat(
        _field("WARC-Refers-To", _record_id(F.col("first.id"), F.col("first.number"))), _field("WARC-Profile", F.lit(PROFILE))
    )
    block = F.length(http) + F.when(revisits, 0).otherwise(F.col("bytes"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.when(revisits, REVISIT).otherwise(RESPONSE)),
        _field("WARC-Record-ID", _record_id(F.col("id"), F.col("number"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _escaped(F.coalesce("url", F.lit("")))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisits, refers).otherwise(""),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", block.cast("string")),
        F.lit(CRLF), http,
    )


def _addressed(payload: Column) -> list[Column]:
    return [F.unhex(F.sha2(payload, 256)).alias("digest"), F.length(payload).cast("long").alias("bytes")]


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_from: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write the archive of ``pages`` to the folder ``path``; ``date`` is put in every record."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    with scratch_tables(pages.sparkSession):
        facts = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
        facts = facts.select(
            "id", "url", *_addressed(F.col("payload")), sha1_base32(F.col("payload")).alias("sha1"),
            F.monotonically_increasing_id().alias("number"),
        )
        # Stored, so that numbers stay the same, and later steps read no payloads.
        facts = materialize(facts, "warc-facts")
        order = F.struct(F.col("id").isNull().alias("last"), "id", "number")
        first = facts.where(F.col("bytes") >= revisit_from).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
        shared = materialize(first.where("n > 1").select("digest", "first"), "warc-first")
        headers = facts.join(shared.hint("merge"), "digest", "left")
        write_and_clean(headers.select("number", "digest", "bytes", _header(date).alias("header")), f"{path}/headers")
    contents = pages.select(payload.alias("payload")).select(*_addressed(F.col("payload")), "payload")
    # The shuffled payloads go before those of the next join come.
    write_and_clean(contents.dropDuplicates(["digest"]), f"{path}/payloads")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/headers")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, payload): the stored bytes, each verified against its address."""
    stored = spark.read.parquet(f"{path}/payloads")
    digest, length = _addressed(F.col("payload"))
    same = (digest == F.col("digest")) & (length == F.col("bytes"))
    damaged = F.concat(F.lit("damaged payload "), F.hex("digest"))
    # A filter survives column pruning; an assertion in a column that nobody reads would be removed.
    return stored.where(F.assert_true(same, damaged).isNull()).select("digest", "payload")


def read_originals(spark: SparkSession, path: str) -> DataFrame:
    """(number, header, payload): every record with its whole payload, also where the archive has it under another."""
    headers, payloads = read_headers(spark, path), read_payloads(spark, path)
    joined = headers.join(payloads.hint("merge"), "digest", "left")
    found = F.assert_true(F.col("payload").isNotNull(), F.concat(F.lit("no payload of record "), F.col("number").cast("string")))
    return joined.where(found.isNull()).select("number", "header", "payload")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(number, record): the bytes of the WARC records without the two line ends behind each; a revisit has no payload."""
    responses = _type() == RESPONSE
    whole = F.concat(F.col("header").cast("binary"), F.when(responses, F.col("payload")).otherwise(F.lit(b"")))
    return read_originals(spark, path).select("number", whole.alias("record"))


def write_files(spark: SparkSession, path: str, target: str, compression: str = "none") -> None:
    """Write the archive's records as WARC files; the end of a record is the line separator of Spark's text files."""
    lines = records(spark, path).select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", CRLF * 2).option("compression", compression).text(target)


def _value(name: str) -> Column:
    """A field of the WARC header, which ends at the first empty line; NULL if it has none."""
    warc = F.substring_index("header", CRLF * 2, 1)
    value = F.regexp_extract(warc, rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(F.contains(warc, F.lit(f"{CRLF}{name}: ")), value)


def _type() -> Column:
    return _value("WARC-Type")


def _named(field: str, kind: str) -> Column:
    """The id that a record id names."""
    pattern = rf"^<{_ID}([^:]*):(none:)?\d+>$"
    value = _value(field)
    return F.when(F.regexp_extract(value, pattern, 2) == "", F.url_decode(F.regexp_extract(value, pattern, 1))).cast(kind)


def digest(spark: SparkSession, path: str, id_col: str = "page_id", kind: str = "long") -> DataFrame:
    """What the archive says of each page: length and digest of its whole payload, its record's type, and what it refers to."""
    original = read_originals(spark, path)
    sha1 = sha1_base32(F.col("payload"))
    # The record's own statement must fit what the join brought.
    stated = F.assert_true(_value("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), sha1), "a record states another digest")
    return original.where(stated.isNull()).select(
        _named("WARC-Record-ID", kind).alias(id_col),
        F.length("payload").cast("long").alias("payload_bytes"),
        sha1.alias("payload_digest"),
        _type().alias("record_type"),
        _named("WARC-Refers-To", kind).alias("refers_to"),
    )


def round_trip(pages: DataFrame, **options: str | int) -> DataFrame:
    """Write the archive of ``pages`` to a new folder in the shared one and tell what it says; see :func:`digest`."""
    path = new_dir(pages.sparkSession, "warc")
    write_archive(pages, path, **options)
    id_col = options.get("id_col", "page_id")
    return digest(pages.sparkSession, path, id_col, pages.schema[id_col].dataType.simpleString())
