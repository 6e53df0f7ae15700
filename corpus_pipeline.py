"""Documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and gives the same columns, but for the
last, which gives the pieces of packed sequences. Stages work on all rows of their input:

1. language ID drops documents whose language can't be told: NULL, without a letter, or with more bits a byte in their
   best language than a bound set from the training texts; with nothing to learn from, all texts with a letter stay;
2. MinHash near-dedup judges each row by its own text, whatever its id, and keeps one row of every group: that with the
   smallest id, a NULL id coming last, and of rows that repeat it the one whose text has the smallest hash; documents
   without words are no duplicates and stay;
3. suffix-array dedup takes repeated passages out of the texts; every document stays, and a NULL text is empty then;
4. secret scans put a mark in place of each secret; every document stays;
5. packing cuts documents into pieces and places them in sequences.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, minhash, packing, secret_scan, suffix_dedup
from tidemark.llm.queries import VOCABULARY
from tidemark.llm.rows import table
from tidemark.session import materialize, settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, bound = langid.train_with_bound(docs.where(~langid.held_out()))
    if not model.languages:
        return docs.where(langid.has_letter())
    known = langid.predict(docs, model, carry=docs.columns, bound=bound).where(F.col("lang_pred") != langid.UNDETERMINED)
    return known.select("carried.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Ids may be NULL, repeat, or have several texts, so each row gets a number, stored so that it stays the same.
    number = F.monotonically_increasing_id().alias("row")
    rows = docs.select(number, F.xxhash64("text").alias("hash"), F.struct(*docs.columns).alias("carried"))
    rows = materialize(rows, "numbered")
    groups = minhash.near_duplicates(rows, id_col="row", text_col="carried.text").select("row", "component_id")
    ids = rows.select("row", "hash", F.col("carried.doc_id").alias("id"))
    # Rows grow with the documents, so none of this is broadcast.
    order = F.struct(F.col("id").isNull().alias("last"), "id", "hash", "row")
    kept = ids.join(groups.hint("merge"), "row").groupBy("component_id").agg(F.min(order).alias("first")).select("first.row")
    return rows.join(kept.hint("merge"), "row", "left_semi").select("carried.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(docs, carry=_others(docs))
    return _with_text(kept.select("carried.*", suffix_dedup.as_text(F.col("kept")).alias("new_text")), docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan_secrets(docs, carry=_others(docs))
    return _with_text(secret_scan.redact(scanned).select("carried.*", F.col("text").alias("new_text")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, VOCABULARY)


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"]


def _with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents with the new text and its length."""
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return rows.select(*[(new[c] if c in new else F.col(c)).alias(c) for c in docs.columns])


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

# No stage but the scan can be told in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(spark, name, partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
