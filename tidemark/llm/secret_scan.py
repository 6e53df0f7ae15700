"""Finds secrets in whole texts with one automaton for all rules, one pass over the bytes of a text.

Spans are offsets of code points, end exclusive. Matches are leftmost and non-overlapping for each kind; kinds may
overlap each other. NULL text is empty and has no spans. Rows are judged one by one, so repeated rows get the same
spans, an empty table gives an empty result, and memory is bounded by one batch of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.automaton import Automaton, Rule
from tidemark.llm.rows import carried, schema_with, ship, utf8

# The base rules, in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         ignore_case=True, min_tail=8),
    Rule("access", r"AKIA[A-Z0-9]+", min_length=16),
    # Runs of eight and more are told apart by states, so that the many short runs of words cost nothing.
    Rule("hex", r"[0-9a-f]{8,}", min_length=32),
)
# Public formats of tokens and keys.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", min_length=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", min_length=15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", min_length=39),
    Rule("private_key", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "struct<kind:string,start:int,end:int>"


def find_spans(automaton: Automaton, data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by the order of the rules."""
    found = automaton.scan(data)
    if not found:
        return []
    at = dict.fromkeys(sorted({p for start, _, end in found for p in (start, end)}))
    done = chars = 0
    for p in at:
        chars += len(data[done:p].decode("utf-8", "replace"))
        done = p
        at[p] = chars
    return [(automaton.rules[rule].kind, at[start], at[end]) for start, rule, end in found]


def scan_secrets(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: its id, the text, and ``spans``, an array of (kind, start, end). Columns in ``carry``
    come along as the struct ``carried``."""
    automaton = Automaton(rules)  # a few hundred rows of 256 entries, by the rules alone

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(automaton, data)]
                for data in utf8(batch["text"])
            ]
            more = ["carried"] if carry else []
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["text"], pa.array(spans, kind), *(batch[c] for c in more)],
                names=["id", "text", "spans", *more],
            )

    ship(documents.sparkSession)
    rows = documents.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *carried(carry)
    )
    found = rows.mapInArrow(scan, schema_with(rows, f"text string, spans array<{SPAN}>"))
    return found.withColumnsRenamed({"id": id_col, "text": text_col})


def redact(scanned: DataFrame, *, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The texts of :func:`scan_secrets` with every stretch that spans cover replaced by ``mask``."""
    spans, text = F.col("spans"), F.col(text_col)
    # Overlapping spans become one stretch: (end of the last stretch, output so far) folded over spans by start.
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, span):
        fresh = span["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"]).alias("out"),
        )

    def finish(state):
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    clean = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
    return scanned.withColumn(text_col, clean)


def digest(scanned: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Counts and joined spans: the base kinds one by one and hashed, then all spans as text."""
    base = [r.kind for r in BASE_RULES]

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def of(*kinds):
        return F.filter(F.col("spans"), lambda s: s["kind"].isin(*kinds))

    return scanned.select(
        id_col,
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(of(*base)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
