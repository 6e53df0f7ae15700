"""Formats conversations into training windows of a token budget, with DataFrame operations only.

A conversation is read in slices of consecutive turn numbers, so that a long one is spread over tasks. Within a
slice, prefix sums of turn tokens choose the spans: turns of up to half of the room fall into the half-room in which
they begin, so a span fits into the room; a longer turn is a span of its own. Every window opens with the system turn of its
conversation (its first turn, if that has the role ``system``), then repeats a few of the turns before the span, as
far as the history budget goes, then has the span. Only assistant turns of the span itself are under the loss mask,
so each is learned once. A window is over budget only if a single turn, or the system turn, is too long for it.

The template writes ``<|turn|>role<|text|>text<|end|>``. In roles and texts ``&`` becomes ``&amp;`` and ``<`` becomes
``&lt;``, so no text can hold a control string, and :func:`read_back` gets the turns back exactly.

Turns are ordered by turn number (NULL first), then role and text; turns with equal numbers and repeated rows are all
kept. NULL role or text is empty. Rows with a NULL conversation id are one conversation. An empty table gives no window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Turn numbers of a slice.
SLICE = 256
_KEY = ["conv", "slice"]


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def estimate_tokens(text: Column) -> Column:
    """Four characters to a token, and four tokens for the marks of a turn."""
    return F.ceil(F.length(text) / 4).cast("long") + 4


def format_chat(
    conversations: DataFrame,
    *,
    budget: int = 1024,
    history_budget: int = 192,
    history_turns: int = 2,
    tokens: Callable[[Column], Column] = estimate_tokens,
) -> DataFrame:
    """One row per window: ``conv_id``, ``first_turn`` (the number of turns before its span), ``formatted``,
    ``n_repeated`` (turns at its front that are repeated), ``loss_spans`` (start and length in code points of what is
    learned) and ``n_tokens``. Windows of a conversation are ordered by ``first_turn``."""
    rows = conversations.select(
        "conv_id",
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"),
        F.coalesce(F.floor(F.col("turn") / SLICE).cast("long"), F.lit(-(1 << 62))).alias("slice"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    in_slice = W.partitionBy(*_KEY).orderBy("turn", "role", "text")
    before = in_slice.rowsBetween(-history_turns, -1)
    turn = F.struct(
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == "assistant").alias("learned"),
        tokens(F.col("text")).alias("tokens"),
    )
    rows = rows.withColumn("item", turn).withColumn("rn", F.row_number().over(in_slice))
    rows = rows.withColumn("back", F.row_number().over(W.partitionBy(*_KEY).orderBy(F.desc("rn"))))

    # A short row per slice: what it knows of its conversation, and the history for the slice after it.
    numbered = F.struct("rn", "item")
    slices = rows.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("turns"),
        F.max(F.when(F.col("rn") == 1, F.struct("role", "item"))).alias("first"),
        F.array_sort(F.collect_list(F.when(F.col("back") <= history_turns, numbered))).alias("tail"),
    )
    along = W.partitionBy("conv").orderBy("slice")
    opening = F.first("first").over(along)
    slices = slices.select(
        *_KEY,
        F.coalesce(F.sum("turns").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("turns_before"),
        F.when(opening["role"] == "system", opening["item"]).alias("system"),
        F.lag("tail").over(along).alias("tail_before"),
        F.lag("turns").over(along).isNull().alias("is_first"),
    )
    rows = rows.join(slices, _KEY)

    # Half of the room that system turn and history leave in a window, and a quarter of the budget at least.
    room = F.lit(budget - history_budget) - F.coalesce(F.col("system.tokens"), F.lit(0))
    half = F.greatest(room, F.lit(budget // 4)) / 2
    size = F.col("item.tokens")
    rows = rows.withColumns({"half": half, "long": size > half})
    so_far = in_slice.rowsBetween(W.unboundedPreceding, -1)
    short_before = F.coalesce(F.sum(F.when(~F.col("long"), size)).over(so_far), F.lit(0))
    spans = rows.withColumns(
        {
            "cell": F.floor(short_before / F.col("half")),
            "longs": F.sum(F.col("long").cast("int")).over(in_slice.rowsBetween(W.unboundedPreceding, 0)),
            "in_slice_before": F.collect_list(numbered).over(before),
        }
    )
    # The first turn of a span knows the turns before it, of the slice and of the slice before.
    history = F.concat(
        F.coalesce(F.col("tail_before"), F.expr("filter(in_slice_before, x -> false)")), F.col("in_slice_before")
    )
    opens = F.struct(
        F.col("rn"), (F.col("turns_before") + F.col("rn") - 1).alias("first_turn"), F.col("is_first"), F.col("system"),
        history.alias("history"),
    )
    windows = spans.groupBy(*_KEY, "longs", "cell", "long").agg(
        F.first("conv_id").alias("conv_id"),
        F.min_by(opens, "rn").alias("opens"),
        F.array_sort(F.collect_list(numbered)).alias("span"),
    )
    windows = windows.select(
        "conv_id",
        F.col("opens.first_turn").alias("first_turn"),
        F.transform("span", lambda x: x["item"]).alias("span"),
        F.when(F.col("opens.first_turn") > 0, F.col("opens.system")).alias("system"),
        _recent(history_turns, history_budget).alias("history"),
    )
    repeated = F.concat(F.filter(F.array("system"), lambda x: x.isNotNull()), F.col("history"))
    masked = F.transform(repeated, lambda x: x.withField("learned", F.lit(False)))
    windows = windows.select(
        "conv_id", "first_turn", F.size(repeated).alias("n_repeated"), F.concat(masked, F.col("span")).alias("turns")
    )
    text = F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(END)))
    lengths = F.transform("turns", lambda x: F.length(x["head"]) + F.length(x["body"]) + len(END))
    starts = F.transform(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: F.struct(
            F.get("turns", i)["learned"].alias("learned"),
            (
                F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0), lambda a, b: a + b)
                + F.length(F.get("turns", i)["head"])
            ).alias("start"),
            F.length(F.get("turns", i)["body"]).alias("length"),
        ),
    )
    return windows.select(
        "conv_id",
        "first_turn",
        F.array_join(text, "").alias("formatted"),
        "n_repeated",
        F.transform(
            F.filter(starts, lambda s: s["learned"]),
            lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")),
        ).alias("loss_spans"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("n_tokens"),
    )


def _recent(turns: int, budget: int) -> Column:
    """The last turns before a window, as many as the history budget holds, without the system turn."""
    known = F.col("opens.history")
    # Slices of a conversation come in order, and so do turns in a slice: the last ones are the latest.
    start = F.greatest(F.size(known) - turns, F.lit(0))
    latest = F.transform(F.slice(known, start + 1, F.lit(turns)), lambda x: x["item"])
    # All turns so far are in ``known`` only where the window is among the first; then the system turn may be one.
    has_system = F.col("opens.system").isNotNull() & (F.col("opens.first_turn") <= turns)
    latest = F.when(
        has_system & (F.size(latest) == F.col("opens.first_turn")), F.slice(latest, F.lit(2), F.lit(turns))
    ).otherwise(latest)
    return F.filter(
        latest,
        lambda _, i: F.aggregate(
            F.slice(latest, i + 1, F.lit(turns)), F.lit(0).cast("long"), lambda a, x: a + x["tokens"]
        )
        <= budget,
    )


def read_back(windows: DataFrame) -> DataFrame:
    """The turns and what is learned, read from the formatted windows: ``conv_id``, ``first_turn``, ``turns`` (role
    and text, without the repeated ones) and ``learned`` (texts under the loss mask)."""
    pieces = F.split(F.col("formatted"), r"<\|turn\|>")
    kept = F.slice(pieces, F.col("n_repeated") + 2, F.size(pieces))

    def turn(piece: Column) -> Column:
        parts = F.split(piece, r"<\|text\|>|<\|end\|>")
        return F.struct(unescape(F.get(parts, F.lit(0))).alias("role"), unescape(F.get(parts, F.lit(1))).alias("text"))

    return windows.select(
        "conv_id",
        "first_turn",
        F.transform(kept, turn).alias("turns"),
        F.transform(
            "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
        ).alias("learned"),
        F.length("formatted").alias("chars"),
    )


def digest(windows: DataFrame) -> DataFrame:
    """One row per conversation: digests of its turns and of what is learned, from the formatted windows."""
    back = read_back(windows).select(
        "conv_id",
        "first_turn",
        "chars",
        F.size("turns").alias("n"),
        F.array_join(
            F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
        ).alias("turns"),
        F.array_join("learned", "").alias("learned"),
    )
    whole = back.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"),
        F.sum("chars").cast("long").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("first_turn", "turns", "learned"))).alias("all"),
    )
    learned = F.array_join(F.transform("all", lambda x: x["learned"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("all", lambda x: x["turns"]), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
