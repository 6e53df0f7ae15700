"""Small tables with everything that is odd, and brute-force versions."""

from __future__ import annotations

import random
import re

LONG = "Lorem ipsum dolor sit amet " * 8000
PASSAGE = "the quick brown fox jumps over the lazy dog while nobody in the whole wide world is looking at it, again and again. "
ODD = [
    (1, "A few words only", "en"),
    (1, "A few words only", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "   \t\n ", "en"),
    (5, "x", None),
    (6, LONG, "en"),
    (7, PASSAGE * 3, "en"),
    (8, "intro " + PASSAGE + "outro", "en"),
    (9, "A few words only", "en"),
    (10, "é" * 150 + "ß漢字😀 <|endoftext|> ok", "fr"),
    (11, "é" * 150 + "ß漢字😀 <|endoftext|> ok", "fr"),
    (None, "A few words only", "en"),
    (None, None, None),
    (12, "12345 .,;: 678", "en"),
    (13, "aaaa" * 100, "en"),
]
#: Columns of the caller whose names the operators use inside.
CLASHING = ("id", "doc", "h", "n", "key", "low", "at", "gram", "spans", "carried", "sig", "rep", "component", "ids", "start")


def odd_documents(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    return rows.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHING]).repartition(3)


def no_documents(spark):
    return odd_documents(spark).where("false")


def random_documents(seed: int, n: int = 200) -> list[tuple[int, str]]:
    """Documents that share stretches of all lengths."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(5)] + ["a" * 500, "ab" * 300, "é" * 150]

    def part():
        if rng.random() < 0.3:
            return "".join(rng.choice("xyz") for _ in range(rng.randint(0, 60)))
        text = rng.choice(base)
        at = rng.randint(0, len(text) - 1)
        return text[at : at + rng.randint(0, 200)]

    return [(i, "".join(part() for _ in range(rng.randint(0, 6)))) for i in range(n)]


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def smallest_reachable(nodes, linked) -> dict:
    """Brute force: the smallest node that links lead to, for every node; ``linked(a, b)`` tells of a link."""
    nodes = sorted(nodes)
    component = {a: a for a in nodes}
    links = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if linked(a, b)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(component[a], component[b])
            if component[a] != low or component[b] != low:
                component[a] = component[b] = low
                changed = True
    return component
