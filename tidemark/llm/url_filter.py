"""URL allow and block lists: a trie over reversed host labels and path segments, longest match first.

A rule is a host and a path. It fits its host and all subdomains, where the path of the URL starts with the path of
the rule. Of the rules that fit, the one with the most host labels wins, and among those the one with the longest
path; of an allow and a block entry that are equal, the block entry wins. A URL that no rule fits gets the default.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; the path is
what follows up to ``?``, ``#`` or the end. A NULL URL, or one without ``://``, has an empty host and path, which
no rule fits. Repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import ship

ALLOW, BLOCK = "allow", "block"
#: Bytes of rules (texts and their tree) that one broadcast holds. A longer list is split, and every part is broadcast
#: in a pass of its own, so that no list is too long.
BROADCAST_BYTES = 32 << 20
_TREE_COST = 400


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = ""

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        """``example.org/en/`` as host ``example.org`` and path ``/en/``."""
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"unknown verdict {verdict!r}")
        host, slash, path = text.partition("/")
        return cls(verdict, host.lower(), slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


class Trie:
    """Host labels from the right, then whole path segments, then what remains as a list of prefixes.

    Each host node has a path trie. A node of it holds the prefixes that end inside one of its segments, longest
    first, so that ``/en/1`` fits ``/en/17/a``.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.root: dict = {}
        for rule in sorted(rules, key=lambda r: r.verdict == BLOCK):  # block entries replace equal allow entries
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, rest = rule.path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            node.setdefault(None, {})[rest] = (rule.text, rule.verdict, rule.host.count(".") + 1, len(rule.path))
        self._freeze(self.root, host=True)

    def _freeze(self, node: dict, host: bool) -> None:
        for key, child in node.items():
            if key is not None:
                self._freeze(child, host)
            elif host:
                self._freeze(child, False)
            else:
                node[None] = sorted(child.items(), key=lambda item: -len(item[0]))

    def match(self, host: str, path: str) -> tuple[str, str, int, int] | None:
        """Text, verdict, labels and path length of the rule that wins."""
        paths, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                paths.append(node[None])
        segments = path.split("/")
        for start in reversed(paths):  # most labels first
            best, node = None, start
            for segment in segments:
                best = next((found for rest, found in node.get(None, ()) if segment.startswith(rest)), best)
                node = node.get(segment)
                if node is None:
                    break
            if best:
                return best
        return None


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return _lower(host), path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def _parts(rules: Sequence[Rule]) -> Iterator[list[Rule]]:
    part, size = [], 0
    for rule in rules:
        cost = len(rule.text) * 4 + _TREE_COST * (rule.text.count("/") + rule.text.count(".") + 2)
        if part and size + cost > BROADCAST_BYTES:
            yield part
            part, size = [], 0
        part.append(rule)
        size += cost
    yield part


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW
) -> DataFrame:
    """One row per page: its id, ``host``, ``path``, the text of the winning ``rule`` (or NULL) and the ``verdict``."""
    spark = pages.sparkSession
    ship(pages.sparkSession)
    out = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    out = out.selectExpr(
        "id", "url", "'' AS host", "'' AS path", "cast(NULL AS STRING) AS rule", f"'{default}' AS verdict",
        "0 AS labels", "-1 AS length",
    )
    schema = out.schema
    for part in _parts(list(rules)):
        trie = spark.sparkContext.broadcast(pickle.dumps(Trie(part)))

        def judge(batches: Iterator[pa.RecordBatch], trie=trie) -> Iterator[pa.RecordBatch]:
            tree: Trie = pickle.loads(trie.value)
            names = ["host", "path", "rule", "verdict", "labels", "length"]
            for batch in batches:
                rows = []
                before = zip(*(batch[c].to_pylist() for c in names[2:]), strict=True)
                for url, best in zip(batch["url"].to_pylist(), before, strict=True):
                    host, path = host_and_path(url)
                    found = tree.match(host, path) if host else None
                    if found and (found[2:], found[1] == BLOCK) > (best[2:], best[1] == BLOCK):
                        best = found
                    rows.append((host, path, *best))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                arrays = [pa.array(c, batch.schema.field(n).type) for n, c in zip(names, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([batch["id"], batch["url"], *arrays], schema=batch.schema)

        out = out.mapInArrow(judge, schema)
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict")
