"""Named data-quality rules that warn about, drop, or fail on rows, with a violation count per rule."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

METRICS_DDL = "dataset STRING, rule STRING, action STRING, n_rows BIGINT, n_violations BIGINT"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str

    def holds(self) -> Column:
        """TRUE only where the condition is TRUE: a NULL condition is a violation."""
        return F.coalesce(F.expr(self.condition), F.lit(False))


def warn(name: str, condition: str) -> Rule:
    return Rule(name, condition, "warn")


def drop(name: str, condition: str) -> Rule:
    return Rule(name, condition, "drop")


def fail(name: str, condition: str) -> Rule:
    return Rule(name, condition, "fail")


def _counters(rules: Iterable[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows")] + [
        F.count_if(~rule.holds()).alias(rule.name) for rule in rules
    ]


def enforce(df: DataFrame, rules: Sequence[Rule], observe: str | Observation | None = None) -> DataFrame:
    """Apply ``rules`` to the rows of ``df`` as they stand, batch or streaming.

    With ``observe`` the violations are counted on the way through: pass an ``Observation`` for a batch
    frame, a metric name for a stream. All rules see the rows before any of them is dropped.
    """
    if observe is not None:
        df = df.observe(observe, *_counters(rules))
    for rule in rules:
        if rule.action == "fail":
            # Only a filter survives column pruning; an assertion in an unread column would be removed.
            message = f"rule {rule.name} violated: {rule.condition}"
            df = df.filter(F.assert_true(rule.holds(), message).isNull())
    kept = [rule.holds() for rule in rules if rule.action == "drop"]
    for condition in kept:
        df = df.filter(condition)
    return df


def _observed_rows(dataset: str, rules: Sequence[Rule], seen: Mapping[str, int]) -> list[tuple[str, str, str, int, int]]:
    return [(dataset, r.name, r.action, seen["n_rows"], seen[r.name]) for r in rules]


def metrics_frame(spark: SparkSession, dataset: str, rules: Sequence[Rule], seen: Mapping[str, int]) -> DataFrame:
    """What an ``Observation`` given to :func:`enforce` has counted, in the shape of :func:`rule_metrics`."""
    return spark.createDataFrame(_observed_rows(dataset, rules, seen), METRICS_DDL)


class RuleCounts:
    """Violations in several datasets, counted by the writes that their rows go through, so without another scan."""

    def __init__(self) -> None:
        self._observed: dict[str, tuple[DataFrame, Sequence[Rule], Observation]] = {}

    def enforce(self, df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
        """:func:`enforce`, counting under the name of the dataset. The rows must be written once, before they are
        used otherwise: the first job that runs over them is the one that counts."""
        if not rules:
            return df
        counters = Observation()
        self._observed[dataset] = df, rules, counters
        return enforce(df, rules, counters)

    def rows(self) -> list[tuple[str, str, str, int, int]]:
        """The counts so far, after the writes; a handful of numbers per dataset."""
        found = []
        for dataset, (df, rules, counters) in self._observed.items():
            try:
                seen = counters.get
            except Py4JJavaError:
                # Without rows Spark may drop a plan along with its counters; then there is nothing to scan either.
                found += [tuple(row) for row in rule_metrics(df, dataset, rules).collect()]
                continue
            found += _observed_rows(dataset, rules, seen)
        return found

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), METRICS_DDL)


def rule_metrics(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its violation count."""
    return rule_metrics_of(df, {dataset: ("TRUE", rules)})


def rule_metrics_of(df: DataFrame, datasets: Mapping[str, tuple[str, Sequence[Rule]]]) -> DataFrame:
    """:func:`rule_metrics` for several datasets that are conditions on one frame, in a single pass."""
    counters, lines = [], []
    for i, (dataset, (condition, rules)) in enumerate(datasets.items()):
        within = F.coalesce(F.expr(condition), F.lit(False))
        counters.append(F.count_if(within).alias(f"rows{i}"))
        for j, rule in enumerate(rules):
            counters.append(F.count_if(within & ~rule.holds()).alias(f"violations{i}_{j}"))
            lines.append(
                F.struct(
                    F.lit(dataset).alias("dataset"),
                    F.lit(rule.name).alias("rule"),
                    F.lit(rule.action).alias("action"),
                    F.col(f"rows{i}").alias("n_rows"),
                    F.col(f"violations{i}_{j}").alias("n_violations"),
                )
            )
    return df.agg(*counters).select(F.inline(F.array(*lines)))

