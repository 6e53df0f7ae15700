"""Reconciliation and referential-integrity reports. Each report is one DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, record_count) for every named frame."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("record_count")).select(
                F.lit(name).alias("table_name"), "record_count"
            )
            for name, df in tables.items()
        ]
    )


def rows_without_match(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts whose key is not in the dimension; a NULL key counts as missing."""
    return facts.join(dimension.select(key), key, "left_anti")


def missing_key_count(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """How many facts :func:`rows_without_match` would return.

    Facts are counted per key before the join: a frequent key, or a mass of NULL keys, is one row there.
    """
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = rows_without_match(per_key, dimension, key)
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"))


# The labels of the health check, and the key that each dimension is looked up by.
HEALTH_COUNTS = {"customers": "customers_count", "products": "items_count", "stores": "stores_count"}
HEALTH_MISSING = {"customers": "missing_customers", "products": "missing_products", "stores": "missing_stores"}
HEALTH_KEYS = {"customers": "customer_id", "products": "product_id", "stores": "store_id"}


def key_matches(facts: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(name, n_rows, n_missing) for every dimension, given as (frame, key), in one pass over the facts.

    Facts are counted per key before the join, so a frequent key, or a mass of NULL keys, is one row there. A
    NULL key counts as missing.
    """

    def named(name: str, key: str) -> list:
        return [F.lit(name).alias("name"), F.col(key).cast("string").alias("key")]

    keys = F.array(*[F.struct(*named(name, key)) for name, (_, key) in dimensions.items()])
    per_key = facts.select(F.explode(keys).alias("k")).groupBy("k.name", "k.key").agg(F.count(F.lit(1)).alias("n"))
    known = _union([df.select(*named(name, key)) for name, (df, key) in dimensions.items()])
    found = per_key.join(known.distinct().withColumn("found", F.lit(True)), ["name", "key"], "left")
    missing = F.coalesce(F.sum(F.when(F.col("found").isNull(), F.col("n"))), F.lit(0))
    return found.groupBy("name").agg(F.sum("n").alias("n_rows"), missing.alias("n_missing"))


def health_check(
    sales: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """Four table counts and three counts of sales with a dangling key, as distinct labelled rows."""
    dimensions = {"customers": customers, "products": products, "stores": stores}
    counts = row_counts({HEALTH_COUNTS[name]: df for name, df in dimensions.items()})
    matches = key_matches(sales, {name: (df, HEALTH_KEYS[name]) for name, df in dimensions.items()})
    # Every fact is counted once for each dimension; a table without facts has no row there at all.
    lines = [F.struct(F.lit("sales_count").alias("table_name"), F.max("n_rows").alias("record_count"))]
    lines += [
        F.struct(
            F.lit(label).alias("table_name"),
            F.sum(F.when(F.col("name") == name, F.col("n_missing"))).alias("record_count"),
        )
        for name, label in HEALTH_MISSING.items()
    ]
    of_sales = matches.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))
    of_sales = of_sales.select("table_name", F.coalesce("record_count", F.lit(0)).alias("record_count"))
    return _union([counts, of_sales]).distinct()


@dataclass(frozen=True)
class Check:
    """``actual`` names a metric; ``expected`` is a number or names another metric."""

    label: str
    actual: str
    expected: int | str
    comparison: str = "="


def count_rows() -> Column:
    return F.count(F.lit(1))


def measure(df: DataFrame, **metrics: Column) -> DataFrame:
    """(metric, value) for all named aggregates of a frame, which is read once for all of them."""
    named = df.agg(*[value.cast("bigint").alias(name) for name, value in metrics.items()])
    lines = [F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in metrics]
    return named.select(F.inline(F.array(*lines)))


def reconcile(measures: Sequence[DataFrame], expectations: Sequence[Check]) -> DataFrame:
    """(label, actual, comparison, expected, passed) for every check, exact or lower bound.

    ``measures`` come from :func:`measure`, one for each frame. A metric that is NULL fails its checks; a name that
    nothing measures, or that two frames do, is an error.
    """
    # A handful of rows: one for each metric. A name that occurs twice is refused by the map.
    entries = F.collect_list(F.struct("metric", "value"))
    known = _union(measures).agg(F.map_from_entries(entries).alias("known"))

    def value(metric: int | str) -> Column:
        if isinstance(metric, int):
            return F.lit(metric).cast("bigint")
        missing = F.raise_error(F.lit(f"no metric {metric}")).cast("bigint")
        return F.when(F.map_contains_key("known", F.lit(metric)), F.col("known")[metric]).otherwise(missing)

    def line(check: Check) -> Column:
        actual, expected = value(check.actual), value(check.expected)
        passed = actual >= expected if check.comparison == ">=" else actual == expected
        columns = {
            "label": F.lit(check.label),
            "actual": actual,
            "comparison": F.lit(check.comparison),
            "expected": expected,
            "passed": F.coalesce(passed, F.lit(False)),
        }
        return F.struct(*[column.alias(name) for name, column in columns.items()])

    return known.select(F.inline(F.array(*[line(check) for check in expectations])))


def key_inventory(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct known keys per table, for generators and loaders that resume: (table_name, key)."""
    return _union(
        [
            df.select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key")).distinct()
            for name, (df, key) in tables.items()
        ]
    )


def high_water_mark(df: DataFrame, key: str) -> DataFrame:
    """The greatest id so far, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("high_water_mark"))
