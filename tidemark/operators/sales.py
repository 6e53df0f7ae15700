"""Sales facts: cleaning, the split into sales and returns, and enrichment with current dimension rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import (
    EVENT_TIME_WATERMARK,
    FACT_COLUMNS,
    LOOKUPS,
    RETURN_MEASURES,
    TRANSACTION_RULES,
    UNKNOWN_MANAGER,
)
from tidemark.operators.quality import Rule, enforce


def with_sale_day(sales: DataFrame) -> DataFrame:
    """Add the event day as ``date``; on a stream also set the watermark for later windows."""
    dated = sales.withColumn("date", F.col("event_time").cast("date"))
    return dated.withWatermark("event_time", EVENT_TIME_WATERMARK) if sales.isStreaming else dated


def with_known_manager(stores: DataFrame) -> DataFrame:
    return stores.withColumn("manager", F.coalesce(F.col("manager"), F.lit(UNKNOWN_MANAGER)))


def sales_transactions(
    cleaned: DataFrame, rules: Sequence[Rule] = TRANSACTION_RULES, observe=None
) -> DataFrame:
    """Valid sales: positive quantity. Zero and NULL quantities are neither sales nor returns."""
    return enforce(cleaned.filter(F.col("quantity") > 0), rules, observe)


def returns_transactions(
    cleaned: DataFrame, rules: Sequence[Rule] = TRANSACTION_RULES, observe=None
) -> DataFrame:
    """Valid returns: negative quantity; measures of the sale are reported as magnitudes under their own names."""
    kept = [c for c in cleaned.columns if c not in RETURN_MEASURES.values()]
    magnitudes = [F.abs(measure).alias(name) for name, measure in RETURN_MEASURES.items()]
    return enforce(cleaned.filter(F.col("quantity") < 0).select(*kept, *magnitudes), rules, observe)


def enrich(
    sales: DataFrame,
    stores: DataFrame | None = None,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Left-join the current dimension rows onto sales, keeping sales without a match.

    Dimensions must have one row per key. Only the looked-up columns are joined, no side is forced to be
    broadcast (the customer dimension grows with the data), and a dimension that is left out costs nothing:
    its columns are missing from the result.
    """
    facts, known = sales, {"stores": stores, "customers": customers, "products": products}
    for name, (key, columns) in LOOKUPS.items():
        if known[name] is not None:
            looked_up = known[name].select(key, *[F.col(old).alias(new) for new, old in columns.items()])
            facts = facts.join(looked_up, key, "left")
    return facts.select(*[c for c in FACT_COLUMNS if c in facts.columns])
