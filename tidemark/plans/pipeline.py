"""The layered pipeline as batch jobs over named tables: bronze, silver history and sales, gold.

Every step reads the tables that the step before has written, so no join or cast runs twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import (
    ADULT_CUSTOMERS,
    BATCH_RULES,
    BRONZE_RULES,
    CLEANED_RULES,
    DIMENSIONS,
    KEYS,
    LINEAGE_COLUMNS,
    SCHEMAS,
    TRANSACTION_RULES,
    Dimension,
)
from tidemark.operators.history import history_of_every_change, history_of_tracked_columns
from tidemark.operators.quality import Rule, RuleCounts, enforce
from tidemark.operators.sales import (
    enrich,
    returns_transactions,
    sales_transactions,
    with_known_manager,
    with_sale_day,
)
from tidemark.plans import gold
from tidemark.sources.files import REJECTED, cast_rules, typed_with_rejects, with_lineage
from tidemark.sources.tables import create_layers, create_view, overwrite_table

SOURCES = ("sales", "customers", "products", "stores")


class Pipeline:
    """Builds all layers from the four raw frames. ``prefix`` is put in front of the layer names.

    ``tiebreak`` names, per dimension, the column that orders change records with equal update times; the
    default is a hash of the whole record.
    """

    def __init__(self, spark: SparkSession, prefix: str = "", tiebreak: Mapping[str, str] | None = None):
        self.spark, self.prefix, self.tiebreak = spark, prefix, dict(tiebreak or {})

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def bronze(self, raw: Mapping[str, DataFrame]) -> None:
        """Typed raw tables with lineage, and views of the values that typing rejects; a record without its key stops
        the load."""
        create_layers(self.spark, self.prefix)
        counts = RuleCounts()
        for source in SOURCES:
            landed = _with_lineage_if_read(raw[source])
            rows = typed_with_rejects(landed, SCHEMAS[source], keep=LINEAGE_COLUMNS)
            rows = counts.enforce(rows, cast_rules(SCHEMAS[source]), f"typed_{source}")
            rows = counts.enforce(rows, BRONZE_RULES[source], f"bronze_{source}")
            name, key = self.name("bronze", f"raw_{source}"), KEYS[source]
            overwrite_table(rows, name, f"Raw {source} records")
            create_view(
                self.spark,
                self.name("bronze", f"rejected_{source}"),
                f"SELECT {key}, inline({REJECTED}) FROM {name} WHERE {REJECTED} IS NOT NULL",
                f"Values of {source} that do not fit their type",
            )
        self._store_counts("bronze", counts)

    def _store_counts(self, layer: str, counts: RuleCounts) -> None:
        overwrite_table(counts.frame(self.spark).coalesce(1), self.name(layer, "rule_metrics"), f"Rules of the {layer} layer")

    def _records(self, source: str) -> DataFrame:
        return self.table("bronze", f"raw_{source}").drop(REJECTED, *LINEAGE_COLUMNS)

    def _shaped(self, source: str) -> DataFrame:
        rows = self._records(source)
        if source == "stores":
            return with_known_manager(rows)
        return with_sale_day(rows) if source == "sales" else rows

    def _ordered(self, dimension: Dimension, changes: DataFrame) -> tuple[DataFrame, str]:
        if dimension.name in self.tiebreak:
            return changes, self.tiebreak[dimension.name]
        return changes.withColumn("__tie", F.xxhash64(*changes.columns)), "__tie"

    def silver(self) -> None:
        """History where only tracked columns open a version, and sales and returns under their rules."""
        counts = RuleCounts()
        for dimension in DIMENSIONS.values():
            dataset = f"{dimension.name}_cleaned"
            # Stored once, as history goes over its records more than once.
            cleaned = counts.enforce(self._shaped(dimension.name), CLEANED_RULES[dimension.name], dataset)
            cleaned = overwrite_table(cleaned, self.name("silver", dataset), f"Valid records of {dimension.name}")
            changes, tie = self._ordered(dimension, cleaned)
            versions = history_of_tracked_columns(
                changes,
                dimension.keys,
                dimension.sequence,
                dimension.tracked,
                [tie],
                excluded=[c for c in (*dimension.excluded, "__tie") if c in changes.columns],
                ignore_nulls=dimension.ignore_nulls,
            )
            self._store_history(dimension, versions, "__END_AT IS NULL")
        rules, sales = CLEANED_RULES["sales"], self._shaped("sales")
        # Both tables are made of the cleaned rows, which are counted by the first write.
        for kind, transactions, cleaned, comment in (
            ("sales", sales_transactions, counts.enforce(sales, rules, "sales_cleaned"), "Sales, positive quantity"),
            ("returns", returns_transactions, enforce(sales, rules), "Returned sales"),
        ):
            name = f"{kind}_transactions"
            rows = counts.enforce(transactions(cleaned, ()), TRANSACTION_RULES, name)
            overwrite_table(rows, self.name("silver", name), comment)
        self._store_counts("silver", counts)

    def silver_every_change(self, customer_rules: Sequence[Rule] = ADULT_CUSTOMERS) -> None:
        """The simpler history, one version per change record, and sales under the batch rules."""
        for dimension in DIMENSIONS.values():
            rules = customer_rules if dimension.name == "customers" else BATCH_RULES["stores"]
            if dimension.name == "products":
                rules = BATCH_RULES["products"][:1]
            changes = enforce(self._records(dimension.name), rules)
            changes, tie = self._ordered(dimension, changes)
            versions = history_of_every_change(changes, dimension.keys, dimension.sequence, [tie])
            self._store_history(dimension, versions.drop("__tie"), "__is_current")
        sales = enforce(self._records("sales"), BATCH_RULES["sales"])
        overwrite_table(sales, self.name("silver", "sales_transactions"), "Sales, positive quantity")

    def _store_history(self, dimension: Dimension, versions: DataFrame, open_row: str) -> None:
        # The filter for current rows does not pass below a window, so history is written first.
        name = self.name("silver", dimension.name)
        overwrite_table(versions, name, f"Version history of {dimension.name}")
        create_view(
            self.spark,
            f"{name}_current",
            f"SELECT * FROM {name} WHERE {open_row}",
            f"Current {dimension.name}",
        )

    def gold(self) -> None:
        facts = enrich(
            self.table("silver", "sales_transactions"),
            stores=self.table("silver", "stores_current"),
            customers=self.table("silver", "customers_current"),
            products=self.table("silver", "products_current"),
        )
        facts = overwrite_table(facts, self.name("gold", "sales_facts"), "Sales with names and categories")
        for table, build, comment in (
            ("daily_sales_by_store", gold.daily_store_sales, "Daily store sales"),
            ("product_performance", gold.product_performance, "Product sales"),
            ("customer_lifetime_value", gold.customer_value, "Customer value"),
        ):
            overwrite_table(build(facts), self.name("gold", table), comment)

    def quality_report(self) -> DataFrame:
        """Rows and violations per rule, as counted by the writes of bronze and silver; casts are rules of ``typed_*``."""
        return self.table("bronze", "rule_metrics").unionByName(self.table("silver", "rule_metrics"))

    def run(self, raw: Mapping[str, DataFrame]) -> None:
        self.bronze(raw)
        self.silver()
        self.gold()


def _with_lineage_if_read(df: DataFrame) -> DataFrame:
    """Lineage columns; a frame that was not read from files has no file."""
    if set(LINEAGE_COLUMNS) <= set(df.columns):
        return df
    try:
        return with_lineage(df)
    except AnalysisException:
        return df.withColumns({"ingest_timestamp": F.current_timestamp(), "source_file_path": F.lit(None).cast("string")})
