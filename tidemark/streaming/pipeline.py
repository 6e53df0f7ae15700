"""The layered pipeline over streams: landing directories to gold tables, a stage at a time.

Every call of ``run_pending`` takes what has arrived since the last one through all layers. Tables that feed
another stream show a micro-batch whole and once, and its rule counts are stored with it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import (
    BRONZE_RULES,
    CLEANED_RULES,
    DIMENSIONS,
    KEYS,
    LINEAGE_COLUMNS,
    SCHEMAS,
    TRANSACTION_RULES,
)
from tidemark.operators.quality import Rule, RuleCounts, enforce
from tidemark.operators.sales import (
    returns_transactions,
    sales_transactions,
    with_known_manager,
    with_sale_day,
)
from tidemark.sources.delimited import HEADER, parse_by_header, stream_csv_lines
from tidemark.sources.files import (
    CORRUPT,
    REJECTED_DDL,
    cast_rules,
    rejects,
    stream_parquet,
    typed_with_rejects,
    with_lineage,
)
from tidemark.streaming import refresh
from tidemark.streaming.facts import enrich_stream
from tidemark.streaming.history import HistoryTable
from tidemark.streaming.queries import append_with_rules, for_each_batch, store_counts, total_metrics

_LINEAGE_DDL = "ingest_timestamp TIMESTAMP, source_file_path STRING"
Build = Callable[[DataFrame, RuleCounts], DataFrame]


class StreamingPipeline:
    """``landing`` maps sales, customers, products and stores to the Parquet directories rows arrive in.

    ``landing_ddl`` overrides the landed schema of a source; its columns are cast to the model's types. ``formats``
    says which sources arrive as CSV with a header, whose columns are found by name.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing: Mapping[str, str],
        landing_ddl: Mapping[str, str] | None = None,
        buckets: int = 256,
        max_files_per_trigger: int | None = None,
        formats: Mapping[str, str] | None = None,
    ):
        self.spark, self.root, self.landing = spark, root, dict(landing)
        self.formats = dict(formats or {})
        self.landing_ddl = {**SCHEMAS, **(landing_ddl or {})}
        self.max_files = max_files_per_trigger
        self.histories = {
            name: HistoryTable(
                spark,
                self.path(f"silver/{name}"),
                # The hash of the whole record orders records of a key with the same update time.
                f"{SCHEMAS[name]}, {_LINEAGE_DDL}, record_hash BIGINT",
                dimension.keys,
                dimension.sequence,
                ["record_hash"],
                dimension.tracked,
                excluded=[*dimension.excluded, "record_hash"],
                ignore_nulls=dimension.ignore_nulls,
                buckets=buckets,
            )
            for name, dimension in DIMENSIONS.items()
        }
        facts = self.path("gold/sales_facts")
        self.gold = {
            "daily_sales_by_store": refresh.daily_store_sales(
                spark, facts, self.path("gold/daily_sales_by_store")
            ),
            "product_performance": refresh.product_performance(
                spark, facts, self.path("gold/product_performance")
            ),
            "customer_lifetime_value": refresh.customer_value(
                spark, facts, self.path("gold/customer_lifetime_value")
            ),
        }

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _checkpoint(self, name: str) -> str:
        return self.path(f"checkpoints/{name}")

    def _stream_of(self, table: str, ddl: str) -> DataFrame:
        return stream_parquet(self.spark, self.path(table), ddl)

    def _bronze_stream(self, source: str) -> DataFrame:
        return self._stream_of(f"bronze/{source}", f"{SCHEMAS[source]}, {_LINEAGE_DDL}")

    def ingest(self, source: str) -> None:
        """Typed rows with lineage and what typing rejected; a row without its key stops the query.

        CSV is read by the names in its headers; malformed lines go to a quarantine table of their own.
        """
        ddl, key = self.landing_ddl[source], KEYS[source]
        casts, rules = cast_rules(SCHEMAS[source]), BRONZE_RULES[source]
        if self.formats.get(source) == "csv":
            landed = stream_csv_lines(self.spark, self.landing[source], max_files_per_trigger=self.max_files)
        else:
            landed = with_lineage(stream_parquet(self.spark, self.landing[source], ddl, self.max_files))

        def build(batch: DataFrame, counts: RuleCounts) -> DataFrame:
            kept = list(LINEAGE_COLUMNS)
            if self.formats.get(source) == "csv":
                batch, kept = parse_by_header(batch, SCHEMAS[source], [key]), [*kept, CORRUPT, HEADER]
            rows = typed_with_rejects(batch, SCHEMAS[source], keep=kept)
            rows = counts.enforce(rows, casts, f"typed_{source}")
            if CORRUPT in kept:
                # Malformed lines have no key to judge.
                rules_here = [Rule(r.name, f"{CORRUPT} IS NOT NULL OR ({r.condition})", r.action) for r in rules]
                return counts.enforce(rows, rules_here, f"bronze_{source}")
            return counts.enforce(rows, rules, f"bronze_{source}")

        aside = (CORRUPT, self.path(f"bronze/{source}_malformed")) if self.formats.get(source) == "csv" else None
        self._append(landed, build, f"bronze/{source}", f"bronze_{source}", aside)

    def _append(self, stream: DataFrame, build: Build, table: str, name: str, aside=None) -> None:
        append_with_rules(
            stream, build, self.path(table), self.path("metrics"), self._checkpoint(name), name, aside
        ).awaitTermination()

    def rejects(self, source: str) -> DataFrame:
        """(key, column, text): the values that typing turned into NULL."""
        ddl = f"{SCHEMAS[source]}, {_LINEAGE_DDL}, {REJECTED_DDL}"
        return rejects(self.spark.read.schema(ddl).parquet(self.path(f"bronze/{source}")), KEYS[source])

    def malformed(self, source: str) -> DataFrame:
        """Lines of CSV that could not be parsed, with the header of their file and their lineage."""
        ddl = f"{CORRUPT} STRING, {HEADER} STRING, {_LINEAGE_DDL}"
        return self.spark.read.schema(ddl).parquet(self.path(f"bronze/{source}_malformed"))

    def maintain_history(self, name: str) -> None:
        rules, dataset = CLEANED_RULES[name], f"{name}_cleaned"

        def store(batch: DataFrame, batch_id: int) -> None:
            counts = RuleCounts()
            changes = with_known_manager(batch) if name == "stores" else batch
            # Ingest time and file are left out: they would tell a replayed record from its first copy.
            content = [c for c in changes.columns if c not in LINEAGE_COLUMNS]
            cleaned = counts.enforce(changes, rules, dataset).withColumn("record_hash", F.xxhash64(*content))
            self.histories[name].apply(cleaned, batch_id)
            store_counts(counts, batch.sparkSession, self.path("metrics"), dataset, batch_id)

        checkpoint = self._checkpoint(f"silver_{name}")
        for_each_batch(self._bronze_stream(name), store, checkpoint).awaitTermination()

    def split_sales(self) -> None:
        """Sales and returns as two queries over the cleaned rows, which are counted by the first."""
        for kind, transactions in (("sales", sales_transactions), ("returns", returns_transactions)):

            def build(batch: DataFrame, counts: RuleCounts, kind=kind, transactions=transactions) -> DataFrame:
                cleaned = with_sale_day(batch)
                if kind == "sales":
                    cleaned = counts.enforce(cleaned, CLEANED_RULES["sales"], "sales_cleaned")
                else:
                    cleaned = enforce(cleaned, CLEANED_RULES["sales"])
                return counts.enforce(transactions(cleaned, ()), TRANSACTION_RULES, f"{kind}_transactions")

            self._append(self._bronze_stream("sales"), build, f"silver/{kind}_transactions", f"silver_{kind}")

    def current(self, name: str) -> DataFrame:
        return self.histories[name].current()

    def enrich_sales(self) -> None:
        sales = self._stream_of("silver/sales_transactions", f"{SCHEMAS['sales']}, date DATE")
        enrich_stream(
            sales,
            lambda: {name: self.current(name) for name in DIMENSIONS},
            self.path("gold/sales_facts"),
            self._checkpoint("gold_sales_facts"),
        ).awaitTermination()

    def run_pending(self) -> None:
        for source in SCHEMAS:
            self.ingest(source)
        for name in DIMENSIONS:
            self.maintain_history(name)
        self.split_sales()
        self.enrich_sales()
        for table in self.gold.values():
            table.refresh()

    def quality_report(self) -> DataFrame:
        """Rows and violations per rule so far."""
        return total_metrics(self.spark, self.path("metrics"))
