"""Every operator as a query over the tables of one directory: name -> (spark, directory) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.money import rounded_sum
from tidemark.model import (
    BATCH_RULES,
    BRONZE_RULES,
    CLEANED_RULES,
    KEYS,
    SALES_DDL,
    SALES_FILE_DDL,
    SCHEMAS,
    TRANSACTION_RULES,
)
from tidemark.operators import checks, history
from tidemark.operators.quality import drop, enforce, rule_metrics, rule_metrics_of
from tidemark.operators.sales import (
    enrich,
    returns_transactions,
    sales_transactions,
    with_known_manager,
    with_sale_day,
)
from tidemark.plans import gold, sql_models
from tidemark.plans.pipeline import Pipeline
from tidemark.plans.star import Star
from tidemark.session import new_dir, settle
from tidemark.sources import files
from tidemark.sources.delimited import malformed_csv, read_csv
from tidemark.sources.files import CORRUPT, stream_parquet, typed, with_lineage
from tidemark.sources.tables import LAYERS, create_layers, create_table, overwrite_table, write_batch
from tidemark.streaming import refresh
from tidemark.streaming.facts import (
    count_arrivals,
    daily_store_sales_stream,
    daily_totals,
    enrich_stream,
    late_rows,
    repair_facts,
    split_stream,
)
from tidemark.streaming.history import HistoryTable
from tidemark.streaming.ingest import ingest_csv, ingest_with_rules, ingested, quarantined
from tidemark.streaming.latest import LatestTable
from tidemark.streaming.pipeline import StreamingPipeline
from tidemark.streaming.queries import append_stream, total_metrics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def report(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register a query under its function name; timestamps come out as plain wall-clock values."""

    @wraps(build)
    def run(spark: SparkSession, directory: str) -> DataFrame:
        result = build(Star(spark, directory))
        return result.select(
            *[
                F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f"`{f.name}`")
                for f in result.schema
            ]
        )

    QUERIES[build.__name__] = run
    return build


# --- typed rows and rules ----------------------------------------------------------------------------


@report
def typed_sales(star: Star) -> DataFrame:
    return typed(star.sales(), SALES_DDL)


@report
def typed_wide_ids(star: Star) -> DataFrame:
    """Ids past 2^31 stay what they are."""
    sales = star.sales()
    wide = {c: F.col(c) + 3_000_000_000 for c in sales.columns if c.endswith("_id")}
    return typed(sales.withColumns(wide), SALES_DDL)


def _with_words(sales: DataFrame) -> DataFrame:
    """Sales with a word for some quantities."""
    several = F.when(F.col("discount_applied") < 0, F.lit("several"))
    return sales.withColumn("quantity", F.coalesce(several, F.col("quantity").cast("string")))


@report
def cast_failures(star: Star) -> DataFrame:
    return files.cast_failures(_with_words(star.sales()), SALES_DDL)


@report
def sum_fine_amounts(star: Star) -> DataFrame:
    """Totals of amounts with many digits."""
    return star.sales(with_order=False).groupBy("store_id").agg(rounded_sum("unit_price").alias("total"))


@report
def lineage(star: Star) -> DataFrame:
    """How many rows came from each file, and how many of them have an ingest time."""
    rows = with_lineage(star.table("lineitem").select("l_orderkey", "_metadata"))
    file = F.regexp_extract("source_file_path", r"(\w+\.parquet)", 1)
    return rows.groupBy(file.alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("ingest_timestamp").alias("n_timed")
    )


@report
def fail_rule_on_clean_rows(star: Star) -> DataFrame:
    """A fail rule that holds lets every row through."""
    kept = enforce(star.sales(), BRONZE_RULES["sales"])
    return kept.groupBy("payment_method").agg(F.count(F.lit(1)).alias("n"))


@report
def customers_cleaned(star: Star) -> DataFrame:
    return enforce(star.customers(), CLEANED_RULES["customers"])


@report
def products_cleaned(star: Star) -> DataFrame:
    return enforce(star.products(), CLEANED_RULES["products"])


@report
def stores_default_manager(star: Star) -> DataFrame:
    return enforce(with_known_manager(star.stores()), CLEANED_RULES["stores"])


def _sales(star: Star) -> DataFrame:
    return sales_transactions(enforce(star.sales(), CLEANED_RULES["sales"]))


@report
def sales_valid(star: Star) -> DataFrame:
    return _sales(star)


@report
def returns_valid(star: Star) -> DataFrame:
    return returns_transactions(with_sale_day(star.sales()))


@report
def sales_valid_batch_rules(star: Star) -> DataFrame:
    return enforce(star.sales(), BATCH_RULES["sales"])


@report
def customers_valid_batch_rules(star: Star) -> DataFrame:
    return enforce(star.customers(), BATCH_RULES["customers"])


@report
def products_valid_batch_rules(star: Star) -> DataFrame:
    return enforce(star.products(), BATCH_RULES["products"])


@report
def rule_null_semantics(star: Star) -> DataFrame:
    """With every rule promoted to drop, a NULL condition drops the row."""
    return enforce(star.customers(), [drop(r.name, r.condition) for r in CLEANED_RULES["customers"]])


@report
def metrics_per_rule(star: Star) -> DataFrame:
    small = {
        "customers": star.customers(),
        "products": star.products(),
        "stores": with_known_manager(star.stores()),
    }
    reports = [rule_metrics(df, f"{name}_cleaned", CLEANED_RULES[name]) for name, df in small.items()]
    per_sale = {
        "sales_cleaned": ("TRUE", CLEANED_RULES["sales"]),
        "sales": ("quantity > 0", TRANSACTION_RULES),
        "returns": ("quantity < 0", TRANSACTION_RULES),
    }
    return reduce(DataFrame.unionByName, [*reports, rule_metrics_of(star.sales(), per_sale)])


# --- history ---------------------------------------------------------------------------------------


@report
def scd2_every_change(star: Star) -> DataFrame:
    return history.history_of_every_change(
        star.customer_changes(), ["customer_id"], "changed_at", ["change_id"]
    )


def _without_times(star: Star) -> DataFrame:
    """Change records of which some have no time."""
    return star.customer_changes().withColumn("changed_at", F.when(F.col("last_total").isNotNull(), F.col("changed_at")))


@report
def scd2_hot_keys(star: Star) -> DataFrame:
    """A few keys with all records, cut into slices."""
    return history.history_of_every_change(
        star.user_changes(), ["event_type"], "changed_at", ["event_id"], rows_per_slice=100
    )


@report
def scd2_null_hot_key(star: Star) -> DataFrame:
    """Most records have no key; they are cut into slices like those of any hot key."""
    changes = star.user_changes().withColumn("user_id", F.expr("CASE WHEN event_type = 'signup' THEN user_id END"))
    return history.history_of_tracked_columns(
        changes, ["user_id"], "changed_at", ["event_type"], ["event_id"],
        excluded=["event_id", "changed_at"], rows_per_slice=100,
    )


@report
def scd2_null_sequence(star: Star) -> DataFrame:
    """One current version per key, also where records have no time."""
    return history.history_of_every_change(_without_times(star), ["customer_id"], "changed_at", ["change_id"])


@report
def scd2_tracked_null_sequence(star: Star) -> DataFrame:
    versions = history.history_of_tracked_columns(
        _without_times(star), ["customer_id"], "changed_at", ["status"], ["change_id"],
        excluded=["change_id"], sentinel=True,
    )
    return versions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_versions"), F.count_if(F.col(history.CURRENT)).alias("n_current")
    )


def _tracked(star: Star) -> DataFrame:
    return history.history_of_tracked_columns(
        star.customer_changes(), ["customer_id"], "changed_at", ["status"], ["change_id"],
        excluded=["changed_at", "change_id"],
    )


@report
def scd2_tracked(star: Star) -> DataFrame:
    return _tracked(star)


@report
def scd2_keep_nulls(star: Star) -> DataFrame:
    return history.history_of_tracked_columns(
        star.customer_changes(), ["customer_id"], "changed_at", ["status"], ["change_id"],
        excluded=["change_id"], ignore_nulls=False, sentinel=True,
    )


@report
def scd2_ignore_nulls(star: Star) -> DataFrame:
    return history.fill_forward(star.customer_changes(), ["customer_id"], "changed_at", ["change_id"])


@report
def dim_current(star: Star) -> DataFrame:
    return history.current_of_every_change(star.customer_changes(), ["customer_id"], "changed_at", ["change_id"])


@report
def dim_current_open_end(star: Star) -> DataFrame:
    return history.open_ended(_tracked(star))


@report
def dim_history(star: Star) -> DataFrame:
    return history.closed(_tracked(star))


@report
def dim_latest(star: Star) -> DataFrame:
    return history.latest(star.customer_changes(), ["customer_id"], "changed_at", ["change_id"])


@report
def dim_duplicate_keys(star: Star) -> DataFrame:
    """Keys with several change records: what a lookup on the raw feed would multiply facts by."""
    return history.duplicate_keys(star.customer_changes(), ["customer_id"])


# --- enriched facts and gold -------------------------------------------------------------------------


@report
def enriched_facts(star: Star) -> DataFrame:
    return enrich(_sales(star), star.stores(), star.customers(), star.products())


@report
def daily_store_sales(star: Star) -> DataFrame:
    return gold.daily_store_sales(_sales(star), star.stores())


@report
def daily_store_sales_window(star: Star) -> DataFrame:
    return gold.daily_store_sales_by_window(_sales(star), star.stores())


@report
def daily_store_sales_trunc(star: Star) -> DataFrame:
    return gold.daily_store_sales_by_truncation(_sales(star), star.stores())


@report
def product_performance(star: Star) -> DataFrame:
    return gold.product_performance(_sales(star), star.products())


@report
def product_performance_maxcat(star: Star) -> DataFrame:
    return gold.product_performance_max_category(enrich(_sales(star), products=star.products()))


@report
def customer_value(star: Star) -> DataFrame:
    return gold.customer_value(_sales(star), star.customers())


def _bronze(star: Star) -> dict[str, DataFrame]:
    """Bronze frames of all columns of the model; those that the star has nothing for are NULL."""
    first_load = F.to_timestamp(F.lit("1995-01-01 00:00:00"))
    known = {
        "sales": star.sales(),
        "customers": star.customer_records(),
        "products": star.products().withColumn("last_update_time", first_load),
        "stores": star.stores().withColumn("last_update_time", first_load),
    }
    return {
        name: df.select(*[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(SCHEMAS[name])
        ])
        for name, df in known.items()
    }


def _sql_model(star: Star, name: str) -> DataFrame:
    return sql_models.over_frames(star.spark, _bronze(star), name)


@report
def stored_tables(star: Star) -> DataFrame:
    """The SQL models as stored tables and views of layers that are dropped again: rows, and rows of a view."""
    spark, prefix = star.spark, f"stored_{uuid.uuid4().hex[:12]}_"

    def build() -> DataFrame:
        create_layers(spark, prefix)
        for raw, frame in _bronze(star).items():
            overwrite_table(frame, f"{prefix}bronze.raw_{raw}", f"raw {raw}")
        create_table(spark, f"{prefix}bronze.late_sales", SALES_DDL, "sales of a later load")
        models = sql_models.build(spark, prefix)
        tables = {name: models[name] for name in sql_models.TABLES}
        tables["silver.customers_current"] = spark.table(f"{prefix}silver.customers_current")
        tables["bronze.late_sales"] = spark.table(f"{prefix}bronze.late_sales")
        return checks.row_counts(tables)

    try:
        return settle(spark, "stored-tables", build)
    finally:
        _drop_layers(spark, prefix)


@report
def sql_customer_history(star: Star) -> DataFrame:
    return _sql_model(star, "silver.customers").drop("join_date", "phone_number")


@report
def sql_daily_store_sales(star: Star) -> DataFrame:
    return _sql_model(star, "gold.daily_sales_by_store")


@report
def sql_product_performance(star: Star) -> DataFrame:
    return _sql_model(star, "gold.product_performance")


@report
def sql_customer_value(star: Star) -> DataFrame:
    return _sql_model(star, "gold.customer_lifetime_value")


# --- checks ----------------------------------------------------------------------------------------


@report
def missing_foreign_keys(star: Star) -> DataFrame:
    # Only the customer of a sale is found on its order.
    lines = star.sales(with_order=False)
    missing = [
        checks.rows_without_match(sales.select("transaction_id", key), dimension, key).select(
            F.lit(key).alias("missing_key"), "transaction_id"
        )
        for key, sales, dimension in (
            ("customer_id", star.sales(), star.customers()),
            ("product_id", lines, star.products()),
            ("store_id", lines, star.stores()),
        )
    ]
    return reduce(DataFrame.unionByName, missing)


@report
def sql_by_path(star: Star) -> DataFrame:
    """Counts in a Spark SQL text that names its tables by their paths."""
    table = lambda name: f"parquet.`{star.directory}/{name}.parquet`"
    return star.spark.sql(f"""
        SELECT 'orders' AS check, count(*) AS n FROM {table("orders")}
        UNION ALL
        SELECT 'orders without a customer', count(*)
        FROM {table("orders")} LEFT ANTI JOIN {table("customer")} ON o_custkey = c_custkey
    """)


@report
def health_check(star: Star) -> DataFrame:
    return checks.health_check(star.sales(), star.customers(), star.products(), star.stores())


@report
def reconcile_counts(star: Star) -> DataFrame:
    changes, sales = star.customer_changes(), _sales(star)
    versions = history.history_of_every_change(changes, ["customer_id"], "changed_at", ["change_id"])
    facts = enrich(sales, star.stores(), star.customers(), star.products())
    n = checks.count_rows()
    return checks.reconcile(
        [
            checks.measure(changes, changes=n, keys=F.count_distinct("customer_id")),
            checks.measure(versions, versions=n, current=F.count_if(history.CURRENT)),
            checks.measure(sales, sales=n),
            checks.measure(facts, facts=n),
            checks.measure(star.stores(), stores=n),
            checks.measure(star.products(), products=n),
        ],
        [
            checks.Check("versions_equal_changes", "versions", "changes"),
            checks.Check("one_current_row_per_key", "current", "keys"),
            checks.Check("facts_equal_sales", "facts", "sales"),
            checks.Check("at_least_a_hundred_sales", "sales", 100, ">="),
            checks.Check("as_many_stores_as_products", "stores", "products"),
        ],
    )


@report
def reconcile_metrics(star: Star) -> DataFrame:
    sales = _sales(star)
    facts = enrich(sales, customers=star.customers())
    revenue = F.round(F.sum(F.col("total_amount").cast("decimal(20,4)")))
    customers = F.count_distinct("customer_id")
    closed = history.closed(_tracked(star))
    return checks.reconcile(
        [
            checks.measure(facts, facts_revenue=revenue),
            checks.measure(gold.customer_value(facts), facts_customers=customers),
            checks.measure(sales, sales_revenue=revenue, sales_customers=customers),
            checks.measure(closed, closed_versions=checks.count_rows()),
        ],
        [
            checks.Check("total_revenue", "facts_revenue", "sales_revenue"),
            checks.Check("customers_with_sales", "facts_customers", "sales_customers"),
            checks.Check("history_rows", "closed_versions", 1, ">="),
        ],
    )


@report
def key_inventory(star: Star) -> DataFrame:
    return checks.key_inventory(
        {
            "customers": (star.customers(), "customer_id"),
            "products": (star.products(), "product_id"),
            "stores": (star.stores(), "store_id"),
        }
    )


@report
def high_water_mark(star: Star) -> DataFrame:
    return checks.high_water_mark(star.sales(with_order=False), "transaction_id")


# --- streams ---------------------------------------------------------------------------------------


class _Arrivals:
    """A frame laid out as landing files and read back as a stream of several micro-batches."""

    def __init__(self, star: Star, df: DataFrame, label: str, batches: int = 4):
        self.spark, self.root, self.ddl = star.spark, new_dir(star.spark, label), df.schema.toDDL()
        n_files = max(batches, star.spark.sparkContext.defaultParallelism)
        # Rows are dealt out by their hash, so every batch has late and out-of-order ones.
        df.repartition(n_files, F.xxhash64(*df.columns)).write.parquet(self.dir("landing"))
        self.files_per_batch = max(1, n_files // batches)

    def dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stream(self) -> DataFrame:
        return stream_parquet(self.spark, self.dir("landing"), self.ddl, self.files_per_batch)

    def written(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.dir(name))


@report
def stream_daily_events(star: Star) -> DataFrame:
    """Append mode: a day comes out once the watermark has passed its end, so the last one is held back."""
    events = star.table("events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    arrivals = _Arrivals(star, events, "daily-events")
    # One batch: across batches dealt out by hash, most rows would be later than the watermark.
    whole = stream_parquet(star.spark, arrivals.dir("landing"), arrivals.ddl)
    totals = daily_totals(whole, "ts", "value", "event_type")
    append_stream(totals, arrivals.dir("out"), arrivals.dir("checkpoint")).awaitTermination()
    return arrivals.written("out")


def _stream_history(star: Star, tracked: list[str] | None) -> DataFrame:
    arrivals = _Arrivals(star, star.user_changes(), "user-changes")
    table = HistoryTable(
        star.spark, arrivals.dir("history"), arrivals.ddl, ["user_id"], "changed_at", ["event_id"], tracked,
        excluded=["event_id"], buckets=star.spark.sparkContext.defaultParallelism,
    )
    table.follow(arrivals.stream(), arrivals.dir("checkpoint")).awaitTermination()
    return table.read()


@report
def stream_scd2(star: Star) -> DataFrame:
    return _stream_history(star, ["event_type"])


@report
def stream_scd2_every_change(star: Star) -> DataFrame:
    return _stream_history(star, None)


@report
def stream_split(star: Star) -> DataFrame:
    arrivals = _Arrivals(star, star.web_sales(), "split")
    cleaned = with_sale_day(arrivals.stream())
    for query in split_stream(
        cleaned, arrivals.dir("sales"), arrivals.dir("returns"), arrivals.dir("checkpoint")
    ):
        query.awaitTermination()
    sold = arrivals.written("sales").select(
        F.lit("sale").alias("kind"), "transaction_id", "date",
        F.col("quantity").alias("n"), F.col("total_amount").alias("amount"),
    )
    returned = arrivals.written("returns").select(
        F.lit("return").alias("kind"), "transaction_id", "date",
        F.col("returned_quantity").alias("n"), F.col("returned_amount").alias("amount"),
    )
    return sold.unionByName(returned)


@report
def stream_enriched_facts(star: Star) -> DataFrame:
    arrivals = _Arrivals(star, star.web_sales(), "facts")
    enrich_stream(
        sales_transactions(arrivals.stream()),
        lambda: {"stores": star.stores(), "customers": star.customers(), "products": star.products()},
        arrivals.dir("facts"),
        arrivals.dir("checkpoint"),
    ).awaitTermination()
    return arrivals.written("facts").drop("batch_id")


@report
def stream_facts_repaired(star: Star) -> DataFrame:
    """Facts whose stores and products come later than the facts, with the names filled in afterwards."""
    arrivals = _Arrivals(star, star.web_sales(), "repaired")
    early = {
        "stores": star.stores().where("store_id % 2 = 0"),
        "customers": star.customers(),
        "products": star.products().where("product_id % 3 > 0"),
    }
    enrich_stream(
        sales_transactions(arrivals.stream()), lambda: early, arrivals.dir("facts"), arrivals.dir("checkpoint")
    ).awaitTermination()
    whole = {"stores": star.stores(), "customers": star.customers(), "products": star.products()}
    repair_facts(star.spark, arrivals.dir("facts"), whole)
    return arrivals.written("facts").drop("batch_id")


@report
def stream_latest(star: Star) -> DataFrame:
    """The last change record of each customer, upserted in several micro-batches."""
    arrivals = _Arrivals(star, star.customer_changes(), "latest")
    table = LatestTable(
        star.spark, arrivals.dir("table"), arrivals.ddl, ["customer_id"], "changed_at", ["change_id"],
        buckets=star.spark.sparkContext.defaultParallelism,
    )
    table.follow(arrivals.stream(), arrivals.dir("checkpoint")).awaitTermination()
    return table.read()


def _land(arrivals: Sequence[DataFrame], path: str) -> int:
    """Write each frame after the one before, all as the same number of files, which is returned: a stream that takes so
    many at once takes a frame for each micro-batch."""
    spark = arrivals[0].sparkSession
    n_files = max(1, *(rows.rdd.getNumPartitions() for rows in arrivals))
    for i, rows in enumerate(arrivals, 1):
        rows.write.mode("append").parquet(path)
        # A task without rows leaves no file; an empty table is one.
        for _ in range(i * n_files - len(spark.read.schema(rows.schema).parquet(path).inputFiles())):
            rows.limit(0).write.mode("append").parquet(path)
    return n_files


@report
def stream_daily_store_sales(star: Star) -> DataFrame:
    """Closed days of web sales that come in the order of their weeks, but some of the first week with the last: those
    are not in the totals, and counted as late."""
    root, sales = new_dir(star.spark, "daily-sales"), star.web_sales()
    week = F.expr("int((day(event_time) - 1) / 7)")
    arrival = F.when((week == 0) & (F.col("transaction_id") % 10 == 0), F.lit(4)).otherwise(week)
    n_files = _land([sales.where(arrival == i) for i in range(5)], f"{root}/landing")
    stream = stream_parquet(star.spark, f"{root}/landing", sales.schema.toDDL(), n_files)
    append_stream(daily_store_sales_stream(stream), f"{root}/daily", f"{root}/c1").awaitTermination()
    count_arrivals(stream, f"{root}/arrivals", f"{root}/c2").awaitTermination()
    daily = star.spark.read.parquet(f"{root}/daily")
    late = late_rows(star.spark.read.parquet(f"{root}/arrivals"), daily)
    late = late.select(F.col("sale_date").alias("day"), F.col("store_id").alias("store"), "n_late")
    same = (F.col("sale_date") == F.col("day")) & F.col("store_id").eqNullSafe(F.col("store"))
    return daily.join(late, same).drop("day", "store", "n_rows")


@report
def stream_rule_metrics(star: Star) -> DataFrame:
    arrivals = _Arrivals(star, star.web_sales(), "metrics")
    ingest_with_rules(
        arrivals.stream(), "web_sales", TRANSACTION_RULES,
        arrivals.dir("kept"), arrivals.dir("metrics"), arrivals.dir("checkpoint"),
    ).awaitTermination()
    return total_metrics(star.spark, arrivals.dir("metrics"))


@report
def stream_rule_metrics_many_batches(star: Star) -> DataFrame:
    """More micro-batches than a query reports at once."""
    arrivals = _Arrivals(star, star.web_sales(), "many-batches", batches=110)
    ingest_with_rules(
        arrivals.stream(), "web_sales", TRANSACTION_RULES,
        arrivals.dir("kept"), arrivals.dir("metrics"), arrivals.dir("checkpoint"),
    ).awaitTermination()
    return total_metrics(star.spark, arrivals.dir("metrics"))


@report
def csv_ingest(star: Star) -> DataFrame:
    """Sales as CSV text, some with a word for a quantity; ingested good lines and quarantined bad ones."""
    root = new_dir(star.spark, "csv")
    fields = [name for name in T.StructType.fromDDL(SALES_FILE_DDL).names]
    _with_words(star.sales()).select(*[F.col(c).cast("string").alias(c) for c in fields]).write.option("header", True).csv(
        f"{root}/landing"
    )
    ingest_csv(
        star.spark, f"{root}/landing", SALES_FILE_DDL, f"{root}/bronze", f"{root}/checkpoint", purge=True
    ).awaitTermination()
    good = ingested(star.spark, f"{root}/bronze").select(
        F.lit("good").alias("line"), "transaction_id", F.col("event_time").cast("timestamp").alias("event_time"),
        "customer_id", "quantity", "total_amount", "payment_method",
    )
    bad = quarantined(star.spark, f"{root}/bronze").select(
        F.lit("malformed").alias("line"),
        F.split(CORRUPT, ",")[0].cast("bigint").alias("transaction_id"),
        *[F.lit(None).cast(good.schema[c].dataType).alias(c) for c in good.columns[2:]],
    )
    return good.unionByName(bad)


def _land_csv(df: DataFrame, directory: str, key: str, lacking: str, kinds: int = 3) -> None:
    """Text files of up to three kinds: with one column lacking and one that nobody knows, reversed with names in
    capitals, and in order."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    capitals = [F.col(c).alias(c.upper()) for c in reversed(df.columns)]
    others = [F.lit("a, \"quoted\" note").alias("note"), *[c for c in df.columns if c != lacking]]
    kind = F.pmod(F.col(key).cast("bigint"), F.lit(3))
    for i, columns in enumerate((others, capitals, df.columns)[:kinds]):
        part = texts.where(kind == 2 - i if kinds == 3 else F.lit(True)).select(*columns)
        part.write.mode("append").option("header", True).option("escape", '"').csv(directory)


@report
def csv_by_header(star: Star) -> DataFrame:
    """Sales from files whose headers differ, and lines of files without the key, which are counted."""
    root, fields = new_dir(star.spark, "csv-by-header"), T.StructType.fromDDL(SALES_DDL).names
    sales = star.sales().select(*fields)
    _land_csv(sales.where("transaction_id % 7 > 0"), f"{root}/landing", "transaction_id", "tax_amount")
    unknown = sales.where("transaction_id % 7 = 0").selectExpr("cast(store_id AS STRING) AS store_id", "payment_method")
    unknown.write.mode("append").option("header", True).csv(f"{root}/landing")
    rows = read_csv(star.spark, f"{root}/landing", SALES_DDL, ["transaction_id"])
    left = malformed_csv(star.spark, f"{root}/landing", SALES_DDL, ["transaction_id"])
    lines = left.groupBy("_header").agg(F.count(F.lit(1)).alias("transaction_id"))
    lines = lines.select("transaction_id", *[
        F.col("_header").alias(c) if c == "payment_method" else F.lit(None).cast(rows.schema[c].dataType).alias(c)
        for c in fields[1:]
    ])
    return rows.unionByName(lines)


def _csv_pipeline(star: Star, sources: Mapping[str, tuple[DataFrame, str]]) -> StreamingPipeline:
    """The streaming pipeline over CSV files of all sources, given as frames and the column that some files lack."""
    root = new_dir(star.spark, "csv-pipeline")
    landing = {name: f"{root}/landing/{name}" for name in sources}
    for name, (df, lacking) in sources.items():
        _land_csv(df, landing[name], KEYS[name], lacking, 3 if name == "sales" else 1)
    formats = {name: "csv" for name in sources}
    buckets = star.spark.sparkContext.defaultParallelism
    return StreamingPipeline(star.spark, f"{root}/lake", landing, buckets=buckets, formats=formats)


@report
def csv_pipeline_daily_sales(star: Star) -> DataFrame:
    """Daily store sales at the end of all layers over streams of CSV files."""
    lacking = {"sales": "tax_amount", "customers": "email", "products": "size", "stores": "phone_number"}
    bronze = _bronze(star) | {"sales": star.web_sales()}
    pipeline = _csv_pipeline(star, {name: (bronze[name], lacking[name]) for name in SCHEMAS})
    pipeline.run_pending()
    return pipeline.gold["daily_sales_by_store"].read()


@report
def ingest_rejects(star: Star) -> DataFrame:
    """The values that typing could not keep, with their texts, and how many there are in each column."""
    sales = _with_words(star.sales()).select(*T.StructType.fromDDL(SALES_DDL).names)
    pipeline = _csv_pipeline(star, {"sales": (sales, "tax_amount")})
    pipeline.ingest("sales")
    counts = pipeline.quality_report().where("dataset = 'typed_sales'")
    return pipeline.rejects("sales").unionByName(counts.select(
        F.col("n_violations").alias("transaction_id"), F.col("rule").alias("column"), F.lit(None).cast("string").alias("text")
    ))


@report
def metrics_all_rules(star: Star) -> DataFrame:
    """Rows and violations of every rule of the model, counted by the writes of the batch pipeline."""
    prefix = f"rules_{uuid.uuid4().hex[:12]}_"

    def build() -> DataFrame:
        pipeline = Pipeline(star.spark, prefix)
        pipeline.bronze(_bronze(star))
        pipeline.silver()
        return pipeline.quality_report().where("dataset NOT LIKE 'typed%'")

    try:
        return settle(star.spark, "all-rules", build)
    finally:
        _drop_layers(star.spark, prefix)


def _drop_layers(spark: SparkSession, prefix: str) -> None:
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer} CASCADE")


def _refreshed(
    star: Star,
    table: Callable[[SparkSession, str, str], refresh.FreshTable],
    event_time: str = "event_time",
    parts: Sequence[str] = ("unit_price < 50", "unit_price >= 50"),
) -> DataFrame:
    """Facts that arrive in several batches over the same days, with a refresh after each."""
    root = new_dir(star.spark, "refresh")
    facts = enrich(sales_transactions(star.web_sales()), star.stores(), star.customers(), star.products())
    facts = facts.withColumn("event_time", F.expr(event_time)).withColumn("sale_date", F.to_date("event_time"))
    fresh = table(star.spark, f"{root}/facts", f"{root}/gold")
    for batch_id, part in enumerate(parts):
        write_batch(facts.filter(part), f"{root}/facts", batch_id, ["sale_date"])
        fresh.refresh()
    return fresh.read()


@report
def refresh_daily(star: Star) -> DataFrame:
    return _refreshed(star, refresh.daily_store_sales)


@report
def refresh_null_day(star: Star) -> DataFrame:
    """Facts without a time count as well: alone in a batch, and along with others."""
    return _refreshed(
        star, refresh.daily_store_sales, "CASE WHEN unit_price >= 20 THEN event_time END",
        ("unit_price < 10", "unit_price BETWEEN 10 AND 50", "unit_price > 50"),
    )


@report
def refresh_products(star: Star) -> DataFrame:
    return _refreshed(star, refresh.product_performance)


@report
def refresh_customers(star: Star) -> DataFrame:
    return _refreshed(star, refresh.customer_value)


@report
def refresh_products_maxcat(star: Star) -> DataFrame:
    return _refreshed(star, refresh.product_performance_max_category)


# Amounts without a decimal form, and amounts whose sum overflows 64 bits.
_ODD_AMOUNT = "CASE WHEN transaction_id % 97 = 0 THEN double('NaN') WHEN transaction_id % 89 = 0 THEN 1e18D ELSE total_amount END"


def _told(name: str, key: str, of: str) -> Callable[[DataFrame], DataFrame]:
    """(table_name, key, total, odd) of a table; a total that is no number is NULL and odd."""
    odd = F.isnan(of) | (F.abs(of) > 1e15)
    return lambda df: df.select(
        F.lit(name).alias("table_name"), F.expr(key).alias("key"), F.when(~odd, F.col(of)).alias("total"),
        F.coalesce(odd, F.lit(False)).alias("odd"),
    )


@report
def refresh_odd_amounts(star: Star) -> DataFrame:
    """All refreshed tables, and the batch form by largest category, over amounts that are NaN or huge."""
    facts = enrich(sales_transactions(star.web_sales()), star.stores(), star.customers(), star.products())
    facts = facts.withColumns({"total_amount": F.expr(_ODD_AMOUNT), "sale_date": F.to_date("event_time")})
    root = new_dir(star.spark, "odd-amounts")
    tables = {
        "daily": (refresh.daily_store_sales, "concat(sale_date, ' ', store_id)", "total_revenue"),
        "products": (refresh.product_performance, "string(product_id)", "total_revenue"),
        "products by category": (refresh.product_performance_max_category, "string(product_id)", "total_revenue"),
        "customers": (refresh.customer_value, "string(customer_id)", "total_spend"),
        "averages": (refresh.customer_value, "string(customer_id)", "avg_order_value"),
    }
    fresh = {name: make(star.spark, f"{root}/facts", f"{root}/{name}") for name, (make, _, _) in tables.items() if name != "averages"}
    fresh["averages"] = fresh["customers"]
    for batch_id, part in enumerate(("unit_price < 50", "unit_price >= 50")):
        write_batch(facts.filter(part), f"{root}/facts", batch_id, ["sale_date"])
        for table in fresh.values():
            table.refresh()
    told = [_told(name, key, of)(fresh[name].read()) for name, (_, key, of) in tables.items()]
    whole = gold.product_performance_max_category(facts)
    told.append(_told("batch by category", "string(product_id)", "total_revenue")(whole))
    return reduce(DataFrame.unionByName, told)
