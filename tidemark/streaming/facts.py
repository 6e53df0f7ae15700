"""Streaming facts: the split of the cleaned sales stream, enrichment with fresh dimension rows, repair of facts that came
before theirs, and daily totals."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.days import day_by_cast, day_window
from tidemark.functions.money import guarded_total, summed, total
from tidemark.model import EVENT_TIME_WATERMARK, LOOKUPS
from tidemark.operators.sales import enrich, returns_transactions, sales_transactions
from tidemark.session import exists, file_system
from tidemark.sources.tables import overwrite_partitions, publish_batch, write_batch
from tidemark.streaming.queries import append_stream, for_each_batch


def split_stream(
    cleaned: DataFrame, sales: str, returns: str, checkpoint: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Feed the sales and the returns table from one cleaned stream, as two independent queries."""
    return [
        append_stream(sales_transactions(cleaned), sales, f"{checkpoint}/sales", trigger),
        append_stream(returns_transactions(cleaned), returns, f"{checkpoint}/returns", trigger),
    ]


def enrich_stream(
    sales: DataFrame,
    dimensions: Callable[[], Mapping[str, DataFrame]],
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append enriched facts, partitioned by day and micro-batch.

    ``dimensions`` is called in every micro-batch and returns the current stores, customers and products: a
    dimension frame read once would not see later rows, because its files are listed only once.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        facts = enrich(batch, **dimensions()).withColumn("sale_date", day_by_cast())
        write_batch(facts, target, batch_id, ["sale_date"])

    return for_each_batch(sales, store, checkpoint, trigger)


def daily_store_sales_stream(sales: DataFrame) -> DataFrame:
    """Daily store sales with the state kept by Spark, for append mode: a day comes out once its window has closed.

    Distinct customers are exact, by two levels of state: totals per day, store and customer, and of those per day and
    store. A customer with a third of all sales is one row of the first level, and partial sums are combined on the
    map side; only the keys of days still open are in the state. Rows of a closed day are not counted; see
    :func:`late_rows`.
    """
    per_customer = (
        sales.withWatermark("event_time", EVENT_TIME_WATERMARK)
        .groupBy(day_window().alias("day_window"), "store_id", "customer_id")
        .agg(
            *guarded_total("total_amount", "revenue"),
            F.count("transaction_id").alias("transactions"),
            F.sum("quantity").alias("items"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    again = F.window(F.window_time("day_window"), "1 day").alias("again")
    per_store = per_customer.groupBy(again, "store_id").agg(
        summed("revenue").alias("total_revenue"),
        F.sum("transactions").alias("total_transactions"),
        F.sum("items").alias("total_items_sold"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("n").alias("n_rows"),
    )
    return per_store.select(F.col("again.start").cast("date").alias("sale_date"), *per_store.columns[1:])


def count_arrivals(sales: DataFrame, target: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Store how many rows of each day came with each micro-batch; reads no column but the time and the store."""

    def store(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(day_by_cast().alias("sale_date"), "store_id").agg(F.count(F.lit(1)).alias("n_rows"))
        publish_batch(counts, target, batch_id)

    return for_each_batch(sales.select("event_time", "store_id"), store, checkpoint, trigger)


def late_rows(arrivals: DataFrame, daily: DataFrame) -> DataFrame:
    """(sale_date, store_id, n_late): rows that came after their day had closed, for every closed day and store.

    ``daily`` is what :func:`daily_store_sales_stream` has put out. Up to the last closed day, all rows that came and
    that it has not counted were dropped.
    """
    rows = arrivals.select("sale_date", "store_id", "n_rows").unionByName(
        daily.select("sale_date", "store_id", (-F.col("n_rows")).alias("n_rows"))
    )
    closed = daily.agg(F.max("sale_date").alias("closed"))
    late = rows.groupBy("sale_date", "store_id").agg(F.sum("n_rows").alias("n_late"))
    # One row, so that it is a lookup and no product.
    return late.join(F.broadcast(closed), F.col("sale_date") <= F.col("closed")).drop("closed")


def repair_facts(
    spark: SparkSession, target: str, dimensions: Mapping[str, DataFrame]
) -> list[date | None]:
    """Fill in names of dimension rows that came after their facts, and return the days that were rewritten.

    From the keys of the dimensions to the facts without a name: the partitions (day and micro-batch) that hold such a
    fact are rewritten, all others keep their files. Names that a fact has stay. The new partitions are stored in whole
    before they replace the old ones, and a repair that died is finished by the next call. Not to be run while
    :func:`enrich_stream` is in a micro-batch.
    """
    journal, parts = f"{target}/_repair", ["sale_date", "batch_id"]
    files, place = file_system(spark, journal)
    if not exists(spark, f"{journal}/_SUCCESS"):
        facts = spark.read.parquet(target)
        touched = reduce(DataFrame.unionByName, [
            _nameless(facts, name).select(LOOKUPS[name][0], *parts)
            .join(_named(dimensions[name], name).select(LOOKUPS[name][0]), LOOKUPS[name][0], "left_semi").select(*parts)
            for name in LOOKUPS
        ]).distinct()
        days, batches = F.col("sale_date").eqNullSafe(F.col("day")), F.col("batch_id") == F.col("batch")
        stale = facts.join(touched.toDF("day", "batch"), days & batches, "left_semi")
        _filled(stale, dimensions).write.mode("overwrite").parquet(journal)
    repaired = spark.read.parquet(journal)
    rewritten = [row[0] for row in repaired.select("sale_date").distinct().collect()]
    if rewritten:
        overwrite_partitions(repaired, target, parts)
    files.delete(place, True)
    return sorted(rewritten, key=lambda day: (day is not None, day))


def _nameless(facts: DataFrame, dimension: str) -> DataFrame:
    """Facts that have a key but none of the columns looked up by it; files without NULL names are skipped."""
    key, columns = LOOKUPS[dimension]
    return facts.filter(" AND ".join([f"{key} IS NOT NULL", *[f"{c} IS NULL" for c in columns]]))


def _named(rows: DataFrame, dimension: str) -> DataFrame:
    """Dimension rows that have something to look up."""
    return rows.filter(" OR ".join(f"{old} IS NOT NULL" for old in LOOKUPS[dimension][1].values()))


def _filled(facts: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """All names of a dimension anew where a fact has none of them."""
    filled = facts
    for name, (key, columns) in LOOKUPS.items():
        found = dimensions[name].select(F.col(key).alias("found_key"), *[F.col(o).alias(f"found_{n}") for n, o in columns.items()])
        empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])
        filled = filled.join(found, F.col(key) == F.col("found_key"), "left").withColumns(
            {c: F.when(empty, F.col(f"found_{c}")).otherwise(F.col(c)) for c in columns}
        ).drop(*found.columns)
    return filled.select(*facts.columns)


def daily_totals(stream: DataFrame, time: str, value: str, *keys: str) -> DataFrame:
    """Count and sum per tumbling day and keys. On a stream, rows later than the watermark are not counted
    and a day appears once the watermark has passed its end."""
    return (
        stream.withWatermark(time, EVENT_TIME_WATERMARK)
        .groupBy(day_window(time).alias("day_window"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), total(value).alias("total"))
        .select(F.col("day_window.start").cast("date").alias("day"), *keys, "n", "total")
    )
