"""All layers end to end: batch tables, plain SQL and streams over the same small dirty shop."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.model import CUSTOMERS_DDL, PRODUCTS_DDL, SALES_DDL, SCHEMAS, STORES_DDL
from tidemark.operators import checks
from tidemark.operators.history import current, duplicate_keys
from tidemark.plans import sql_models
from tidemark.plans.pipeline import Pipeline
from tidemark.sources.tables import append, create_table, overwrite_table
from tidemark.streaming.pipeline import StreamingPipeline

T0 = datetime(2024, 3, 1, 8)


def shop(seed=5):
    """Rows per source in arrival order: dimension records out of order, sales with every fault."""
    rng = random.Random(seed)
    at = lambda minutes: T0 + timedelta(minutes=minutes)
    customers, products, stores, sales = [], [], [], []
    for n in range(60):
        i = rng.randrange(1, 16)
        email = rng.choice([None, "a@b.c", "broken"])
        customers.append((i, f"c{i}", email, "street %d" % rng.randrange(2), T0, rng.randrange(-5, 50),
                          "555", rng.choice([17, 18, 40, 101]), rng.choice(["Male", "Other", None]),
                          at(rng.randrange(500) + n / 100)))
    for n in range(30):
        i = rng.randrange(1, 9)
        products.append((i, f"p{i}", rng.choice(["Footwear", "Hats"]), "b", rng.choice([0.0, 5.5, 7.25, 10000.0]),
                         rng.randrange(-1, 5), "M", "Red", None, at(rng.randrange(500) + n / 100)))
    for n in range(12):
        i = rng.randrange(1, 4)
        stores.append((i, f"s{i}", "road", rng.choice([None, "boss"]), T0, rng.choice(["Open", "Closed"]), "555",
                       at(rng.randrange(500) + n / 100)))
    for i in range(1, 201):
        quantity = rng.choice([-1, 0, 1, 2, 3, None])
        price = rng.choice([9.99, 20.25, 31.5])
        sales.append((i, rng.choice([1, 2, 3, 9, None]), at(rng.randrange(6000)), rng.choice([1, 2, 3, 40, None]),
                      rng.randrange(1, 9), quantity, price, None if quantity is None else round(quantity * price, 2),
                      rng.choice(["Cash", "Cheque"]), rng.choice([0.0, 1.5, -1.0, None]), 0.08))
    rng.shuffle(customers)
    return {"customers": customers, "products": products, "stores": stores, "sales": sales}


@pytest.fixture(scope="module")
def raw(spark):
    return {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in shop().items()}


def plain(df):
    columns = sorted(df.columns)
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.fixture(scope="module")
def batch(spark, raw):
    pipeline = Pipeline(spark, "b_")
    pipeline.run(raw)
    return pipeline


def test_batch_layers(spark, batch, raw):
    for name in ("customers", "products", "stores"):
        key = f"{name[:-1]}_id"
        now = batch.table("silver", f"{name}_current")
        assert duplicate_keys(now, [key]).count() == 0
        assert now.filter("__END_AT IS NOT NULL").count() == 0
        assert "last_update_time" not in now.columns
    facts = batch.table("gold", "sales_facts")
    assert facts.count() == batch.table("silver", "sales_transactions").count() > 0
    assert batch.table("silver", "returns_transactions").count() > 0
    assert facts.filter("store_id = 9 AND store_name IS NULL").count() > 0
    totals = [
        batch.table("gold", table).agg(F.round(F.sum(column), 2)).first()[0]
        for table, column in (("daily_sales_by_store", "total_revenue"), ("product_performance", "total_revenue"),
                              ("customer_lifetime_value", "total_spend"))
    ]
    assert totals[0] == totals[1] == totals[2] == round(facts.agg(F.sum("total_amount")).first()[0], 2)
    report = {(r["dataset"], r["rule"]): r["n_violations"] for r in batch.quality_report().collect()}
    expected = raw["customers"].filter("age NOT BETWEEN 18 AND 100").count()
    assert report["customers_cleaned", "realistic_age"] == expected
    comment = spark.sql("DESCRIBE TABLE EXTENDED b_gold.sales_facts").filter("col_name = 'Comment'").first()
    assert comment["data_type"] == "Sales with names and categories"


def test_counts_reconcile(spark, batch, raw):
    n = checks.count_rows()
    measures = [
        checks.measure(batch.table("bronze", "raw_sales"), raw_sales=n),
        checks.measure(batch.table("silver", "customers_current"), customers=n),
        checks.measure(raw["customers"], raw_keys=F.count_distinct("customer_id")),
        checks.measure(spark.range(0), nothing=F.max("id")),
    ]
    report = checks.reconcile(
        measures,
        [
            checks.Check("raw_sales", "raw_sales", 200),
            checks.Check("customers", "customers", "raw_keys"),
            checks.Check("too_many", "raw_sales", 201, ">="),
            checks.Check("nothing", "nothing", 0),
        ],
    )
    assert {r["label"]: r["passed"] for r in report.collect()} == {
        "raw_sales": True, "customers": True, "too_many": False, "nothing": False,
    }
    with pytest.raises(Exception, match="no metric absent"):
        checks.reconcile(measures, [checks.Check("absent", "absent", 0)]).collect()
    with pytest.raises(Exception, match="(?i)duplicate"):
        checks.reconcile([*measures, measures[0]], [checks.Check("twice", "raw_sales", 200)]).collect()


def test_health_check(raw):
    counts = {r["table_name"]: r["record_count"] for r in checks.health_check(
        raw["sales"], raw["customers"], raw["products"], raw["stores"]).collect()}
    shop_rows = shop()
    assert counts["sales_count"] == 200 and counts["customers_count"] == 60
    for label, source, column in (("missing_stores", "stores", 1), ("missing_customers", "customers", 3),
                                  ("missing_products", "products", 4)):
        known = {row[0] for row in shop_rows[source]}
        assert counts[label] == sum(sale[column] not in known for sale in shop_rows["sales"])
    assert counts["missing_stores"] > 0


def test_bronze_stops_on_a_missing_key(spark, raw):
    broken = dict(raw, stores=spark.createDataFrame([(None,) + r[1:] for r in shop()["stores"][:1]], STORES_DDL))
    with pytest.raises(Exception, match="valid_store_id"):
        Pipeline(spark, "x_").bronze(broken)


def test_sql_models_equal_dataframe_pipeline(spark, raw):
    pipeline = Pipeline(spark, "q_")
    pipeline.bronze(raw)
    pipeline.silver_every_change()
    pipeline.gold()
    expected = {t: plain(pipeline.table("gold", t)) for t in ("product_performance", "daily_sales_by_store")}
    stores = plain(pipeline.table("silver", "stores"))
    written = sql_models.build(spark, "q_")
    assert plain(written["silver.stores"]) == stores
    for table, rows in expected.items():
        assert plain(written[f"gold.{table}"]) == rows
    now = spark.table("q_silver.customers_current")
    assert now.count() == current(written["silver.customers"]).count()
    assert str(now.select(F.max("__END_AT").cast("string")).first()[0]) == "9999-12-31 23:59:59"


def test_streams_equal_batch(spark, raw, batch, tmp_path):
    landing = {name: f"{tmp_path}/landing/{name}" for name in SCHEMAS}
    pipeline = StreamingPipeline(spark, f"{tmp_path}/lake", landing, buckets=2)

    def arrive(part):
        for name, rows in shop().items():
            # All dimension records come first: facts keep the names that were current when written.
            piece = rows[part::2] if name == "sales" else (rows if part == 0 else rows[:0])
            append(spark.createDataFrame(piece, SCHEMAS[name]).coalesce(1), landing[name])

    for part in (0, 1):
        arrive(part)
        pipeline.run_pending()
    for name in ("customers", "products", "stores"):
        assert plain(pipeline.histories[name].read()) == plain(batch.table("silver", name))
        assert plain(pipeline.current(name)) == plain(batch.table("silver", f"{name}_current"))
    for table, fresh in pipeline.gold.items():
        assert plain(fresh.read()) == plain(batch.table("gold", table))
    assert plain(pipeline.quality_report()) == plain(batch.quality_report())
    returned = spark.read.parquet(f"{tmp_path}/lake/silver/returns_transactions")
    assert returned.count() == batch.table("silver", "returns_transactions").count()


def test_declared_table_is_left_alone(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS decl")
    create_table(spark, "decl.t", PRODUCTS_DDL, "it's new")
    create_table(spark, "decl.t", "other INT")
    assert spark.table("decl.t").columns[0] == "product_id" and spark.table("decl.t").count() == 0
    assert len(CUSTOMERS_DDL) and len(SALES_DDL)


def test_tables_are_packed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS packed_tables")
    stored = overwrite_table(spark.range(1000), "packed_tables.numbers")
    try:
        assert stored.count() == 1000
        assert stored.inputFiles() and all(f.endswith(".zstd.parquet") for f in stored.inputFiles())
    finally:
        spark.sql("DROP DATABASE packed_tables CASCADE")
