"""Ingest, splitting, enrichment, refresh and windows on streams."""

import glob
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.model import SALES_DDL, SALES_FILE_DDL, TRANSACTION_RULES
from tidemark.operators.quality import fail, rule_metrics
from tidemark.operators.sales import enrich, returns_transactions, sales_transactions
from tidemark.plans import gold
from tidemark.plans.star import Star
from tidemark.session import new_dir
from tidemark.sources.delimited import HEADER as FILE_HEADER
from tidemark.sources.delimited import malformed_csv, read_csv
from tidemark.sources.files import CORRUPT, bronze, stream_parquet, typed
from tidemark.sources.tables import append, write_batch
from tidemark.streaming import refresh
from tidemark.streaming.facts import daily_totals, enrich_stream, split_stream
from tidemark.streaming.ingest import ingest_csv, ingest_with_rules, ingested, quarantined
from tidemark.streaming.queries import append_stream, for_each_batch

T0 = datetime(2024, 3, 1, 10)
HEADER = "transaction_id,store_id,event_time,customer_id,product_id,quantity,unit_price,total_amount,payment_method,discount_applied,tax_amount\n"


def same(left, right):
    columns = sorted(right.columns)
    assert sorted(left.columns) == columns
    plain = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert plain(left) == plain(right)


def sale(i, at=T0, store=1, customer=1, product=1, quantity=1, amount=10.0, discount=0.0):
    return (i, store, at, customer, product, quantity, amount, amount * quantity, "Cash", discount, 0.8)


def test_csv_files_are_ingested_once_and_bad_lines_kept(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(HEADER + "1,1,2024-03-01 10:00:00,1,1,2,5.0,10.0,Cash,0.0,0.8\nwhat,is,this\n")

    def ingest():
        ingest_csv(
            spark, str(landing), SALES_FILE_DDL, f"{tmp_path}/bronze", f"{tmp_path}/c",
            purge=True, max_files_per_trigger=1,
        ).awaitTermination()

    ingest()
    (landing / "b.csv").write_text(HEADER + "2,1,2024-03-01 11:00:00,1,1,many,5.0,10.0,Cash,0.0,0.8\n")
    (landing / "c.csv").write_text(HEADER + "3,1,2024-03-01 12:00:00,1,,1,5.0,10.0,Cash,,0.8\n")
    ingest()
    ingest()
    good = ingested(spark, f"{tmp_path}/bronze")
    assert sorted(r["transaction_id"] for r in good.collect()) == [1, 3]
    assert {os.path.basename(r["source_file_path"]) for r in good.collect()} == {"a.csv", "c.csv"}
    assert good.filter("ingest_timestamp IS NULL").count() == 0
    bad = [r[0] for r in quarantined(spark, f"{tmp_path}/bronze").select(CORRUPT).collect()]
    assert sorted(line.split(",")[0] for line in bad) == ["2", "what"]
    # A file goes away when a later batch commits; the last one may still lie there.
    assert "a.csv" not in os.listdir(landing)


def test_batch_csv_is_typed(spark, tmp_path):
    (tmp_path / "s.csv").write_text(HEADER + "1,1,2024-03-01 10:00:00,1,1,2,5.0,10.0,Cash,0.0,0.8\n")
    rows = read_csv(spark, str(tmp_path / "s.csv"), SALES_DDL)
    assert rows.first()["event_time"] == T0
    assert [f.simpleString() for f in rows.schema][0] == "transaction_id:bigint"


def test_typed_turns_misfits_into_null(spark):
    row = spark.createDataFrame([("7", "x", "2024-03-01")], "a STRING, b STRING, c STRING")
    got = typed(row, "a INT, b INT, c TIMESTAMP").first()
    assert (got["a"], got["b"], got["c"]) == (7, None, datetime(2024, 3, 1))


def test_bronze_keeps_lineage(spark, tmp_path):
    spark.createDataFrame([sale(1)], SALES_DDL).write.parquet(f"{tmp_path}/in")
    rows = bronze(spark.read.parquet(f"{tmp_path}/in"), SALES_DDL).collect()
    assert rows[0]["source_file_path"].endswith(".parquet") and rows[0]["ingest_timestamp"] is not None


def test_rules_on_a_stream_are_counted_and_fail_stops(spark, tmp_path):
    rows = [sale(1), sale(2, discount=-1.0), sale(3, store=None)]
    frame = spark.createDataFrame(rows, SALES_DDL)
    frame.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = stream_parquet(spark, f"{tmp_path}/in", SALES_DDL, 1)
    ingest_with_rules(
        stream, "sales", TRANSACTION_RULES, f"{tmp_path}/out", f"{tmp_path}/metrics", f"{tmp_path}/c"
    ).awaitTermination()
    assert [r[0] for r in spark.read.parquet(f"{tmp_path}/out").select("transaction_id").collect()] == [1]
    counted = (
        spark.read.parquet(f"{tmp_path}/metrics").groupBy("dataset", "rule", "action")
        .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_violations").alias("n_violations"))
    )
    same(counted, rule_metrics(frame, "sales", TRANSACTION_RULES))
    strict = [fail("small", "transaction_id < 3")]
    with pytest.raises(Exception, match="small"):
        ingest_with_rules(
            stream, "sales", strict, f"{tmp_path}/out2", f"{tmp_path}/m2", f"{tmp_path}/c2"
        ).awaitTermination()


def test_split_stream_equals_batch(spark, testdata, tmp_path):
    sales = Star(spark, testdata).web_sales()
    sales.repartition(5).write.parquet(f"{tmp_path}/in")
    stream = stream_parquet(spark, f"{tmp_path}/in", sales.schema.toDDL(), 2)
    for query in split_stream(stream, f"{tmp_path}/s", f"{tmp_path}/r", f"{tmp_path}/c"):
        query.awaitTermination()
    same(spark.read.parquet(f"{tmp_path}/s"), sales_transactions(sales))
    same(spark.read.parquet(f"{tmp_path}/r"), returns_transactions(sales))


def test_enrichment_sees_dimension_rows_that_arrive_later(spark, tmp_path):
    def dimension(name, key, ids):
        df = spark.createDataFrame(
            [(i, f"{name} {i}", "cat") for i in ids], f"{key} INT, name STRING, category STRING"
        )
        append(df, f"{tmp_path}/{name}")

    def dimensions():
        return {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("stores", "customers", "products")}

    for name, key in (("stores", "store_id"), ("customers", "customer_id"), ("products", "product_id")):
        dimension(name, key, [1])

    def arrive(rows):
        append(spark.createDataFrame(rows, SALES_DDL).coalesce(1), f"{tmp_path}/sales")

    def run():
        stream = stream_parquet(spark, f"{tmp_path}/sales", SALES_DDL)
        enrich_stream(stream, dimensions, f"{tmp_path}/facts", f"{tmp_path}/c").awaitTermination()

    arrive([sale(1), sale(2, store=2)])
    run()
    dimension("stores", "store_id", [2])
    arrive([sale(3, store=2)])
    run()
    names = {r["transaction_id"]: r["store_name"] for r in spark.read.parquet(f"{tmp_path}/facts").collect()}
    # Facts keep what was known when they were written; a sale without a match is kept.
    assert names == {1: "stores 1", 2: None, 3: "stores 2"}


def test_repeated_batch_replaces_its_first_attempt(spark, tmp_path):
    frame = spark.createDataFrame([sale(1), sale(2)], SALES_DDL)
    for _ in range(2):
        write_batch(frame, f"{tmp_path}/t", 3)
    write_batch(frame, f"{tmp_path}/t", 4)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4


@pytest.mark.parametrize(
    "make, whole",
    [
        (refresh.daily_store_sales, gold.daily_store_sales),
        (refresh.product_performance, gold.product_performance),
        (refresh.product_performance_max_category, gold.product_performance_max_category),
        (refresh.customer_value, gold.customer_value),
    ],
)
def test_refresh_recomputes_touched_days_only(spark, testdata, tmp_path, make, whole):
    star = Star(spark, testdata)
    facts = enrich(
        sales_transactions(star.web_sales()), star.stores(), star.customers(), star.products()
    ).withColumn("sale_date", F.to_date("event_time"))
    fresh = make(spark, f"{tmp_path}/facts", f"{tmp_path}/gold")
    assert fresh.refresh() == []
    early = facts.filter("event_time < TIMESTAMP'2024-01-20 12:00:00'")
    write_batch(early, f"{tmp_path}/facts", 0, ["sale_date"])
    first = fresh.refresh()
    same(fresh.read(), whole(early))
    assert fresh.refresh() == []
    before = set(glob.glob(f"{tmp_path}/gold/days/sale_date=2024-01-0*/*.parquet"))
    write_batch(facts.exceptAll(early), f"{tmp_path}/facts", 1, ["sale_date"])
    second = fresh.refresh()
    same(fresh.read(), whole(facts))
    assert first[-1] == date(2024, 1, 20) and second[0] == date(2024, 1, 20)
    assert before and before == set(glob.glob(f"{tmp_path}/gold/days/sale_date=2024-01-0*/*.parquet"))


FACT_DDL = (
    "transaction_id LONG, event_time TIMESTAMP, customer_id LONG, customer_name STRING, product_id LONG, product_name STRING,"
    " product_category STRING, quantity LONG, total_amount DOUBLE, sale_date DATE"
)


def fact(i, day, key, category="a", amount=10.0):
    at = None if day is None else datetime(2024, 3, day, 12)
    return (i, at, key, f"c{key}", key, f"p{key}", category, 1, amount, None if day is None else at.date())


def files_of(path):
    return {(f, os.stat(f).st_mtime_ns) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("name, key", [("customer_value", "customer_id"), ("product_performance_max_category", "product_id")])
def test_untouched_buckets_keep_their_files(spark, tmp_path, name, key):
    fresh = getattr(refresh, name)(spark, f"{tmp_path}/facts", f"{tmp_path}/gold")
    facts = spark.createDataFrame([fact(i, 1 + i % 3, i % 40) for i in range(400)], FACT_DDL)
    write_batch(facts, f"{tmp_path}/facts", 0, ["sale_date"])
    fresh.refresh()
    before = files_of(f"{tmp_path}/gold/table")
    more = spark.createDataFrame([fact(1000, 2, 7, "z", 5.0), fact(1001, None, 7, None, None)], FACT_DDL)
    write_batch(more, f"{tmp_path}/facts", 1, ["sale_date"])
    assert fresh.refresh() == [None, date(2024, 3, 2)]
    after = files_of(f"{tmp_path}/gold/table")
    assert len(before - after) == len(after - before) == 1 and len(before) > 20
    same(fresh.read(), getattr(gold, name)(facts.union(more)))
    # The scan of rows by day for one bucket skips the others by the statistics of the sorted files.
    scan = spark.read.parquet(f"{tmp_path}/gold/days").filter(F.col("bucket").isin([1]))
    assert "In(bucket, [1])" in scan._jdf.queryExecution().executedPlan().toString() or "EqualTo(bucket,1)" in (
        scan._jdf.queryExecution().executedPlan().toString()
    )


def test_largest_category_goes_down_and_rows_go_away(spark, tmp_path):
    fresh = refresh.product_performance_max_category(spark, f"{tmp_path}/facts", f"{tmp_path}/gold")
    rows = [fact(1, 1, 1, "a"), fact(2, 2, 1, "z"), fact(3, 2, 2, "b"), fact(4, 3, 3, "b"), fact(5, 3, 1, "b")]
    write_batch(spark.createDataFrame(rows, FACT_DDL), f"{tmp_path}/facts", 0, ["sale_date"])
    fresh.refresh()
    assert {r["product_id"]: r["product_category"] for r in fresh.read().collect()} == {1: "z", 2: "b", 3: "b"}
    # The second day is rewritten without the first product's largest category, and without the second product.
    write_batch(spark.createDataFrame([fact(6, 2, 4, "c")], FACT_DDL), f"{tmp_path}/facts", 0, ["sale_date"])
    assert fresh.refresh() == []
    assert fresh.refresh([date(2024, 3, 2)]) == [date(2024, 3, 2)]
    assert {r["product_id"]: r["product_category"] for r in fresh.read().collect()} == {1: "b", 3: "b", 4: "c"}


def test_refresh_that_died_is_repeated(spark, tmp_path, monkeypatch):
    fresh = refresh.customer_value(spark, f"{tmp_path}/facts", f"{tmp_path}/gold")
    facts = [spark.createDataFrame([fact(10 * b + i, 1 + i % 2, i) for i in range(10)], FACT_DDL) for b in range(3)]
    with monkeypatch.context() as patch:
        patch.setattr(refresh, "append", lambda *_: 1 / 0)
        write_batch(facts[0], f"{tmp_path}/facts", 0, ["sale_date"])
        with pytest.raises(ZeroDivisionError):
            fresh.refresh()
    write_batch(facts[1], f"{tmp_path}/facts", 1, ["sale_date"])
    fresh.refresh()
    same(fresh.read(), gold.customer_value(facts[0].union(facts[1])))


def write_csv(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8-sig" if "bom" in path.name else "utf-8"))


def test_csv_is_read_by_the_names_in_its_headers(spark, tmp_path):
    ddl = "id LONG, name STRING, price DOUBLE, at TIMESTAMP"
    files = {
        "order.csv": "id,name,price,at\n1,a,1.5,2024-03-01 10:00:00\n",
        "bom.csv": '\n"At", Price ,NAME,ID\r\n2024-03-02 00:00:00,2.5,"b, ""c""",2\r\n',
        "lacking.csv": "name,id\nd,3\n\n  \n,4\n",
        "more.csv": "city,id,country,name\nX,5,Y,e\nid\nX,6,Y,f,extra\n\"open,7,Y,g\n",
        "no_key.csv": "name,price\nh,1\nname,price\ni,2\n",
        "twice.csv": "id,name,id\n8,j,8\n",
        "header_only.csv": "id,name\n",
        "empty.csv": "",
        "words.csv": "id,price\n9,cheap\n10,3\n",
    }
    for name, text in files.items():
        write_csv(tmp_path / "in" / name, text)
    rows = read_csv(spark, f"{tmp_path}/in", ddl, ["id"])
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [
        (1, "a", 1.5, datetime(2024, 3, 1, 10)), (2, 'b, "c"', 2.5, datetime(2024, 3, 2)), (3, "d", None, None),
        (4, None, None, None), (5, "e", None, None), (9, None, None, None), (10, None, 3.0, None),
    ]
    left = malformed_csv(spark, f"{tmp_path}/in", ddl, ["id"]).select(CORRUPT, FILE_HEADER).collect()
    assert sorted(map(tuple, left)) == [
        ('"open,7,Y,g', "city,id,country,name"), ("8,j,8", "id,name,id"), ("X,6,Y,f,extra", "city,id,country,name"),
        ("h,1", "name,price"), ("i,2", "name,price"), ("id", "city,id,country,name"),
    ]


def test_headers_hold_for_all_blocks_of_a_file(spark, tmp_path):
    lines = "".join(f"{i * 2},n{i},{i}\n" for i in range(20_000))
    write_csv(tmp_path / "in" / "a.csv", "price,name,id\n" + lines)
    write_csv(tmp_path / "in" / "b.csv", "id,price\n" + "".join(f"{i},{i * 2}\n" for i in range(20_000, 40_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_csv(spark, f"{tmp_path}/in", "id LONG, name STRING, price DOUBLE", ["id"])
        assert rows.rdd.getNumPartitions() > 10
        got = rows.agg(F.count("id"), F.count("name"), F.sum("id"), F.count_if(F.col("price") == F.col("id") * 2)).first()
        assert tuple(got) == (40_000, 20_000, sum(range(40_000)), 40_000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_window_waits_for_the_watermark(spark, tmp_path):
    ddl = "at TIMESTAMP, k STRING, value DOUBLE"

    def arrive(*rows):
        append(spark.createDataFrame(list(rows), ddl).coalesce(1), f"{tmp_path}/in")
        stream = stream_parquet(spark, f"{tmp_path}/in", ddl, 1)
        totals = daily_totals(stream, "at", "value", "k")
        append_stream(totals, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
        return {
            (r["day"], r["k"]): (r["n"], r["total"])
            for r in spark.read.schema("day DATE, k STRING, n BIGINT, total DOUBLE").parquet(f"{tmp_path}/out").collect()
        }

    midnight = datetime(2024, 3, 2)
    assert arrive((midnight - timedelta(hours=2), "a", 1.5), (midnight + timedelta(minutes=5), "a", 1.0)) == {}
    # Late by less than the watermark: still counted.
    assert arrive((midnight - timedelta(minutes=1), "a", 2.0), (midnight + timedelta(hours=1), "a", 1.0)) == {
        (date(2024, 3, 1), "a"): (2, 3.5)
    }
    # Later than the watermark: the closed day does not change.
    assert arrive((midnight - timedelta(minutes=1), "a", 9.0)) == {(date(2024, 3, 1), "a"): (2, 3.5)}


def test_batches_run_with_adaptive_plans(spark, tmp_path):
    spark.createDataFrame([sale(1)], SALES_DDL).write.parquet(f"{tmp_path}/in")
    seen = []
    for_each_batch(
        stream_parquet(spark, f"{tmp_path}/in", SALES_DDL),
        lambda batch, _: seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled")),
        f"{tmp_path}/c",
    ).awaitTermination()
    assert seen == ["true"]
