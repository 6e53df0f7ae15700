"""Upserts, repaired facts and daily totals kept in the state of a stream."""

import glob
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import files_of, same, sale
from tidemark.model import SALES_DDL
from tidemark.operators.history import latest
from tidemark.operators.sales import enrich
from tidemark.plans import gold, reports
from tidemark.sources import tables
from tidemark.sources.tables import append, write_batch
from tidemark.streaming import refresh
from tidemark.streaming.facts import count_arrivals, daily_store_sales_stream, late_rows, repair_facts
from tidemark.streaming.latest import LatestTable
from tidemark.streaming.queries import append_stream
from tidemark.sources.files import stream_parquet

T0 = datetime(2024, 3, 1, 10)
RECORDS = "k INT, at TIMESTAMP, id INT, v STRING, w INT"


def records(seed, n=400, keys=30):
    rng = random.Random(seed)
    key = lambda: None if rng.random() < 0.05 else 0 if rng.random() < 0.3 else rng.randrange(keys)
    at = lambda: None if rng.random() < 0.05 else T0 + timedelta(minutes=rng.randrange(50))
    return [(key(), at(), i, rng.choice(["a", "b", None]), i % 7) for i in range(n)]


@pytest.mark.parametrize("buckets", [1, 8])
def test_latest_of_shuffled_late_and_repeated_batches(spark, tmp_path, buckets):
    rows = records(1)
    random.Random(2).shuffle(rows)
    batches = [rows[i::5] for i in range(5)] + [[]] + [rows[:50]]  # nothing new, and old records once more
    table = LatestTable(spark, str(tmp_path), RECORDS, ["k"], "at", ["id"], buckets=buckets)
    assert table.read().collect() == []
    for i, batch in enumerate(batches):
        for _ in range(2 if i == 2 else 1):  # a repeated micro-batch
            table.apply(spark.createDataFrame(batch, RECORDS), i)
    same(table.read(), latest(spark.createDataFrame(rows, RECORDS), ["k"], "at", ["id"]))
    kept = {}
    for path in glob.glob(f"{tmp_path}/latest/batch_id=*/bucket=*/*.parquet"):
        bucket = path.split("/")[-2]
        kept.setdefault(bucket, set()).add(path.split("/")[-3])
    assert all(len(versions) <= 2 for versions in kept.values())


def test_latest_loses_nothing_when_the_driver_dies(spark, tmp_path, monkeypatch):
    rows = records(3)
    table = LatestTable(spark, str(tmp_path), RECORDS, ["k"], "at", ["id"], buckets=4)
    table.apply(spark.createDataFrame(rows[:200], RECORDS), 0)
    before = latest(spark.createDataFrame(rows[:200], RECORDS), ["k"], "at", ["id"])
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_put", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.apply(spark.createDataFrame(rows[200:], RECORDS), 1)
    same(table.read(), before)
    table.apply(spark.createDataFrame(rows[200:], RECORDS), 1)
    same(table.read(), latest(spark.createDataFrame(rows, RECORDS), ["k"], "at", ["id"]))


def test_latest_rewrites_touched_buckets_only(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path), RECORDS, ["k"], "at", ["id"], buckets=16)
    table.apply(spark.createDataFrame([(k, T0, k, "a", 1) for k in range(60)], RECORDS), 0)
    before = files_of(f"{tmp_path}/latest")
    table.apply(spark.createDataFrame([(7, T0 + timedelta(hours=1), 99, "z", 1)], RECORDS), 1)
    after = files_of(f"{tmp_path}/latest")
    assert before <= after and len({os.path.dirname(f) for f, _ in after - before}) == 1


def dimensions(spark, stores, products):
    named = lambda ids, key: spark.createDataFrame(
        [(i, f"{key} {i}", f"cat {i}") for i in ids], f"{key} LONG, name STRING, category STRING"
    )
    return {
        "stores": named(stores, "store_id"), "customers": named([1, 2], "customer_id"),
        "products": named(products, "product_id"),
    }


def landed_facts(spark, path):
    day = lambda d: None if d is None else T0 + timedelta(days=d)
    parts = [
        [sale(1, day(0), store=1), sale(2, day(0), store=2), sale(3, day(1), store=1)],
        [sale(4, day(0), store=1), sale(5, day(1), store=None), sale(6, day(2), store=9), sale(7, None, store=2)],
        [sale(8, day(3), product=5), sale(9, day(3), product=1)],
    ]
    early = dimensions(spark, [1], [1])
    for i, part in enumerate(parts):
        facts = enrich(spark.createDataFrame(part, SALES_DDL), **early)
        write_batch(facts.withColumn("sale_date", F.to_date("event_time")), path, i, ["sale_date"])
    return spark.createDataFrame([row for part in parts for row in part], SALES_DDL)


def test_repair_rewrites_partitions_with_found_names_only(spark, tmp_path):
    path = f"{tmp_path}/facts"
    sales = landed_facts(spark, path)
    before = {f: t for f, t in files_of(path)}
    late = dimensions(spark, [1, 2], [1, 5])
    assert repair_facts(spark, path, late) == [None, date(2024, 3, 1), date(2024, 3, 4)]
    facts = spark.read.parquet(path)
    same(facts.drop("batch_id", "sale_date"), enrich(sales, **late))
    kept = set(before) & {f for f, _ in files_of(path)}
    assert {f.split("sale_date=")[1].split("/part")[0] for f in kept} == {
        "2024-03-02/batch_id=0", "2024-03-01/batch_id=1", "2024-03-02/batch_id=1", "2024-03-03/batch_id=1",
    }
    # Nothing is left to repair, and names that facts have stay as they were.
    assert repair_facts(spark, path, late) == []
    renamed = {name: df.withColumn("name", F.lit("new")) for name, df in late.items()}
    assert repair_facts(spark, path, renamed) == []
    assert "_repair" not in os.listdir(path)


def test_repair_that_died_is_finished(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/facts"
    sales, late = landed_facts(spark, path), dimensions(spark, [1, 2], [1, 5])
    fresh = refresh.customer_value(spark, path, f"{tmp_path}/gold")
    fresh.refresh()
    with monkeypatch.context() as patch:
        patch.setattr("tidemark.streaming.facts.overwrite_partitions", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            repair_facts(spark, path, late)
    days = repair_facts(spark, path, {})
    assert days == [None, date(2024, 3, 1), date(2024, 3, 4)]
    expected = enrich(sales, **late)
    same(spark.read.parquet(path).drop("batch_id", "sale_date"), expected)
    # Tables made from the facts follow when told of the days.
    assert fresh.refresh(days) == days
    same(fresh.read(), gold.customer_value(expected))


def test_daily_sales_in_state_equal_batch_but_for_late_rows(spark, tmp_path):
    day = lambda d, minutes=0: T0 + timedelta(days=d, minutes=minutes)
    rng = random.Random(4)
    some = lambda d, n, first: [
        sale(first + i, day(d, rng.randrange(600)), rng.choice([1, 2, None]), rng.choice([1, 1, 1, 2, 3, None]), amount=rng.choice([1.5, 0.1]))
        for i in range(n)
    ]
    late = [sale(900, day(0), store=1), sale(901, day(0), store=1), sale(902, day(1), store=None), sale(903, day(1), store=77)]
    parts = [some(0, 40, 0), [*some(1, 40, 100), *some(0, 5, 200)], some(2, 40, 300), [*some(3, 10, 400), *late], some(4, 10, 500)]
    for part in parts:
        append(spark.createDataFrame(part, SALES_DDL).coalesce(1), f"{tmp_path}/in")
        stream = stream_parquet(spark, f"{tmp_path}/in", SALES_DDL, 1)
        # Every call goes on from the stored state.
        append_stream(daily_store_sales_stream(stream), f"{tmp_path}/out", f"{tmp_path}/c1").awaitTermination()
        count_arrivals(stream, f"{tmp_path}/arrivals", f"{tmp_path}/c2").awaitTermination()
    daily = spark.read.parquet(f"{tmp_path}/out")
    on_time = [row for part in parts for row in part if row not in late and row[2] < day(4).replace(hour=0)]
    facts = spark.createDataFrame(on_time, SALES_DDL).withColumn("store_name", F.lit("x"))
    same(daily.drop("n_rows"), gold.daily_store_sales(facts).drop("store_name"))
    told = late_rows(spark.read.parquet(f"{tmp_path}/arrivals"), daily).where("n_late > 0")
    assert sorted(map(tuple, told.collect()), key=str) == [
        (date(2024, 3, 1), 1, 2), (date(2024, 3, 2), 77, 1), (date(2024, 3, 2), None, 1),
    ]


def test_arrivals_are_landed_by_many_tasks(spark, tmp_path):
    """As many files for each, also where tasks have no rows, so that a stream takes them one after the other."""
    rows = spark.range(0, 30, 1, 3)
    arrivals = [rows.where("id % 2 = 0"), rows.where("id < 5"), rows.where("false"), rows]
    assert reports._land(arrivals, f"{tmp_path}/landing") == 3
    files = sorted(glob.glob(f"{tmp_path}/landing/*.parquet"), key=lambda f: os.stat(f).st_mtime_ns)
    assert len(files) == 12
    for i, arrival in enumerate(arrivals):
        assert sorted(spark.read.parquet(*files[3 * i : 3 * i + 3]).collect()) == sorted(arrival.collect())
