"""Rows and amounts that used to get lost or doubled."""

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.functions.money import averaged, guarded_total, rounded_avg, rounded_sum, summed
from tidemark.operators.history import CURRENT, END, FAR_FUTURE, history_of_every_change, history_of_tracked_columns
from tidemark.operators.quality import drop
from tidemark.operators.sales import enrich
from tidemark.sources import tables
from tidemark.sources.files import cast_failures, stream_parquet, typed
from tidemark.sources.tables import write_batch
from tidemark.streaming import queries
from tidemark.streaming.queries import append_stream, append_with_rules, for_each_batch, total_metrics


def test_wide_ids_and_counted_casts(spark):
    df = spark.createDataFrame([("3000000000", "x"), ("1", "2"), (None, "y")], "id STRING, n STRING")
    assert [tuple(r) for r in typed(df, "id BIGINT, n INT").collect()] == [(3_000_000_000, None), (1, 2), (None, None)]
    assert [tuple(r) for r in cast_failures(df, "id BIGINT, n INT").orderBy("column").collect()] == [("id", 3, 0), ("n", 3, 2)]


@pytest.mark.parametrize(
    "amounts, total, mean",
    [
        ([0.00001] * 1000, 0.01, 0.0),
        ([12.34, -12.34, 0.1, 0.2], 0.3, 0.08),
        ([0.005] * 3, 0.02, 0.01),
        ([1e14, 0.25, None], 100000000000000.25, 50000000000000.13),
        ([], None, None),
        ([None], None, None),
        ([1e19, 1.0], 1e19, 5e18),
        ([float("inf"), 1.0], float("inf"), float("inf")),
        ([1e15] * 10_000, 1e19, 1e15),
        ([-1e15] * 10_000 + [0.25], -1e19, -999900009999000.1),
    ],
)
def test_totals(spark, amounts, total, mean):
    df = spark.createDataFrame([(a,) for a in amounts], "amount DOUBLE")
    assert tuple(df.agg(rounded_sum("amount"), rounded_avg("amount")).first()) == (total, mean)
    # Totals of totals tell the same.
    parts = df.groupBy(F.spark_partition_id()).agg(*guarded_total("amount", "t"))
    assert tuple(parts.agg(summed("t"), averaged("t")).first()) == (total, mean)


def test_nan_passes_through(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "amount DOUBLE")
    assert str(df.agg(rounded_sum("amount")).first()[0]) == "nan"
    parts = df.groupBy("amount").agg(*guarded_total("amount", "t"))
    assert [str(v) for v in parts.agg(summed("t"), averaged("t")).first()] == ["nan", "nan"]


@pytest.mark.parametrize("rows_per_slice", [2_000_000, 4])
def test_one_current_version_whatever_the_sequence(spark, rows_per_slice):
    day = datetime.datetime(2024, 1, 1)
    rows = [(1, None, 1, "a"), (1, None, 2, "b"), (1, day, 3, "c"), (2, None, 4, "d"), (2, None, 5, "d")]
    rows += [(3, day if i > 900 else None, 100 + i, "x" if i % 2 else "y") for i in range(1000)]
    log = spark.createDataFrame(rows, "k INT, at TIMESTAMP, id INT, v STRING")
    every = history_of_every_change(log, ["k"], "at", ["id"], rows_per_slice=rows_per_slice)
    tracked = history_of_tracked_columns(log, ["k"], "at", ["v"], ["id"], sentinel=True, rows_per_slice=rows_per_slice)
    for versions in (every, tracked):
        current = versions.where(CURRENT).collect()
        assert sorted(r["k"] for r in current) == [1, 2, 3]
        assert all(str(r[END]) == FAR_FUTURE for r in current)
    assert every.count() == len(rows)
    # A lookup through it must not repeat facts.
    names = every.where(CURRENT).select(F.col("k").cast("long").alias("customer_id"), F.col("v").alias("name"))
    sales = spark.createDataFrame([(1, 5.0), (2, 5.0)], "customer_id LONG, total_amount DOUBLE")
    assert enrich(sales, customers=names).count() == 2


def _landed(spark, path, files, rows=1):
    spark.range(files * rows).repartition(files, "id").write.parquet(f"{path}/landing")
    return spark.readStream.schema("id LONG").option("maxFilesPerTrigger", 1).parquet(f"{path}/landing")


EVEN = [drop("even", "id % 2 = 0")]


def _judge(spark, path, stream):
    build = lambda batch, counts: counts.enforce(batch, EVEN, "numbers")
    return append_with_rules(stream, build, f"{path}/out", f"{path}/metrics", f"{path}/checkpoint", "numbers")


def _judged(spark, path):
    row = total_metrics(spark, f"{path}/metrics").first()
    return row["n_rows"], row["n_violations"], sorted(r["id"] for r in spark.read.parquet(f"{path}/out").collect())


def test_metrics_of_more_batches_than_spark_reports(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = _landed(spark, tmp_path, 12, 10)
        for _ in range(2):  # the second run finds nothing new and changes nothing
            _judge(spark, tmp_path, stream).awaitTermination()
        assert _judged(spark, tmp_path) == (120, 60, list(range(0, 120, 2)))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


@pytest.mark.parametrize("place", ["before rows", "before counts", "before publishing", "after publishing"])
def test_a_stream_killed_inside_a_batch_counts_and_shows_it_once(spark, tmp_path, monkeypatch, place):
    stream = _landed(spark, tmp_path, 4, 10)
    store, put, publish, done = queries.store_counts, tables._put, queries.publish_batch, []

    def dies(call, when, after=False):
        def run(*arguments):
            if after:
                call(*arguments)
            if len(done) == 2:
                done.append("died")
                raise RuntimeError("killed " + when)
            if not after:
                call(*arguments)
            done.append(when)

        return run

    with monkeypatch.context() as patch:
        if place == "before rows":
            patch.setattr(queries, "publish_batch", dies(publish, place))
        if place == "before counts":
            patch.setattr(queries, "store_counts", dies(store, place))
        if place == "before publishing":
            patch.setattr(tables, "_put", dies(put, place))
        if place == "after publishing":
            patch.setattr(queries, "publish_batch", dies(publish, place, after=True))
        with pytest.raises(StreamingQueryException, match="killed"):
            _judge(spark, tmp_path, stream).awaitTermination()
    # What has appeared is counted, and nothing else has.
    rows, violations, ids = _judged(spark, tmp_path)
    assert rows - violations >= len(ids) and len(ids) == len(set(ids))
    seen = stream_parquet(spark, f"{tmp_path}/out", "id LONG")
    append_stream(seen, f"{tmp_path}/copy", f"{tmp_path}/copy-checkpoint").awaitTermination()
    _judge(spark, tmp_path, stream).awaitTermination()
    assert _judged(spark, tmp_path) == (40, 20, list(range(0, 40, 2)))
    # A stream that follows the table has seen every row once, whenever it ran.
    append_stream(seen, f"{tmp_path}/copy", f"{tmp_path}/copy-checkpoint").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/copy").collect()) == list(range(0, 40, 2))


def test_a_second_checkpoint_is_refused(spark, tmp_path):
    stream = _landed(spark, tmp_path, 2)

    def run(checkpoint):
        for_each_batch(
            stream, lambda batch, number: write_batch(batch, f"{tmp_path}/out", number), f"{tmp_path}/{checkpoint}"
        ).awaitTermination()

    run("first")
    before = sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    run("first")
    with pytest.raises(StreamingQueryException, match="table of its own"):
        run("second")
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == before == [0, 1]
