"""Incremental history must equal the history of the whole log, however its records arrive."""

import glob
import os
import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest

from tests.test_history import DDL, collect, make_log
from tidemark.operators import history as H
from tidemark.session import new_dir, shared_dir
from tidemark.sources import tables
from tidemark.sources.files import stream_parquet
from tidemark.streaming.history import HistoryTable

COLUMNS = ("k", "name", "city", "points", H.START, H.END, H.CURRENT)


def table(spark, tracked, **options):
    return HistoryTable(
        spark, new_dir(spark, "history"), DDL, ["k"], "seq", ["tie"], tracked,
        excluded=["seq", "tie"], buckets=8, **options,
    )


def whole(spark, rows, tracked):
    log = spark.createDataFrame(rows, DDL)
    if tracked is None:
        return H.history_of_every_change(log, ["k"], "seq", ["tie"], sentinel=False)
    return H.history_of_tracked_columns(log, ["k"], "seq", tracked, ["tie"], excluded=["seq", "tie"])


def check(spark, history, rows, tracked):
    expected = collect(whole(spark, rows, tracked), COLUMNS)
    assert collect(history.read(), COLUMNS) == expected
    assert collect(history.current(), COLUMNS) == [r for r in expected if r[-1]]


@pytest.mark.parametrize(
    "tracked, arrival", [(None, "shuffled"), (["city"], "in order"), (["city"], "shuffled"), (["name", "city"], "mostly in order")]
)
def test_batches_and_replays(spark, tracked, arrival):
    rows = make_log(21, True)[:300]
    if arrival != "shuffled":
        rows.sort(key=lambda r: r[1:3])
    if arrival == "mostly in order":
        rng = random.Random(5)
        for _ in range(12):
            i, j = rng.randrange(len(rows)), rng.randrange(len(rows))
            rows[i], rows[j] = rows[j], rows[i]
    history = table(spark, tracked, rows_per_slice=40)
    seen = []
    for batch_id, part in enumerate((rows[:110], rows[110:200], [], rows[200:])):
        batch = spark.createDataFrame(part, DDL)
        history.apply(batch, batch_id)
        seen += part
        if batch_id == 1:
            history.apply(batch, batch_id)
            check(spark, history, seen, tracked)
    check(spark, history, rows, tracked)


@pytest.mark.parametrize("tracked", [["name"], None])
def test_keys_go_back_as_far_as_their_records_are_late(spark, tracked):
    start = datetime(2024, 5, 1)
    history = table(spark, tracked)
    rows = [(k, start + timedelta(days=d), d, "n%d" % d, "x", d) for k in range(6) for d in (1, 2, 3, 4)]
    for batch_id, day in enumerate((1, 2, 3, 4)):
        history.apply(spark.createDataFrame([r for r in rows if r[2] == day], DDL), batch_id)
    check(spark, history, rows, tracked)
    # Late by two versions, and such that the version of day 2 is no longer a change on day 3; before all; and at the
    # same time as others, before and after them by the tiebreak, twice for one of them.
    late = [
        (0, start + timedelta(days=1, hours=5), 9, "n2", None, None), (1, start, 8, "first", None, 7),
        (2, start + timedelta(days=3), 0, "before", None, None), (3, start + timedelta(days=3), 9, "after", "z", 1),
        (4, start + timedelta(days=4), 4, "n4", "x", 4), (4, start + timedelta(days=4), 3, None, "y", None),
    ]
    if tracked is None:
        late = late[:4]  # copies of a record have no order among themselves
    history.apply(spark.createDataFrame(late, DDL), 4)
    check(spark, history, rows + late, tracked)
    # Records in time on top of keys that went back, and again late ones for the same keys.
    more = [(k, start + timedelta(days=9), 20 + k, None, "y", None) for k in range(6)]
    history.apply(spark.createDataFrame(more, DDL), 5)
    again = [(k, start + timedelta(days=2, hours=k), 30 + k, "again", "y", None) for k in range(3)]
    history.apply(spark.createDataFrame(again, DDL), 6)
    check(spark, history, rows + late + more + again, tracked)
    history.apply(spark.createDataFrame(again, DDL), 6)
    check(spark, history, rows + late + more + again, tracked)


def test_batch_that_dies_is_not_seen_and_repeated(spark, monkeypatch):
    rows = make_log(8, True)[:200]
    history = table(spark, ["city"])
    history.apply(spark.createDataFrame(rows[:100], DDL), 0)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_put", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            history.apply(spark.createDataFrame(rows[100:], DDL), 1)
    check(spark, history, rows[:100], ["city"])
    history.apply(spark.createDataFrame(rows[100:], DDL), 1)
    check(spark, history, rows, ["city"])


def test_later_batches_read_and_write_no_more_than_earlier_ones(spark, monkeypatch):
    start = datetime(2024, 5, 1)
    history = table(spark, ["name"])
    went_in, written, inside = [], [], history._history
    monkeypatch.setattr(history, "_history", lambda records: went_in.append(records.count()) or inside(records))
    monkeypatch.setattr(history, "_replayed", lambda *_: pytest.fail("nothing is late"))
    for day in range(20):
        before = set(glob.glob(f"{history.root}/*/batch_id=*/**/*.parquet", recursive=True))
        batch = [(k, start + timedelta(days=day), day, f"n{day // 2}", "x", day) for k in range(10)]
        history.apply(spark.createDataFrame(batch, DDL), day)
        new = set(glob.glob(f"{history.root}/*/batch_id=*/**/*.parquet", recursive=True)) - before
        written.append(sum(pq.ParquetFile(f).metadata.num_rows for f in new))
    assert went_in[4] == went_in[19] == 20
    assert written[5] == written[19] and written[4] == written[18] and max(written) <= 30
    assert history.read().count() == 100


def test_streamed_files_in_any_order(spark):
    rows = make_log(33, True)
    random.Random(1).shuffle(rows)
    history = table(spark, ["name", "city"])
    landing, checkpoint = new_dir(spark, "landing"), new_dir(spark, "checkpoint")
    for part in (rows[:200], rows[200:]):
        spark.createDataFrame(part, DDL).repartition(2).write.mode("append").parquet(landing)
        history.follow(stream_parquet(spark, landing, DDL, 1), checkpoint).awaitTermination()
    check(spark, history, rows, ["name", "city"])


def test_scratch_tables_are_gone_and_null_sequence_is_refused(spark):
    history = table(spark, ["city"], rows_per_slice=20)
    before = set(os.listdir(shared_dir(spark)))
    history.apply(spark.createDataFrame(make_log(3, True), DDL), 0)
    assert {d for d in set(os.listdir(shared_dir(spark))) - before if not d.startswith("history")} == set()
    with pytest.raises(Exception, match="known_sequence"):
        history.apply(spark.createDataFrame([(1, None, 1, "a", "x", 1)], DDL), 1)
