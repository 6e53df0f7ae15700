"""History operators against a plain-Python replay of the change records."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.operators import slices
from tidemark.operators.slices import SLICE, find_hot_keys

DDL = "k INT, seq TIMESTAMP, tie INT, name STRING, city STRING, points INT"
EPOCH = datetime(2024, 1, 1)


def make_log(seed: int, hot: bool):
    """Shuffled change records with NULLs and sequence ties; with ``hot``, key 0 holds half of them."""
    rng = random.Random(seed)
    rows = []
    for tie in range(600):
        key = 0 if hot and rng.random() < 0.5 else rng.randrange(1, 40)
        at = EPOCH + timedelta(minutes=rng.randrange(0, 400))
        pick = lambda values: rng.choice(values)
        rows.append((key, at, tie, pick(["a", "b", None]), pick(["x", "x", "x", None]), pick([1, 2, 3, None])))
    rng.shuffle(rows)
    return rows


def replay(rows, tracked, ignore_nulls=True):
    names = ["name", "city", "points"]
    out = []
    for key in {r[0] for r in rows}:
        versions, state = [], {}
        for _, seq, tie, *values in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:3]):
            values = dict(zip(names, values))
            new = {
                c: (state.get(c) if ignore_nulls and values[c] is None else values[c]) for c in names
            }
            if not versions or any(new[c] != state[c] for c in tracked):
                versions.append({"start": seq})
            versions[-1].update(new)
            state = new
        for i, v in enumerate(versions):
            end = versions[i + 1]["start"] if i + 1 < len(versions) else None
            out.append((key, *[v[c] for c in names], v["start"], end, end is None))
    return sorted(out, key=repr)


def collect(df, columns=("k", "name", "city", "points", H.START, H.END, H.CURRENT)):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


@pytest.mark.parametrize(
    "hot, rows_per_slice, ignore_nulls, tracked",
    [
        (False, 10**6, True, ["city"]),
        (True, 10**6, False, ["name", "city"]),
        (True, 20, True, ["city"]),
        (True, 20, False, ["name", "city"]),
        (True, 3, True, ["name", "city"]),
        (True, 3, False, ["city"]),
    ],
)
def test_tracked_history_equals_replay(spark, hot, rows_per_slice, ignore_nulls, tracked):
    rows = make_log(7 if hot else 8, hot)
    got = H.history_of_tracked_columns(
        spark.createDataFrame(rows, DDL), ["k"], "seq", tracked, ["tie"],
        excluded=["tie", "seq"], ignore_nulls=ignore_nulls, rows_per_slice=rows_per_slice,
    )
    assert collect(got) == replay(rows, tracked, ignore_nulls)


@pytest.mark.parametrize("rows_per_slice", [10**6, 20, 2])
def test_every_change_is_a_version(spark, rows_per_slice):
    rows = make_log(3, True)
    log = spark.createDataFrame(rows, DDL)
    got = H.history_of_every_change(log, ["k"], "seq", ["tie"], sentinel=False, rows_per_slice=rows_per_slice)
    expected = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1:3])
        for i, r in enumerate(mine):
            end = mine[i + 1][1] if i + 1 < len(mine) else None
            expected.append((key, r[2], r[1], end, end is None))
    assert collect(got, ("k", "tie", H.START, H.END, H.CURRENT)) == sorted(expected, key=repr)


@pytest.mark.parametrize("rows_per_slice", [10**6, 5])
def test_fill_forward(spark, rows_per_slice):
    rows = make_log(5, True)
    got = H.fill_forward(spark.createDataFrame(rows, DDL), ["k"], "seq", ["tie"], rows_per_slice=rows_per_slice)
    expected = []
    for key in {r[0] for r in rows}:
        state = [None] * 3
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:3]):
            state = [new if new is not None else old for new, old in zip(r[3:], state)]
            expected.append((*r[:3], *state))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted(expected, key=repr)


def with_copies():
    """Half of the records are one and the same record of key 0."""
    rows = make_log(4, True)
    return rows + [max(r for r in rows if r[0] == 0 and r[3] and r[4] and r[5])] * 600


def test_copies_are_found_and_counted(spark, monkeypatch):
    monkeypatch.setattr(slices, "_ROWS_PER_COPY_CHUNK", 250)
    rows = with_copies()
    log = spark.createDataFrame(rows, DDL)
    hot = slices.find_hot_keys(log, ["k"], ["seq", "tie"], 20)
    assert hot.copies
    counted = hot.only(log).filter("k = 0").groupBy().sum(slices.COPIES).first()[0]
    assert counted == sum(r[0] == 0 for r in rows)
    for build in (
        lambda n: H.history_of_every_change(log, ["k"], "seq", ["tie"], sentinel=False, rows_per_slice=n),
        lambda n: H.history_of_tracked_columns(log, ["k"], "seq", ["city"], ["tie"], rows_per_slice=n),
        lambda n: H.fill_forward(log, ["k"], "seq", ["tie"], rows_per_slice=n),
    ):
        whole, sliced = build(10**9), build(20)
        assert collect(sliced, whole.columns) == collect(whole, whole.columns)


def test_segments_rise_with_key_and_order(spark):
    log = spark.createDataFrame(make_log(6, True), DDL)
    hot = slices.find_hot_keys(log, ["k"], ["seq", "tie"], 3)
    rows = sorted((r["k"], r["seq"], r["tie"], r[SLICE]) for r in hot.segments(log).collect())
    numbers = [r[3] for r in rows]
    assert numbers == sorted(numbers) and len(set(numbers)) > 30
    assert len(rows) == hot.only(log).count()
    whole = H.history_of_tracked_columns(log, ["k"], "seq", ["city"], ["tie"])
    sliced = H.history_of_tracked_columns(log, ["k"], "seq", ["city"], ["tie"], rows_per_slice=3)
    assert collect(sliced, whole.columns) == collect(whole, whole.columns)


def test_segments_are_not_limited_in_number(spark):
    """One key, four records to a segment, and nothing in the plan broadcast by a hint."""
    log = spark.range(480).selectExpr("1 AS k", "timestamp_seconds(id div 2) AS seq", "id AS tie", "id div 5 AS v")
    hot = slices.find_hot_keys(log, ["k"], ["seq", "tie"], 4)
    sizes = [r["count"] for r in hot.segments(log).groupBy(SLICE).count().collect()]
    assert len(sizes) > 100 and sum(sizes) == 480
    got = H.history_of_tracked_columns(log, ["k"], "seq", ["v"], ["tie"], rows_per_slice=4)
    whole = H.history_of_tracked_columns(log, ["k"], "seq", ["v"], ["tie"])
    assert got.count() == 96 and got.exceptAll(whole).isEmpty()
    assert "ResolvedHint" not in got._jdf.queryExecution().analyzed().toString()


def test_many_short_segments_take_few_tasks(spark):
    """Tasks and files follow from the rows and the session's partitions, not from the number of segments."""
    log = spark.range(4000).selectExpr("id % 2 AS k", "timestamp_seconds(id) AS seq", "id AS tie", "id div 7 AS v")
    segments = find_hot_keys(log, ["k"], ["seq", "tie"], 4).segments(log)
    sizes = [r["count"] for r in segments.groupBy(SLICE).count().collect()]
    assert len(sizes) >= 1000 and max(sizes) <= 4 and sum(sizes) == 4000
    assert len(segments.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = H.history_of_every_change(log, ["k"], "seq", ["tie"])
    sliced = H.history_of_every_change(log, ["k"], "seq", ["tie"], rows_per_slice=4)
    assert collect(sliced, whole.columns) == collect(whole, whole.columns)


def test_records_without_sequence_in_segments(spark):
    """The end of a version that such a record follows is not known, wherever segments end."""
    seq = "CASE WHEN id >= 40 THEN timestamp_seconds(id) END AS seq"
    log = spark.range(120).selectExpr("CAST(NULL AS INT) AS k", seq, "id AS tie", "id div 3 AS v")
    whole = H.history_of_tracked_columns(log, ["k"], "seq", ["v"], ["tie"])
    sliced = H.history_of_tracked_columns(log, ["k"], "seq", ["v"], ["tie"], rows_per_slice=7)
    assert collect(sliced, whole.columns) == collect(whole, whole.columns)


def test_invariants_and_views(spark):
    log = spark.createDataFrame(make_log(11, True), DDL)
    versions = H.history_of_tracked_columns(log, ["k"], "seq", ["name"], ["tie"])
    assert H.duplicate_keys(H.current(versions), ["k"]).count() == 0
    assert H.current(versions).count() == log.select("k").distinct().count()
    assert H.open_ended(versions).count() == H.current(versions).count()
    assert H.closed(versions).count() + H.current(versions).count() == versions.count()
    assert versions.filter(F.col(H.START) > F.col(H.END)).count() == 0
    with_sentinel = H.history_of_every_change(log, ["k"], "seq", ["tie"])
    ends = H.current(with_sentinel).select(F.col(H.END).cast("string")).distinct().collect()
    assert [r[0] for r in ends] == [H.FAR_FUTURE]


def test_sample_shape_golden(spark):
    """120 keys, 94 with one record, 22 with two, 4 with three; only points ever change."""
    rows = []
    for key in range(120):
        for n in range(3 if key < 4 else 2 if key < 26 else 1):
            rows.append((key, EPOCH + timedelta(days=n), n, "a", "x", n))
    log = spark.createDataFrame(rows[::-1], DDL)
    every = H.history_of_every_change(log, ["k"], "seq", ["tie"])
    assert (every.count(), H.current(every).count(), H.closed(every).count()) == (150, 120, 30)
    tracked = H.history_of_tracked_columns(log, ["k"], "seq", ["name", "city"], ["tie"], excluded=["seq"])
    assert (tracked.count(), H.current(tracked).count()) == (120, 120)
    # Untracked columns are updated in place: the open version shows the last value.
    assert tracked.filter("k = 0").select("points").first()[0] == 2
    assert tracked.filter("k = 0").select(H.START).first()[0] == EPOCH


def test_latest(spark):
    rows = make_log(2, True)
    got = H.latest(spark.createDataFrame(rows, DDL), ["k"], "seq", ["tie"])
    expected = {}
    for r in sorted(rows, key=lambda r: r[1:3]):
        expected[r[0]] = r
    assert sorted(tuple(r) for r in got.select("k", "tie").collect()) == sorted(
        (k, r[2]) for k, r in expected.items()
    )


@pytest.mark.parametrize("sentinel", [True, False])
def test_current_without_history(spark, sentinel):
    rows = make_log(5, True)
    rows += [(None, EPOCH, 1, "a", "x", 1), (None, None, 2, "b", "y", 2), (99, None, 0, "c", None, 3)]
    rows += [(98, EPOCH, 0, "d", None, 4)] * 3
    log = spark.createDataFrame(rows, DDL)
    whole = H.history_of_every_change(log, ["k"], "seq", ["tie"], sentinel=sentinel)
    got = H.current_of_every_change(log, ["k"], "seq", ["tie"], sentinel=sentinel)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in whole.schema]
    assert collect(got) == collect(H.current(whole))


def test_one_exchange_without_hot_keys(spark):
    log = spark.createDataFrame(make_log(1, False), DDL)
    versions = H.history_of_tracked_columns(log, ["k"], "seq", ["name"], ["tie"])
    plan = versions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_null_keys_are_cut_like_others(spark):
    log = spark.range(20_000).selectExpr("CASE WHEN id % 100 = 0 THEN 1 END AS k", "timestamp_seconds(id) AS seq", "id AS tie")
    hot = find_hot_keys(log, ["k"], ["seq", "tie"], 1000)
    assert hot is not None and [r["k"] for r in hot.values.collect()] == [None]
    sizes = [r["count"] for r in hot.segments(log).where("k IS NULL").groupBy(SLICE).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 4000 and sum(sizes) == 19_800
    assert hot.only(log).count() == 19_800 and hot.without(log).count() == 200
    versions = H.history_of_every_change(log, ["k"], "seq", ["tie"], rows_per_slice=1000)
    whole = H.history_of_every_change(log, ["k"], "seq", ["tie"])
    assert versions.exceptAll(whole).isEmpty() and versions.count() == 20_000
