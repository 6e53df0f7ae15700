"""Slowly changing dimensions: version history from change records, and views over it.

Records are ordered by their sequence column, never by arrival. ``tiebreak`` decides between equal
sequence values; (keys, sequence, tiebreak) must be unique for the result to be determined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.slices import (
    COPIES,
    ROWS_PER_SLICE,
    SLICE,
    find_hot_keys,
    join_by_keys,
    spread_copies,
)
from tidemark.session import materialize

START, END, CURRENT = "__START_AT", "__END_AT", "__is_current"
FAR_FUTURE = "9999-12-31 23:59:59"

_STARTED, _CHANGED, _FIRST, _CARRIED = "__started", "__changed", "__first", "__carried"
_NEXT, _NEXT_CHANGED, _LAST = "__next", "__next_changed", "__last"


def _close(versions: DataFrame, next_start: str, sentinel: bool) -> DataFrame:
    """Turn the start of the following version into the end and current columns.

    A version is current if no record follows it. A following record without a sequence value does follow; then
    the end is not known.
    """
    end = F.col(next_start)
    if sentinel:
        end = F.when(F.col(_LAST), F.lit(FAR_FUTURE).cast("timestamp")).otherwise(end)
    return versions.withColumns({END: end, CURRENT: F.col(_LAST)}).drop(next_start, _LAST)


def history_of_every_change(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tiebreak: Sequence[str] = (),
    *,
    sentinel: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """One version per change record, ending where the next record of the key starts.

    The open version ends at ``FAR_FUTURE``, or at NULL with ``sentinel=False``.
    """
    keys, order = list(keys), [sequence, *tiebreak]

    def follow(records: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        return records.withColumns(_followed(sequence, window))

    hot = find_hot_keys(log, keys, order, rows_per_slice)
    if hot is None:
        return _close(follow(log), _NEXT, sentinel)

    records = hot.segments(log)
    # One short row per segment of a hot key, stored so that Spark knows its size and joins accordingly.
    next_slice = materialize(
        records.groupBy(*keys, SLICE)
        .agg(F.min_by(F.struct(sequence), F.struct(*order)).alias(_FIRST))
        .withColumn(_FIRST, F.lead(_FIRST).over(Window.partitionBy(*keys).orderBy(SLICE))),
        "segment-heads",
    )
    in_slice = Window.partitionBy(*keys, SLICE).orderBy(*order)
    followed = (
        join_by_keys(records.withColumns(_followed(sequence, in_slice)), next_slice, [*keys, SLICE], "left")
        .withColumns(
            {
                _NEXT: F.when(F.col(_LAST), F.col(_FIRST)[sequence]).otherwise(F.col(_NEXT)),
                _LAST: F.col(_LAST) & F.col(_FIRST).isNull(),
            }
        )
        .drop(SLICE, _FIRST)
    )
    if hot.copies:
        # Of identical records, all but one end where they start.
        earlier = followed.filter(F.col(COPIES) > 1).withColumns(
            {COPIES: F.col(COPIES) - 1, _NEXT: F.col(sequence), _LAST: F.lit(False)}
        )
        followed = followed.drop(COPIES).unionByName(spread_copies(earlier))
    else:
        followed = followed.drop(COPIES)
    versions = follow(hot.without(log)).unionByName(followed)
    return _close(versions, _NEXT, sentinel)


def _followed(sequence: str, window) -> dict[str, Column]:
    """The start of each record, the start of the next one, and whether there is none."""
    return {
        START: F.col(sequence),
        _NEXT: F.lead(sequence).over(window),
        _LAST: F.lead(F.lit(True)).over(window).isNull(),
    }


def history_of_tracked_columns(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    tiebreak: Sequence[str] = (),
    *,
    excluded: Sequence[str] = (),
    ignore_nulls: bool = True,
    sentinel: bool = False,
    started_at: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """A new version only where a tracked column changes; other columns update the open version in place.

    With ``ignore_nulls`` a NULL in a change record keeps the value known so far. ``excluded`` columns take
    part in nothing but the ordering and are dropped from the result. ``started_at`` names a column with the
    start a record gives to a version it opens, when that is not its sequence value.
    """
    keys, order = list(keys), [sequence, *tiebreak]
    plan = _TrackedHistory(log, keys, order, list(tracked), list(excluded), ignore_nulls, started_at)
    hot = find_hot_keys(log, keys, order, rows_per_slice)
    if hot is None:
        versions = plan.whole_keys(log)
    else:
        # A record that repeats the one before it changes nothing, so its copies need not be kept.
        records = hot.segments(log).drop(COPIES)
        versions = plan.whole_keys(hot.without(log)).unionByName(plan.sliced_keys(records))
    return _close(versions.drop(*[c for c in excluded if c not in keys]), _NEXT, sentinel)


def _fill(log: DataFrame, window, columns: Sequence[str], carried: str | None = None) -> DataFrame:
    """Replace NULLs by the last known value in the window, or else by the carried one."""
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def value(column: str) -> Column:
        known = F.last(column, ignorenulls=True).over(running)
        return known if carried is None else F.coalesce(known, F.col(carried)[column])

    return log.withColumns({c: value(c) for c in columns}) if columns else log


def _state_before_slices(
    sliced: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    filled: Sequence[str],
) -> DataFrame:
    """Per (key, slice), a struct of the column values before the slice; NULL for the first slice of a key.

    A filled column carries its last known value, any other its last value. The aggregate combines on the
    map side and leaves one row per slice for the window.
    """
    columns = sorted({*tracked, *filled})
    at = F.struct(*order)

    def newest(column: str) -> Column:
        when = F.when(F.col(column).isNotNull(), at) if column in filled else at
        return F.max_by(F.struct(column), when).alias(column)

    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    state = F.struct(*[F.col(c)[c].alias(c) for c in columns])
    return (
        sliced.groupBy(*keys, SLICE)
        .agg(*[newest(c) for c in columns])
        .withColumns(
            {c: F.last(c, ignorenulls=True).over(earlier) for c in columns}
            | {"__position": F.row_number().over(by_slice)}
        )
        .select(*keys, SLICE, F.when(F.col("__position") > 1, state).alias(_CARRIED))
    )


class _TrackedHistory:
    """The window steps of tracked history, over whole keys or over slices of hot keys.

    A record is the last of its version when the next record of its key is a change or is missing. That
    record already carries the final, NULL-filled attributes, so keeping just those records is enough, and
    every step shares one partitioning and one sort.
    """

    def __init__(self, log, keys, order, tracked, excluded, ignore_nulls, started_at):
        technical = {*keys, *order, *excluded, started_at}
        self.keys, self.order, self.tracked = keys, order, tracked
        self.filled = [c for c in log.columns if c not in technical] if ignore_nulls else []
        self.start = started_at or order[0]
        self.output = [c for c in log.columns if c != started_at]

    def _state(self) -> Column:
        return F.struct(*self.tracked)

    def _mark(self, log: DataFrame, window, carried: str | None = None) -> DataFrame:
        """Fill NULLs, then flag the records whose tracked columns differ from the record before."""
        before = F.lag(self._state()).over(window)
        if carried is not None:
            # In a slice that continues a key, the first record follows the carried state.
            known = F.struct(*[F.col(carried)[c].alias(c) for c in self.tracked])
            before = F.coalesce(before, F.when(F.col(carried).isNotNull(), known))
        changed = ~self._state().eqNullSafe(before)
        return _fill(log, window, self.filled, carried).withColumn(_CHANGED, changed)

    def _follow(self, marked: DataFrame, window) -> DataFrame:
        """Start of the version of each record, and what comes after the record."""
        running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        opened = F.last(F.when(F.col(_CHANGED), F.col(self.start)), ignorenulls=True)
        return marked.withColumns(
            {
                _STARTED: opened.over(running),
                _NEXT: F.lead(self.order[0]).over(window),
                _NEXT_CHANGED: F.lead(_CHANGED).over(window),
            }
        )

    def _versions(self, followed: DataFrame) -> DataFrame:
        last = F.coalesce(F.col(_NEXT_CHANGED), F.lit(True))
        alone = F.col(_NEXT_CHANGED).isNull().alias(_LAST)
        return followed.filter(last).select(*self.output, F.col(_STARTED).alias(START), _NEXT, alone)

    def whole_keys(self, log: DataFrame) -> DataFrame:
        window = Window.partitionBy(*self.keys).orderBy(*self.order)
        return self._versions(self._follow(self._mark(log, window), window))

    def sliced_keys(self, log: DataFrame) -> DataFrame:
        """The same for records with a segment number, each segment a task of bounded size."""
        place = [*self.keys, SLICE]
        window = Window.partitionBy(*place).orderBy(*self.order)
        carried = _state_before_slices(log, self.keys, self.order, self.tracked, self.filled)
        marked = self._mark(join_by_keys(log, carried, place, "left"), window, _CARRIED).drop(_CARRIED)
        followed = self._follow(marked, window).withColumn(
            _FIRST, F.row_number().over(window) == 1
        )
        # Only records that can end a version, and the first of each slice, matter from here on.
        ending = F.coalesce(F.col(_NEXT_CHANGED), F.lit(True))
        edges = materialize(followed.filter(ending | F.col(_FIRST)), "slice-edges")

        # What neighbouring slices need to know of each other, one short row per slice.
        by_slice = Window.partitionBy(*self.keys).orderBy(SLICE)
        earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
        neighbours = materialize(
            edges.groupBy(*place)
            .agg(
                F.max(_STARTED).alias("__open"),
                F.max(F.when(F.col(_FIRST), F.col(self.order[0]))).alias("__head"),
                F.max(F.when(F.col(_FIRST), F.col(_CHANGED))).alias("__head_changed"),
            )
            .select(
                *place,
                F.last("__open", ignorenulls=True).over(earlier).alias("__open"),
                F.lead("__head").over(by_slice).alias("__head"),
                F.lead("__head_changed").over(by_slice).alias("__head_changed"),
            ),
            "segment-neighbours",
        )
        # A record with nothing after it in its slice is followed by the head of the next slice. A NULL in _NEXT alone
        # does not tell that, as the record after it may have no sequence value.
        joined = join_by_keys(edges, neighbours, place, "left").withColumns(
            {
                _STARTED: F.coalesce(_STARTED, "__open"),
                _NEXT_CHANGED: F.coalesce(_NEXT_CHANGED, "__head_changed"),
                _NEXT: F.when(F.col(_NEXT_CHANGED).isNull(), F.col("__head")).otherwise(F.col(_NEXT)),
            }
        )
        return self._versions(joined)


def latest(log: DataFrame, keys: Sequence[str], sequence: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest record of every key. Spark keeps one record per key and task before the shuffle."""
    newest_first = [F.col(c).desc() for c in (sequence, *tiebreak)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return log.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def fill_forward(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tiebreak: Sequence[str] = (),
    *,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Every change record with its NULLs replaced by the last known value of the key."""
    keys, order = list(keys), [sequence, *tiebreak]
    columns = [c for c in log.columns if c not in {*keys, *order}]
    whole = Window.partitionBy(*keys).orderBy(*order)
    hot = find_hot_keys(log, keys, order, rows_per_slice)
    if hot is None:
        return _fill(log, whole, columns)
    place = [*keys, SLICE]
    records = hot.segments(log)
    carried = _state_before_slices(records, keys, order, [], columns)
    in_slice = Window.partitionBy(*place).orderBy(*order)
    filled = _fill(join_by_keys(records, carried, place, "left"), in_slice, columns, _CARRIED)
    filled = filled.select(*log.columns, COPIES)
    filled = spread_copies(filled) if hot.copies else filled.drop(COPIES)
    return _fill(hot.without(log), whole, columns).unionByName(filled)


def current(history: DataFrame) -> DataFrame:
    """Open versions, whichever way their end is written."""
    return history.filter(F.col(CURRENT))


def current_of_every_change(
    log: DataFrame, keys: Sequence[str], sequence: str, tiebreak: Sequence[str] = (), *, sentinel: bool = True
) -> DataFrame:
    """The open versions of :func:`history_of_every_change`, without making the closed ones.

    Only one record per key and task is shuffled, so a hot key needs no care of its own.
    """
    end = F.lit(None).cast(log.schema[sequence].dataType)
    if sentinel:
        # The branch that is never taken gives the column the type that it has in the history.
        end = F.when(F.lit(True), F.lit(FAR_FUTURE).cast("timestamp")).otherwise(F.col(sequence))
    newest = latest(log, keys, sequence, tiebreak)
    return newest.withColumns({START: F.col(sequence), END: end, CURRENT: F.lit(True)})


def open_ended(history: DataFrame) -> DataFrame:
    """Open versions of a history whose open end is NULL."""
    return history.filter(F.col(END).isNull())


def closed(history: DataFrame) -> DataFrame:
    return history.filter(~F.col(CURRENT))


def duplicate_keys(current_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one current row; must be empty, or a lookup join would repeat facts."""
    return current_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
