"""Exact totals over DOUBLE amounts.

Summing doubles gives a result that depends on the order of the rows, so it changes from run to run on a
cluster. Summing them as decimals is exact but several times slower, as Spark then computes with objects.
Here whole units, ten-thousandths, and hundred-millionths of what is left are summed as three 64-bit integers,
which is exact and about as fast as the sum of doubles. An amount is rounded to a hundred-millionth, far finer
than prices, so that the noise of a double does not decide how a total is rounded.

Amounts without such a form (NaN, infinities, beyond 10^15), or so many near that bound that a 64-bit sum would
overflow, make a rounded total or average that of the plain doubles. Totals that are summed up again later carry
the plain sum and a count of odd amounts along, so that a total of totals tells the same as a total of the amounts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LARGEST = "1e15D"


def _parts(amount: str) -> tuple[str, str, str]:
    fine = f"({amount} - floor({amount})) * 10000"
    return f"floor({amount})", f"rint({fine})", f"rint(({fine} - rint({fine})) * 10000)"


def total_sql(amount: str) -> str:
    """The exact sum of DOUBLE amounts, as DECIMAL with eight digits after the point; NULL if it doesn't fit."""
    whole, coarse, fine = (f"CAST(try_sum(CAST({part} AS BIGINT)) AS DECIMAL(20, 0))" for part in _parts(amount))
    return f"(CAST({whole} AS DECIMAL(28, 8)) + {coarse} * 0.0001BD + {fine} * 0.00000001BD)"


def _usual(column: str) -> str:
    return f"(CASE WHEN abs({column}) <= {_LARGEST} THEN {column} END)"


def _odd_sql(column: str) -> str:
    """How many amounts have no decimal form; one if the sum of those that have doesn't fit."""
    unfit = f"count_if(abs({column}) <= {_LARGEST}) > 0 AND {total_sql(_usual(column))} IS NULL"
    return f"count_if(isnan({column}) OR abs({column}) > {_LARGEST}) + CASE WHEN {unfit} THEN 1 ELSE 0 END"


def _or_plain(column: str, exact: str, plain: str) -> str:
    """``exact`` over the amounts that have a decimal form, unless there is one that has none."""
    return f"CASE WHEN {_odd_sql(column)} > 0 THEN {plain} ELSE CAST({exact} AS DOUBLE) END"


def rounded_sum_sql(column: str) -> str:
    return _or_plain(column, f"round({total_sql(_usual(column))}, 2)", f"round(sum({column}), 2)")


def rounded_avg_sql(column: str) -> str:
    mean = f"round({total_sql(_usual(column))} / count({column}), 2)"
    return _or_plain(column, mean, f"round(avg({column}), 2)")


def rounded_sum(column: str) -> Column:
    return F.expr(rounded_sum_sql(column))


def rounded_avg(column: str) -> Column:
    return F.expr(rounded_avg_sql(column))


def guarded_total(column: str, name: str) -> list[Column]:
    """Aggregates from which :func:`summed` and :func:`averaged` make totals of totals, named after ``name``."""
    return [
        F.expr(total_sql(_usual(column))).alias(name),
        F.sum(column).alias(f"{name}_plain"),
        F.expr(_odd_sql(column)).alias(f"{name}_odd"),
        F.count(column).alias(f"{name}_lines"),
    ]


def _guarded(name: str, exact: Column, plain: Column) -> Column:
    unfit = (F.sum(f"{name}_lines") > 0) & F.try_sum(name).isNull()
    return F.when((F.sum(f"{name}_odd") > 0) | unfit, F.round(plain, 2)).otherwise(F.round(exact, 2).cast("double"))


def summed(name: str) -> Column:
    """The rounded total of the totals that :func:`guarded_total` made."""
    return _guarded(name, F.try_sum(name), F.sum(f"{name}_plain"))


def averaged(name: str) -> Column:
    """The rounded average of the amounts under those totals."""
    lines = F.sum(f"{name}_lines")
    # Without amounts there is no average, and nothing to divide by.
    some = F.when(lines > 0, lines)
    return _guarded(name, F.try_sum(name) / some, F.sum(f"{name}_plain") / some)


def total(column: str) -> Column:
    """The total as a double: that of the decimal forms where all amounts have one, else that of the doubles."""
    return F.expr(_or_plain(column, total_sql(_usual(column)), f"sum({column})"))
