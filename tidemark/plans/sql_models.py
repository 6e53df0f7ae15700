"""The batch pipeline as plain Spark SQL over the bronze tables, for SQL-first users.

The texts are made from the schemas, rule sets and lookups of the model. They name tables by layer, as in
``{silver_stores}``, so that they run over stored tables or over temporary views. An aggregate groups by the key of
its dimension, and looks names up for the finished rows, so a text reads no dimension that it shows nothing of, and only
models that are asked for are built. Tables are written by overwriting, since Parquet tables in the session catalog
cannot be replaced by CREATE OR REPLACE.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import rounded_avg_sql, rounded_sum_sql
from tidemark.model import BATCH_RULES, DIMENSIONS, FACT_COLUMNS, LOOKUPS, SCHEMAS, columns_of
from tidemark.operators.history import history_of_every_change
from tidemark.operators.quality import Rule
from tidemark.sources.tables import create_layers, create_view, overwrite_table

RAW_TABLES = tuple(SCHEMAS)
# The rules in front of each history; those of customers and products are the first of their sets.
_RECORD_RULES = {
    "customers": BATCH_RULES["customers"][:2],
    "products": BATCH_RULES["products"][:1],
    "stores": BATCH_RULES["stores"],
}
_SALES = "{silver_sales_transactions}"


def _where(rules: Sequence[Rule]) -> str:
    return " AND ".join(f"({rule.condition})" for rule in rules)


def _typed(source: str, rules: Sequence[Rule]) -> str:
    columns = [f"CAST({name} AS {kind}) AS {name}" for name, kind in columns_of(SCHEMAS[source]).items()]
    return f"SELECT {', '.join(columns)} FROM {{bronze_{source}}} WHERE {_where(rules)}"


def _names_of(dimension: str) -> str:
    """The current rows of a dimension with the columns that facts look up."""
    key, columns = LOOKUPS[dimension]
    looked_up = ", ".join(f"{old} AS {new}" for new, old in columns.items())
    return f"(SELECT {key}, {looked_up} FROM {{silver_{dimension}}} WHERE __is_current)"


def _facts() -> str:
    joins = " ".join(f"LEFT JOIN {_names_of(name)} USING ({key})" for name, (key, _) in LOOKUPS.items())
    return f"SELECT {', '.join(FACT_COLUMNS)} FROM {_SALES} {joins}"


def _by(dimension: str, measures: Mapping[str, str], grain: Mapping[str, str] | None = None) -> str:
    """Measures per key of a dimension, and per ``grain``, with the dimension's names."""
    key, names = LOOKUPS[dimension]
    groups = {**(grain or {}), key: key}
    shown = ", ".join([*groups, *names, *measures])
    columns = ", ".join(f"{text} AS {name}" for name, text in {**groups, **measures}.items())
    totals = f"SELECT {columns} FROM {_SALES} GROUP BY {', '.join(groups.values())}"
    return f"SELECT {shown} FROM ({totals}) LEFT JOIN {_names_of(dimension)} USING ({key})"


_REVENUE, _MEAN = rounded_sum_sql("total_amount"), rounded_avg_sql("total_amount")
# Dimension records as SQL; a version per record is made of them by the history operator, because a window
# in the text would leave all records of one key to one task.
HISTORIES = {f"silver.{name}": _typed(name, _RECORD_RULES[name]) for name in DIMENSIONS}
TABLES = {
    "silver.sales_transactions": _typed("sales", BATCH_RULES["sales"]),
    "gold.sales_facts": _facts(),
    "gold.daily_sales_by_store": _by(
        "stores",
        {
            "total_revenue": _REVENUE,
            "total_transactions": "count(transaction_id)",
            "total_items_sold": "sum(quantity)",
            "unique_customers": "count(DISTINCT customer_id)",
        },
        {"sale_date": "CAST(event_time AS DATE)"},
    ),
    "gold.product_performance": _by(
        "products",
        {"total_revenue": _REVENUE, "total_quantity_sold": "sum(quantity)", "total_orders": "count(transaction_id)"},
    ),
    "gold.customer_lifetime_value": _by(
        "customers",
        {
            "total_spend": _REVENUE,
            "total_orders": "count(DISTINCT transaction_id)",
            "first_purchase_date": "CAST(min(event_time) AS DATE)",
            "last_purchase_date": "CAST(max(event_time) AS DATE)",
            "avg_order_value": _MEAN,
        },
    ),
}


def _placeholder(name: str) -> str:
    return name.replace(".", "_")


def _needed(wanted: Iterable[str]) -> list[str]:
    """The wanted models and those that their texts read, in dependency order."""
    texts = HISTORIES | TABLES
    by_placeholder = {_placeholder(name): name for name in texts}
    found: dict[str, None] = {}

    def visit(name: str) -> None:
        for _, field, _, _ in Formatter().parse(texts[name]):
            if field in by_placeholder:
                visit(by_placeholder[field])
        found.setdefault(name)

    for name in wanted:
        visit(name)
    return list(found)


def _models(
    spark: SparkSession, names: Mapping[str, str], store: Callable[[DataFrame, str], DataFrame], wanted: Iterable[str]
) -> dict[str, DataFrame]:
    models = {}
    for name in _needed(wanted):
        if name in TABLES:
            models[name] = store(spark.sql(TABLES[name].format(**names)), name)
            continue
        dimension = DIMENSIONS[name.removeprefix("silver.")]
        records = spark.sql(HISTORIES[name].format(**names))
        tied = records.withColumn("__tie", F.xxhash64(*records.columns))
        versions = history_of_every_change(tied, dimension.keys, dimension.sequence, ["__tie"]).drop("__tie")
        models[name] = store(versions, name)
    return models


def build(spark: SparkSession, prefix: str = "") -> dict[str, DataFrame]:
    """Write every table and the views of current rows; the bronze tables must be there."""
    create_layers(spark, prefix)
    names = {f"bronze_{raw}": f"{prefix}bronze.raw_{raw}" for raw in RAW_TABLES}
    names |= {_placeholder(name): f"{prefix}{name}" for name in (*HISTORIES, *TABLES)}
    models = _models(
        spark, names, lambda model, name: overwrite_table(model, f"{prefix}{name}"), [*HISTORIES, *TABLES]
    )
    for name in HISTORIES:
        query = f"SELECT * FROM {prefix}{name} WHERE __is_current = TRUE"
        create_view(spark, f"{prefix}{name}_current", query)
    return models


def over_frames(spark: SparkSession, bronze: Mapping[str, DataFrame], wanted: str) -> DataFrame:
    """One model over the given bronze frames; no table is written, and no view stays in the session."""
    label = f"tidemark_{uuid.uuid4().hex}"
    names = {f"bronze_{raw}": f"{label}_bronze_{raw}" for raw in RAW_TABLES}
    names |= {_placeholder(name): f"{label}_{_placeholder(name)}" for name in (*HISTORIES, *TABLES)}
    views = []

    def store(frame: DataFrame, name: str) -> DataFrame:
        view = names[_placeholder(name)]
        frame.createOrReplaceTempView(view)
        views.append(view)
        return frame

    try:
        for raw, frame in bronze.items():
            store(frame, f"bronze.{raw}")
        return _models(spark, names, store, [wanted])[wanted]
    finally:
        # The plan holds what the views stood for.
        for view in views:
            spark.catalog.dropTempView(view)
