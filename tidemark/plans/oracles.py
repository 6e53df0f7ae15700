"""The expected result of every report as ANSI SQL over the same tables."""

from __future__ import annotations

from tidemark.model import BATCH_RULES, BRONZE_RULES, CLEANED_RULES, SALES_DDL, TRANSACTION_RULES
from tidemark.plans.star import sql_views

_BIG = "CAST({} AS BIGINT)"
_MONEY = "CAST(ROUND(SUM(CAST({} AS DECIMAL(28, 8))), 2) AS DOUBLE)"
# Exact average of positive cents, half up.
_MONEY_AVG = (
    "((2 * CAST(SUM(CAST({0} AS DECIMAL(20, 2))) * 100 AS HUGEINT) + COUNT({0})) // (2 * COUNT({0}))) / 100.0"
)


def _all(rules) -> str:
    return " AND ".join(f"({rule.condition})" for rule in rules)


def _drops(rules) -> str:
    return _all([rule for rule in rules if rule.action == "drop"])


def _select(source: str, rules) -> str:
    return f"SELECT * FROM {source} WHERE {rules}"


_VALID = _drops(TRANSACTION_RULES)
_STORES = (
    "SELECT store_id, name, coalesce(manager, 'Unknown') AS manager, status FROM stores"
)
_STORE_TOTALS = f"""
    {_MONEY.format("total_amount")} AS total_revenue,
    COUNT(transaction_id) AS total_transactions,
    {_BIG.format("SUM(quantity)")} AS total_items_sold,
    COUNT(DISTINCT customer_id) AS unique_customers
"""
_PRODUCT_TOTALS = f"""
    {_MONEY.format("total_amount")} AS total_revenue,
    {_BIG.format("SUM(quantity)")} AS total_quantity_sold,
    COUNT(transaction_id) AS total_orders
"""
_CUSTOMER_TOTALS = f"""
    {_MONEY.format("total_amount")} AS total_spend,
    COUNT(DISTINCT transaction_id) AS total_orders,
    CAST(MIN(event_time) AS DATE) AS first_purchase_date,
    CAST(MAX(event_time) AS DATE) AS last_purchase_date,
    {_MONEY_AVG.format("total_amount")} AS avg_order_value
"""
_FAR_FUTURE = "TIMESTAMP '9999-12-31 23:59:59'"


def _facts(sales: str, customers: str = "customers") -> str:
    return f"""
        SELECT s.transaction_id, s.event_time, s.customer_id, c.name AS customer_name, s.product_id,
               p.name AS product_name, p.category AS product_category, s.store_id, t.name AS store_name,
               s.quantity, s.unit_price, s.total_amount, s.payment_method, s.discount_applied, s.tax_amount
        FROM {sales} s
        LEFT JOIN stores t ON s.store_id = t.store_id
        LEFT JOIN {customers} c ON s.customer_id = c.customer_id
        LEFT JOIN products p ON s.product_id = p.product_id
    """


def _metrics(dataset: str, source: str, rules) -> list[str]:
    return [
        f"SELECT '{dataset}' AS dataset, '{r.name}' AS rule, '{r.action}' AS action, COUNT(*) AS n_rows,"
        f" COUNT(*) FILTER (WHERE NOT coalesce({r.condition}, FALSE)) AS n_violations FROM {source}"
        for r in rules
    ]


def _tracked(source: str, key: str, tie: str, tracked: str, others: list[str], keep: list[str],
             ignore_nulls: bool = True) -> str:
    """Versions by run-length grouping, a different construction from the one under test."""

    def fill(column: str) -> str:
        if not ignore_nulls:
            return column
        return (
            f"last_value({column} IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY changed_at, {tie}"
            f" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {column}"
        )

    columns = [tracked, *others]
    order = f"PARTITION BY {key} ORDER BY changed_at, {tie}"
    last = ", ".join(f"last({c} ORDER BY pos) AS {c}" for c in columns)
    kept = "".join(f", max({c}) AS {c}" for c in keep)
    return f"""
        SELECT * EXCLUDE (version), lead(__START_AT) OVER (PARTITION BY {key} ORDER BY version) AS __END_AT,
               lead(__START_AT) OVER (PARTITION BY {key} ORDER BY version) IS NULL AS __is_current
        FROM (
            SELECT {key}, version, {last}{kept}, min(changed_at) AS __START_AT
            FROM (
                SELECT *, sum(changed) OVER ({order}) AS version, row_number() OVER ({order}) AS pos
                FROM (
                    SELECT *, CASE WHEN row_number() OVER ({order}) = 1
                        OR {tracked} IS DISTINCT FROM lag({tracked}) OVER ({order}) THEN 1 ELSE 0 END AS changed
                    FROM (SELECT {key}, changed_at, {tie}, {", ".join(fill(c) for c in columns)} FROM {source})
                )
            )
            GROUP BY {key}, version
        )
    """


def _every_change(source: str, key: str, tie: str, sentinel: bool, seq: str = "changed_at") -> str:
    following = f"lead({seq}) OVER (PARTITION BY {key} ORDER BY {seq}, {tie})"
    end = f"coalesce({following}, {_FAR_FUTURE})" if sentinel else following
    return (
        f"SELECT *, {seq} AS __START_AT, {end} AS __END_AT, {following} IS NULL AS __is_current FROM {source}"
    )


# Change records of which some have no time; those come first.
_NO_TIMES = (
    "(SELECT * REPLACE (CASE WHEN last_total IS NULL THEN NULL ELSE changed_at END AS changed_at)"
    " FROM customer_changes)"
)
_NULLS_FIRST = "PARTITION BY customer_id ORDER BY changed_at NULLS FIRST, change_id"
_LAST_RECORD = f"lead(change_id) OVER ({_NULLS_FIRST}) IS NULL"
_EVERY = _every_change("customer_changes", "customer_id", "change_id", True)
_TRACKED = _tracked("customer_changes", "customer_id", "change_id", "status", ["last_total"], [])
_SALES_TYPES = {
    part.split()[0]: part.split()[1] for part in SALES_DDL.replace("\n", " ").split(",")
}
_RECORDS = {"sales": "raw_sales", "customers": "customer_records", "products": "products", "stores": "known_stores"}
_BATCH_VALID = _all(BATCH_RULES["sales"])


def oracle_sql() -> dict[str, str]:
    named_stores = "known_stores"
    sql = {
        "typed_sales": "SELECT "
        + ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in _SALES_TYPES.items())
        + " FROM raw_sales",
        "customers_cleaned": _select("customers", _drops(CLEANED_RULES["customers"])),
        "products_cleaned": _select("products", _drops(CLEANED_RULES["products"])),
        "stores_default_manager": _select(named_stores, _drops(CLEANED_RULES["stores"])),
        "sales_valid": _select("sales", "TRUE"),
        "returns_valid": "SELECT * EXCLUDE (quantity, total_amount), CAST(event_time AS DATE) AS date,"
        " abs(quantity) AS returned_quantity, abs(total_amount) AS returned_amount"
        f" FROM raw_sales WHERE quantity < 0 AND {_VALID}",
        "sales_valid_batch_rules": _select("raw_sales", _BATCH_VALID),
        "customers_valid_batch_rules": _select("customers", _all(BATCH_RULES["customers"])),
        "products_valid_batch_rules": _select("products", _all(BATCH_RULES["products"])),
        "rule_null_semantics": _select("customers", _all(CLEANED_RULES["customers"])),
        "metrics_per_rule": " UNION ALL ".join(
            _metrics("customers_cleaned", "customers", CLEANED_RULES["customers"])
            + _metrics("products_cleaned", "products", CLEANED_RULES["products"])
            + _metrics("stores_cleaned", named_stores, CLEANED_RULES["stores"])
            + _metrics("sales_cleaned", "raw_sales", CLEANED_RULES["sales"])
            + _metrics("sales", "(SELECT * FROM raw_sales WHERE quantity > 0)", TRANSACTION_RULES)
            + _metrics("returns", "(SELECT * FROM raw_sales WHERE quantity < 0)", TRANSACTION_RULES)
        ),
        "typed_wide_ids": "SELECT "
        + ", ".join(
            f"CAST({c} + 3000000000 AS BIGINT) AS {c}" if c.endswith("_id") else f"CAST({c} AS {t}) AS {c}"
            for c, t in _SALES_TYPES.items()
        )
        + " FROM raw_sales",
        "cast_failures": "SELECT c.name AS column, (SELECT count(*) FROM raw_sales) AS n_rows,"
        " CASE WHEN c.name = 'quantity' THEN (SELECT count(*) FROM raw_sales WHERE discount_applied < 0)"
        f" ELSE 0 END AS n_failed FROM (SELECT unnest({list(_SALES_TYPES)}) AS name) c",
        "sum_fine_amounts": f"SELECT store_id, {_MONEY.format('unit_price')} AS total FROM line_sales GROUP BY 1",
        "lineage": "SELECT 'lineitem.parquet' AS file, count(*) AS n_rows, count(*) AS n_timed FROM lineitem",
        "fail_rule_on_clean_rows": "SELECT payment_method, count(*) AS n FROM raw_sales GROUP BY 1",
        "sql_by_path": "SELECT 'orders' AS check, count(*) AS n FROM orders UNION ALL"
        " SELECT 'orders without a customer', count(*) FROM orders"
        " WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)",
        "scd2_hot_keys": _every_change("user_changes", "event_type", "event_id", True),
        "scd2_null_hot_key": _tracked(
            "(SELECT * REPLACE (CASE WHEN event_type = 'signup' THEN user_id END AS user_id) FROM user_changes)",
            "user_id", "event_id", "event_type", ["value"], []),
        "stored_tables": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS record_count FROM ({text})"
            for name, text in {
                "silver.sales_transactions": f"SELECT 1 FROM raw_sales WHERE {_BATCH_VALID}",
                "gold.sales_facts": "SELECT 1 FROM batch_facts",
                "gold.daily_sales_by_store": "SELECT DISTINCT CAST(event_time AS DATE), store_id, store_name"
                " FROM batch_facts",
                "gold.product_performance": "SELECT DISTINCT product_id, product_name, product_category"
                " FROM batch_facts",
                "gold.customer_lifetime_value": "SELECT DISTINCT customer_id, customer_name FROM batch_facts",
                "silver.customers_current": "SELECT 1 FROM adults",
                "bronze.late_sales": "SELECT 1 FROM raw_sales WHERE FALSE",
            }.items()
        ),
        "scd2_every_change": _EVERY,
        "scd2_null_sequence": f"SELECT *, changed_at AS __START_AT, CASE WHEN {_LAST_RECORD} THEN {_FAR_FUTURE}"
        f" ELSE lead(changed_at) OVER ({_NULLS_FIRST}) END AS __END_AT, {_LAST_RECORD} AS __is_current"
        f" FROM {_NO_TIMES}",
        "scd2_tracked_null_sequence": "SELECT customer_id, CAST(sum(changed) AS BIGINT) AS n_versions,"
        " CAST(1 AS BIGINT) AS n_current FROM (SELECT customer_id, CASE WHEN"
        f" row_number() OVER ({_NULLS_FIRST}) = 1 OR status IS DISTINCT FROM lag(status) OVER ({_NULLS_FIRST})"
        " THEN 1 ELSE 0 END AS changed FROM (SELECT customer_id, changed_at, change_id,"
        f" last_value(status IGNORE NULLS) OVER ({_NULLS_FIRST} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        f" AS status FROM {_NO_TIMES})) GROUP BY 1",
        "scd2_tracked": _TRACKED,
        "scd2_keep_nulls": "SELECT * REPLACE (coalesce(__END_AT, " + _FAR_FUTURE + ") AS __END_AT) FROM ("
        + _tracked("customer_changes", "customer_id", "change_id", "status", ["last_total"],
                   ["changed_at"], ignore_nulls=False) + ")",
        "scd2_ignore_nulls": "SELECT customer_id, changed_at, change_id, "
        + ", ".join(
            f"last_value({c} IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY changed_at, change_id"
            f" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
            for c in ("status", "last_total")
        )
        + " FROM customer_changes",
        "dim_current": f"SELECT * FROM ({_EVERY}) WHERE __is_current",
        "dim_current_open_end": f"SELECT * FROM ({_TRACKED}) WHERE __END_AT IS NULL",
        "dim_history": f"SELECT * FROM ({_TRACKED}) WHERE NOT __is_current",
        "dim_latest": "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id"
        " ORDER BY changed_at DESC, change_id DESC) AS r FROM customer_changes) WHERE r = 1",
        "dim_duplicate_keys": "SELECT customer_id, COUNT(*) AS n FROM customer_changes GROUP BY ALL"
        " HAVING COUNT(*) > 1",
        "enriched_facts": "SELECT * FROM facts",
        "daily_store_sales": f"SELECT CAST(event_time AS DATE) AS sale_date, store_id, store_name,"
        f" {_STORE_TOTALS} FROM facts GROUP BY 1, 2, 3",
        "daily_store_sales_window": f"SELECT CAST(event_time AS DATE) AS sale_date, store_id, store_name,"
        f" {_STORE_TOTALS} FROM facts GROUP BY 1, 2, 3",
        "daily_store_sales_trunc": "SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS sale_date,"
        f" store_id, store_name, {_STORE_TOTALS} FROM facts GROUP BY 1, 2, 3",
        "product_performance": "SELECT product_id, product_name, product_category,"
        f" {_PRODUCT_TOTALS} FROM facts GROUP BY 1, 2, 3",
        "product_performance_maxcat": "SELECT product_id, product_name,"
        f" MAX(product_category) AS product_category, {_PRODUCT_TOTALS} FROM facts GROUP BY 1, 2",
        "customer_value": f"SELECT customer_id, customer_name, {_CUSTOMER_TOTALS} FROM facts GROUP BY 1, 2",
        "sql_customer_history": _every_change(
            "(SELECT * FROM customer_records WHERE age BETWEEN 18 AND 100)", "customer_id", "customer_id",
            True, "last_update_time",
        ),
        "sql_daily_store_sales": f"SELECT CAST(event_time AS DATE) AS sale_date, store_id, store_name,"
        f" {_STORE_TOTALS} FROM batch_facts GROUP BY 1, 2, 3",
        "sql_product_performance": "SELECT product_id, product_name, product_category,"
        f" {_PRODUCT_TOTALS} FROM batch_facts GROUP BY 1, 2, 3",
        "sql_customer_value": f"SELECT customer_id, customer_name, {_CUSTOMER_TOTALS} FROM batch_facts"
        " GROUP BY 1, 2",
        "missing_foreign_keys": " UNION ALL ".join(
            f"SELECT '{key}' AS missing_key, transaction_id FROM raw_sales s"
            f" WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = s.{key})"
            for key, dim in (("customer_id", "customers"), ("product_id", "products"), ("store_id", "stores"))
        ),
        "health_check": " UNION ".join(
            [
                f"SELECT '{label}' AS table_name, COUNT(*) AS record_count FROM {table}"
                for label, table in (
                    ("sales_count", "raw_sales"),
                    ("customers_count", "customers"),
                    ("items_count", "products"),
                    ("stores_count", "stores"),
                )
            ]
            + [
                f"SELECT '{label}', COUNT(*) FROM raw_sales s"
                f" WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = s.{key})"
                for label, dim, key in (
                    ("missing_customers", "customers", "customer_id"),
                    ("missing_products", "products", "product_id"),
                    ("missing_stores", "stores", "store_id"),
                )
            ]
        ),
        "reconcile_counts": " UNION ALL ".join(
            f"SELECT '{label}' AS label, CAST(({actual}) AS BIGINT) AS actual, '{op}' AS comparison,"
            f" CAST(({expected}) AS BIGINT) AS expected, ({actual}) {op} ({expected}) AS passed"
            for label, actual, op, expected in (
                ("versions_equal_changes", "SELECT COUNT(*) FROM customer_changes", "=",
                 "SELECT COUNT(*) FROM customer_changes"),
                ("one_current_row_per_key", "SELECT COUNT(DISTINCT customer_id) FROM customer_changes", "=",
                 "SELECT COUNT(DISTINCT customer_id) FROM customer_changes"),
                ("facts_equal_sales", "SELECT COUNT(*) FROM facts", "=", "SELECT COUNT(*) FROM sales"),
                ("at_least_a_hundred_sales", "SELECT COUNT(*) FROM sales", ">=", "SELECT 100"),
                ("as_many_stores_as_products", "SELECT COUNT(*) FROM stores", "=",
                 "SELECT COUNT(*) FROM products"),
            )
        ),
        "reconcile_metrics": " UNION ALL ".join(
            f"SELECT '{label}' AS label, CAST(({actual}) AS BIGINT) AS actual, '{op}' AS comparison,"
            f" CAST(({expected}) AS BIGINT) AS expected, ({actual}) {op} ({expected}) AS passed"
            for label, actual, op, expected in (
                ("total_revenue", "SELECT ROUND(SUM(CAST(total_amount AS DECIMAL(28, 8)))) FROM facts", "=",
                 "SELECT ROUND(SUM(CAST(total_amount AS DECIMAL(28, 8)))) FROM sales"),
                ("customers_with_sales", "SELECT COUNT(DISTINCT customer_id) FROM facts", "=",
                 "SELECT COUNT(DISTINCT customer_id) FROM sales"),
                ("history_rows", f"SELECT COUNT(*) FROM ({_TRACKED}) WHERE NOT __is_current", ">=", "SELECT 1"),
            )
        ),
        "key_inventory": " UNION ALL ".join(
            f"SELECT DISTINCT '{dim}' AS table_name, CAST({key} AS BIGINT) AS key FROM {dim}"
            for dim, key in (("customers", "customer_id"), ("products", "product_id"), ("stores", "store_id"))
        ),
        "high_water_mark": "SELECT CAST(coalesce(MAX(l_orderkey), 0) AS BIGINT) AS high_water_mark FROM lineitem",
        # A day is complete once an event ten minutes past its end has been seen.
        "stream_daily_events": "SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n,"
        " CAST(SUM(CAST(value AS DECIMAL(28, 8))) AS DOUBLE) AS total FROM events GROUP BY 1, 2"
        " HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY"
        " <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE",
        "stream_scd2": _tracked("user_changes", "user_id", "event_id", "event_type", ["value"], ["changed_at"]),
        "stream_scd2_every_change": "SELECT * EXCLUDE (event_id) FROM ("
        + _every_change("user_changes", "user_id", "event_id", False) + ")",
        "stream_split": "SELECT CASE WHEN quantity > 0 THEN 'sale' ELSE 'return' END AS kind, transaction_id,"
        " CAST(event_time AS DATE) AS date, abs(quantity) AS n, abs(total_amount) AS amount"
        f" FROM web_sales WHERE quantity <> 0 AND {_VALID}",
        "stream_enriched_facts": "SELECT *, CAST(event_time AS DATE) AS sale_date FROM web_facts",
        "stream_facts_repaired": "SELECT *, CAST(event_time AS DATE) AS sale_date FROM web_facts",
        "stream_latest": "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id"
        " ORDER BY changed_at DESC, change_id DESC) AS r FROM customer_changes) WHERE r = 1",
        # Rows of the first week that come last are late, as are all days that an event of a later day has closed.
        "stream_daily_store_sales": "SELECT CAST(event_time AS DATE) AS sale_date, store_id,"
        f" {_STORE_TOTALS.replace('total_amount', 'amount').replace('(transaction_id', '(counted')}, count(*) - count(counted) AS n_late FROM"
        " (SELECT event_time, store_id, CASE WHEN on_time THEN transaction_id END AS counted, CASE WHEN on_time THEN"
        " total_amount END AS amount, CASE WHEN on_time THEN quantity END AS quantity, CASE WHEN on_time THEN customer_id END"
        " AS customer_id FROM (SELECT *, NOT (day(event_time) <= 7 AND transaction_id % 10 = 0) AS on_time FROM web_sales))"
        " GROUP BY 1, 2 HAVING CAST(CAST(event_time AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY"
        " <= (SELECT MAX(event_time) FROM web_sales) - INTERVAL 10 MINUTE",
        "stream_rule_metrics": " UNION ALL ".join(_metrics("web_sales", "web_sales", TRANSACTION_RULES)),
        "stream_rule_metrics_many_batches": " UNION ALL ".join(
            _metrics("web_sales", "web_sales", TRANSACTION_RULES)
        ),
        "csv_ingest": "SELECT 'good' AS line, transaction_id, event_time, customer_id,"
        " CAST(quantity AS BIGINT) AS quantity, total_amount, payment_method FROM raw_sales"
        " WHERE NOT coalesce(discount_applied < 0, FALSE)"
        " UNION ALL SELECT 'malformed', transaction_id, NULL, NULL, NULL, NULL, NULL FROM raw_sales"
        " WHERE discount_applied < 0",
        "csv_by_header": "SELECT "
        + ", ".join(
            "CASE WHEN transaction_id % 3 <> 2 THEN tax_amount END AS tax_amount" if c == "tax_amount"
            else f"CAST({c} AS {t}) AS {c}" for c, t in _SALES_TYPES.items()
        )
        + " FROM raw_sales WHERE transaction_id % 7 > 0 UNION ALL SELECT "
        + ", ".join(
            {"transaction_id": "count(*)", "payment_method": "'store_id,payment_method'"}.get(c, f"CAST(NULL AS {t})")
            for c, t in _SALES_TYPES.items()
        )
        + " FROM raw_sales WHERE transaction_id % 7 = 0",
        "csv_pipeline_daily_sales": f"SELECT CAST(event_time AS DATE) AS sale_date, store_id, store_name,"
        f" {_STORE_TOTALS} FROM web_facts GROUP BY 1, 2, 3",
        "ingest_rejects": "SELECT transaction_id, 'quantity' AS column, 'several' AS text FROM raw_sales"
        " WHERE discount_applied < 0 UNION ALL SELECT CASE WHEN c.name = 'quantity' THEN"
        " (SELECT count(*) FROM raw_sales WHERE discount_applied < 0) ELSE 0 END, c.name, NULL"
        f" FROM (SELECT unnest({list(_SALES_TYPES)}) AS name) c",
        "metrics_all_rules": " UNION ALL ".join(
            [line for name, source in _RECORDS.items()
             for line in _metrics(f"bronze_{name}", source, BRONZE_RULES[name])]
            + [line for name, source in _RECORDS.items() for line in _metrics(f"{name}_cleaned", source, CLEANED_RULES[name])]
            + _metrics("sales_transactions", "(SELECT * FROM raw_sales WHERE quantity > 0)", TRANSACTION_RULES)
            + _metrics("returns_transactions", "(SELECT * FROM raw_sales WHERE quantity < 0)", TRANSACTION_RULES)
        ),
        "refresh_daily": f"SELECT CAST(event_time AS DATE) AS sale_date, store_id, store_name,"
        f" {_STORE_TOTALS} FROM web_facts GROUP BY 1, 2, 3",
        "refresh_null_day": f"SELECT CAST(event_time AS DATE) AS sale_date, store_id, store_name, {_STORE_TOTALS}"
        " FROM (SELECT * REPLACE (CASE WHEN unit_price < 20 THEN NULL ELSE event_time END AS event_time)"
        " FROM web_facts) GROUP BY 1, 2, 3",
        "refresh_products": "SELECT product_id, product_name, product_category,"
        f" {_PRODUCT_TOTALS} FROM web_facts GROUP BY 1, 2, 3",
        "refresh_products_maxcat": "SELECT product_id, product_name,"
        f" MAX(product_category) AS product_category, {_PRODUCT_TOTALS} FROM web_facts GROUP BY 1, 2",
        "refresh_odd_amounts": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, key, CASE WHEN NOT odd THEN total END AS total, odd FROM (SELECT {key} AS key,"
            f" count(*) FILTER (transaction_id % 97 = 0 OR transaction_id % 89 = 0) > 0 AS odd, {total} AS total"
            f" FROM web_facts GROUP BY {groups})"
            for name, key, total, groups in (
                ("daily", "concat(CAST(event_time AS DATE), ' ', store_id)", _MONEY.format("total_amount"),
                 "CAST(event_time AS DATE), store_id"),
                *((name, "CAST(product_id AS VARCHAR)", _MONEY.format("total_amount"), "product_id")
                  for name in ("products", "products by category", "batch by category")),
                ("customers", "CAST(customer_id AS VARCHAR)", _MONEY.format("total_amount"), "customer_id"),
                ("averages", "CAST(customer_id AS VARCHAR)", _MONEY_AVG.format("total_amount"), "customer_id"),
            )
        ),
        "refresh_customers": f"SELECT customer_id, customer_name, {_CUSTOMER_TOTALS} FROM web_facts"
        " GROUP BY 1, 2",
    }
    views = ",\n".join(
        [
            sql_views(),
            f"known_stores AS ({_STORES})",
            f"sales AS (SELECT * FROM raw_sales WHERE quantity > 0 AND {_VALID})",
            f"facts AS ({_facts('sales')})",
            f"web_facts AS ({_facts(f'(SELECT * FROM web_sales WHERE quantity > 0 AND {_VALID})')})",
            "adults AS (SELECT DISTINCT customer_id, name FROM customer_records WHERE age BETWEEN 18 AND 100)",
            f"batch_facts AS ({_facts(f'(SELECT * FROM raw_sales WHERE {_BATCH_VALID})', 'adults')})",
        ]
    )
    return {name: f"{views}\n{text}" for name, text in sql.items()}
