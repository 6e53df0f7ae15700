"""The retail model read from an order-and-line-item star schema.

Each mapping is a list of SQL projections that any ANSI engine understands. They also plant the faults that
quality rules look for (NULL and negative discounts, NULL keys, zero quantities, unknown codes), each on a
natural condition of the data, over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure

# The tables are keyed by 64-bit ids; so is this mapping.
LINE_COLUMNS = (
    "l_orderkey AS transaction_id",
    "CASE WHEN l_tax = 0.08 AND l_discount = 0.10 THEN NULL ELSE l_suppkey END AS store_id",
    "CAST(l_shipdate AS TIMESTAMP) AS event_time",
    "CASE WHEN l_tax = 0.06 AND l_discount = 0.10 THEN NULL ELSE l_partkey END AS product_id",
    "CASE WHEN l_tax = 0.08 AND l_discount = 0.07 THEN 0"
    " WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS INT) ELSE CAST(l_quantity AS INT) END AS quantity",
    "l_extendedprice / l_quantity AS unit_price",
    "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS total_amount",
    "CASE WHEN l_tax = 0.08 AND l_discount = 0.09 THEN NULL"
    " WHEN l_tax = 0.08 AND l_discount = 0.08 THEN -l_discount ELSE l_discount END AS discount_applied",
    "l_tax AS tax_amount",
)
ORDER_COLUMNS = (
    "o_orderkey AS transaction_id",
    "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS customer_id",
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash' WHEN '2-HIGH' THEN 'Credit Card'"
    " WHEN '3-MEDIUM' THEN 'Debit Card' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'Cheque' END AS payment_method",
)
CUSTOMER_COLUMNS = (
    "c_custkey AS customer_id",
    "c_name AS name",
    "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN c_name"
    " ELSE c_name || '@mail.example' END AS email",
    "c_mktsegment AS address",
    "CAST(FLOOR(c_acctbal) AS INT) AS loyalty_points",
    "10 + 4 * c_nationkey AS age",
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Male' WHEN 'FURNITURE' THEN 'Female'"
    " WHEN 'HOUSEHOLD' THEN 'Other' WHEN 'BUILDING' THEN 'Unstated' END AS gender",
)
PRODUCT_COLUMNS = (
    "p_partkey AS product_id",
    "p_name AS name",
    "CASE p_type WHEN 'ECONOMY' THEN 'Casual Wear' WHEN 'PROMO' THEN 'Sportswear'"
    " WHEN 'SMALL' THEN 'Accessories' ELSE p_type END AS category",
    "CASE WHEN p_brand = 'Brand#7' THEN NULL ELSE p_brand END AS brand",
    "CASE WHEN p_size = 1 THEN 0 WHEN p_size = 2 THEN 10000 WHEN p_size = 3 THEN NULL"
    " ELSE p_retailprice END AS price",
    "p_size - 5 AS stock_quantity",
)
STORE_COLUMNS = (
    "s_suppkey AS store_id",
    "s_name AS name",
    "CASE WHEN s_acctbal < 1000 THEN NULL ELSE 'Manager of ' || s_name END AS manager",
    "CASE WHEN s_nationkey < 5 THEN 'Closed' WHEN s_nationkey < 15 THEN 'Open'"
    " ELSE 'Under Renovation' END AS status",
)
# Change records of customers, one per order: the status is tracked and sometimes missing.
CUSTOMER_CHANGE_COLUMNS = (
    "o_custkey AS customer_id",
    "CAST(o_orderdate AS TIMESTAMP) AS changed_at",
    "o_orderkey AS change_id",
    "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderstatus END AS status",
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS last_total",
)
# Change records of users, from the event stream.
USER_CHANGE_COLUMNS = (
    "user_id",
    "CAST(ts AS TIMESTAMP) AS changed_at",
    "event_id",
    "event_type",
    "value",
)

# Small frequent sales, from the event stream: thirty days, in order of event time only by accident.
WEB_SALES_COLUMNS = (
    "event_id AS transaction_id",
    "CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 WHEN 'signup' THEN 4"
    " END AS store_id",
    "CAST(ts AS TIMESTAMP) AS event_time",
    "user_id AS customer_id",
    "CAST(FLOOR(value) AS BIGINT) AS product_id",
    "CASE WHEN event_type = 'signup' THEN -1 ELSE CAST(CEIL(value / 50) AS INT) END AS quantity",
    "value AS unit_price",
    "CASE WHEN event_type = 'signup' THEN -value ELSE value END AS total_amount",
    "'Mobile Pay' AS payment_method",
    "CAST(CASE WHEN value < 1 THEN -0.5 WHEN value > 200 THEN NULL ELSE 0 END AS DOUBLE) AS discount_applied",
    "CAST(0 AS DOUBLE) AS tax_amount",
)


class Star:
    """Frames of the retail model over the tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = configure(spark), directory

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def sales(self, with_order: bool = True) -> DataFrame:
        """Raw sales, one per line item.

        Order keys are unique, so the left join adds columns and never rows; leave it out where neither the
        customer nor the payment method is needed.
        """
        lines = self.table("lineitem").selectExpr(*LINE_COLUMNS)
        if not with_order:
            return lines
        orders = self.table("orders").selectExpr(*ORDER_COLUMNS)
        return lines.join(orders, "transaction_id", "left")

    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr(*CUSTOMER_COLUMNS)

    def products(self) -> DataFrame:
        return self.table("part").selectExpr(*PRODUCT_COLUMNS)

    def stores(self) -> DataFrame:
        return self.table("supplier").selectExpr(*STORE_COLUMNS)

    def customer_changes(self) -> DataFrame:
        return self.table("orders").selectExpr(*CUSTOMER_CHANGE_COLUMNS)

    def customer_records(self) -> DataFrame:
        """Customer records as they might be loaded in bulk: one per customer and day of an order."""
        days = self.table("orders").selectExpr(
            "o_custkey AS customer_id", "CAST(o_orderdate AS TIMESTAMP) AS last_update_time"
        )
        return days.distinct().join(self.customers(), "customer_id")

    def web_sales(self) -> DataFrame:
        return self.table("events").selectExpr(*WEB_SALES_COLUMNS)

    def user_changes(self) -> DataFrame:
        return self.table("events").selectExpr(*USER_CHANGE_COLUMNS)


def sql_views() -> str:
    """The same frames as common table expressions, for checking results with another engine."""

    def project(columns: tuple[str, ...], table: str) -> str:
        return f"SELECT {', '.join(columns)} FROM {table}"

    views = {
        "line_sales": project(LINE_COLUMNS, "lineitem"),
        "order_heads": project(ORDER_COLUMNS, "orders"),
        "raw_sales": "SELECT l.*, o.customer_id, o.payment_method"
        " FROM line_sales l LEFT JOIN order_heads o ON l.transaction_id = o.transaction_id",
        "customers": project(CUSTOMER_COLUMNS, "customer"),
        "products": project(PRODUCT_COLUMNS, "part"),
        "stores": project(STORE_COLUMNS, "supplier"),
        "customer_changes": project(CUSTOMER_CHANGE_COLUMNS, "orders"),
        "user_changes": project(USER_CHANGE_COLUMNS, "events"),
        "web_sales": project(WEB_SALES_COLUMNS, "events"),
        "customer_records": "SELECT d.*, c.* EXCLUDE (customer_id) FROM (SELECT DISTINCT"
        " o_custkey AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS last_update_time FROM orders) d"
        " JOIN customers c ON d.customer_id = c.customer_id",
    }
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in views.items())
