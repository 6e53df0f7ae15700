"""The retail data model: input schemas, quality rules and dimension settings. Data only."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.operators.quality import Rule, drop, fail, warn

# --- fixed values: input schemas -----------------------------------------------------------------------
# Ids and quantities are 64-bit: order lines alone pass 2^31.
SALES_DDL = """
    transaction_id BIGINT, store_id BIGINT, event_time TIMESTAMP, customer_id BIGINT, product_id BIGINT,
    quantity BIGINT, unit_price DOUBLE, total_amount DOUBLE, payment_method STRING, discount_applied DOUBLE,
    tax_amount DOUBLE
"""
CUSTOMERS_DDL = """
    customer_id BIGINT, name STRING, email STRING, address STRING, join_date TIMESTAMP, loyalty_points INT,
    phone_number STRING, age INT, gender STRING, last_update_time TIMESTAMP
"""
PRODUCTS_DDL = """
    product_id BIGINT, name STRING, category STRING, brand STRING, price DOUBLE, stock_quantity INT,
    size STRING, color STRING, description STRING, last_update_time TIMESTAMP
"""
STORES_DDL = """
    store_id BIGINT, name STRING, address STRING, manager STRING, open_date TIMESTAMP, status STRING,
    phone_number STRING, last_update_time TIMESTAMP
"""
# Continuous file ingest keeps a text event time, cast when the sales layer is built.
SALES_FILE_DDL = """
    transaction_id BIGINT, store_id BIGINT, event_time STRING, customer_id BIGINT, product_id BIGINT,
    quantity BIGINT, unit_price DOUBLE, total_amount DOUBLE, payment_method STRING, discount_applied DOUBLE,
    tax_amount DOUBLE
"""
SCHEMAS = {
    "sales": SALES_DDL,
    "customers": CUSTOMERS_DDL,
    "products": PRODUCTS_DDL,
    "stores": STORES_DDL,
}



def columns_of(ddl: str) -> dict[str, str]:
    """Names and types, in order, of a schema whose types have no arguments."""
    return dict(column.split() for column in ddl.split(","))


# --- fixed values: the key of each source ----------------------------------------------------------------
KEYS = {
    "sales": "transaction_id",
    "customers": "customer_id",
    "products": "product_id",
    "stores": "store_id",
}

# --- fixed values: quality rules -----------------------------------------------------------------------
BRONZE_RULES: dict[str, tuple[Rule, ...]] = {
    "sales": (fail("valid_transaction_id", "transaction_id IS NOT NULL"),),
    "customers": (fail("valid_customer_id", "customer_id IS NOT NULL"),),
    "products": (fail("valid_product_id", "product_id IS NOT NULL"),),
    "stores": (fail("valid_store_id", "store_id IS NOT NULL"),),
}
CLEANED_RULES: dict[str, tuple[Rule, ...]] = {
    "customers": (
        drop("valid_customer_id", "customer_id IS NOT NULL"),
        warn("valid_email", "email IS NULL OR email LIKE '%@%.%'"),
        warn("realistic_age", "age >= 18 AND age <= 100"),
        warn("realistic_loyalty_points", "loyalty_points >= 0"),
        warn("valid_gender", "gender IN ('Male', 'Female', 'Other')"),
    ),
    "products": (
        drop("valid_product_id", "product_id IS NOT NULL"),
        drop("valid_product_price", "price > 0 AND price < 10000"),
        warn("non_negative_stock", "stock_quantity >= 0"),
        warn(
            "valid_category",
            "category IN ('Casual Wear', 'Formal Wear', 'Sportswear', 'Accessories', 'Footwear')",
        ),
        warn("valid_brand", "brand IS NOT NULL"),
    ),
    "stores": (
        drop("valid_store_id", "store_id IS NOT NULL"),
        warn("valid_manager_name", "manager IS NOT NULL"),
        warn("valid_status", "status IN ('Open', 'Under Renovation')"),
    ),
    "sales": (
        warn(
            "valid_payment_method",
            "payment_method IN ('Cash', 'Credit Card', 'Debit Card', 'Mobile Pay', 'Gift Card')",
        ),
        warn("realistic_discount", "discount_applied >= 0"),
    ),
}
# Applied to sales and to returns alike.
TRANSACTION_RULES: tuple[Rule, ...] = (
    drop("valid_discount", "discount_applied >= 0"),
    drop("valid_store_id", "store_id IS NOT NULL"),
    drop("valid_customer_id", "customer_id IS NOT NULL"),
    drop("valid_product_id", "product_id IS NOT NULL"),
)
# The batch pipeline promotes a smaller set of rules to plain filters.
BATCH_RULES: dict[str, tuple[Rule, ...]] = {
    "customers": (
        drop("valid_customer_id", "customer_id IS NOT NULL"),
        drop("realistic_age", "age >= 18 AND age <= 100"),
        drop("realistic_loyalty_points", "loyalty_points IS NULL OR loyalty_points >= 0"),
    ),
    "products": (
        drop("valid_product_id", "product_id IS NOT NULL"),
        drop("valid_product_price", "price > 0"),
    ),
    "stores": (drop("valid_store_id", "store_id IS NOT NULL"),),
    "sales": (
        drop("valid_transaction_id", "transaction_id IS NOT NULL"),
        drop("valid_amount", "total_amount > 0"),
        drop("valid_quantity", "quantity > 0"),
    ),
}
# The rules in front of the customer history of the batch pipeline.
ADULT_CUSTOMERS = (
    drop("valid_customer_id", "customer_id IS NOT NULL"),
    drop("adult", "age >= 18"),
)

# --- fixed values: watermark, default manager, lineage columns -------------------------------------------
# Event times may arrive this late; windows over the cleaned sales stream wait as long.
EVENT_TIME_WATERMARK = "10 minutes"
UNKNOWN_MANAGER = "Unknown"
LINEAGE_COLUMNS = ("ingest_timestamp", "source_file_path")


@dataclass(frozen=True)
class Dimension:
    """How the change records of one dimension become history.

    ``tiebreak`` must make (key, sequence, tiebreak) unique; it decides between records with equal
    sequence values, which would otherwise come out in any order.
    """

    name: str
    keys: tuple[str, ...]
    sequence: str
    tracked: tuple[str, ...]
    tiebreak: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    ignore_nulls: bool = True


# --- fixed values: dimension settings -----------------------------------------------------------------
_TECHNICAL = ("last_update_time", *LINEAGE_COLUMNS)
DIMENSIONS = {
    "customers": Dimension(
        "customers",
        ("customer_id",),
        "last_update_time",
        ("name", "email", "address", "phone_number", "gender"),
        excluded=_TECHNICAL,
    ),
    "products": Dimension(
        "products",
        ("product_id",),
        "last_update_time",
        ("name", "category", "brand", "price", "description", "color", "size"),
        excluded=_TECHNICAL,
    ),
    "stores": Dimension(
        "stores",
        ("store_id",),
        "last_update_time",
        ("name", "address", "manager", "status"),
        excluded=_TECHNICAL,
    ),
}

# --- fixed values: columns of an enriched sale, and where the looked-up ones come from --------------------
FACT_COLUMNS = (
    "transaction_id",
    "event_time",
    "customer_id",
    "customer_name",
    "product_id",
    "product_name",
    "product_category",
    "store_id",
    "store_name",
    "quantity",
    "unit_price",
    "total_amount",
    "payment_method",
    "discount_applied",
    "tax_amount",
)
LOOKUPS = {
    "stores": ("store_id", {"store_name": "name"}),
    "customers": ("customer_id", {"customer_name": "name"}),
    "products": ("product_id", {"product_name": "name", "product_category": "category"}),
}
# What a return reports instead of a measure of the sale, as its magnitude.
RETURN_MEASURES = {"returned_quantity": "quantity", "returned_amount": "total_amount"}
