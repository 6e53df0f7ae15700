"""Rules on hand-made dirty rows."""

import pytest
from pyspark.sql import Observation

from tidemark.model import BATCH_RULES, BRONZE_RULES, CLEANED_RULES, TRANSACTION_RULES
from tidemark.operators.quality import (
    enforce,
    fail,
    metrics_frame,
    rule_metrics,
    rule_metrics_of,
)
from tidemark.operators.sales import (
    returns_transactions,
    sales_transactions,
    with_known_manager,
)

CUSTOMERS = "customer_id INT, email STRING, age INT, loyalty_points INT, gender STRING"
DIRTY_CUSTOMERS = [
    (1, "a@b.c", 18, 0, "Male"),
    (2, None, 100, 5, "Female"),
    (3, "no-at-sign", 17, -1, "Other"),
    (4, "a@b", 101, None, "other"),
    (None, "a@b.c", None, 1, None),
]


def violations(df, dataset, rules):
    return {r["rule"]: r["n_violations"] for r in rule_metrics(df, dataset, rules).collect()}


def test_customer_rules_count_and_keep(spark):
    df = spark.createDataFrame(DIRTY_CUSTOMERS, CUSTOMERS)
    rules = CLEANED_RULES["customers"]
    assert violations(df, "c", rules) == {
        "valid_customer_id": 1,
        "valid_email": 2,
        "realistic_age": 3,
        "realistic_loyalty_points": 2,
        "valid_gender": 2,
    }
    # Warnings keep their rows; only the missing key is dropped.
    assert sorted(r[0] for r in enforce(df, rules).collect()) == [1, 2, 3, 4]
    assert sorted(r[0] for r in enforce(df, BATCH_RULES["customers"]).collect()) == [1, 2]


def test_product_rules(spark):
    rows = [(1, 1.0, 0, "Footwear", "b"), (2, 0.0, -1, "Hats", None), (3, 10000.0, 1, None, "b"),
            (4, -1.0, 1, "Footwear", "b"), (5, None, None, "Footwear", "b")]
    df = spark.createDataFrame(rows, "product_id INT, price DOUBLE, stock_quantity INT, category STRING, brand STRING")
    assert violations(df, "p", CLEANED_RULES["products"]) == {
        "valid_product_id": 0, "valid_product_price": 4, "non_negative_stock": 2,
        "valid_category": 2, "valid_brand": 1,
    }
    assert [r[0] for r in enforce(df, CLEANED_RULES["products"]).collect()] == [1]
    assert sorted(r[0] for r in enforce(df, BATCH_RULES["products"]).collect()) == [1, 3]


def test_manager_rule_sees_the_replaced_name(spark):
    df = with_known_manager(
        spark.createDataFrame([(1, None, "Open"), (2, "m", "Closed")], "store_id INT, manager STRING, status STRING")
    )
    assert violations(df, "s", CLEANED_RULES["stores"]) == {
        "valid_store_id": 0, "valid_manager_name": 0, "valid_status": 1,
    }
    assert {r["manager"] for r in df.collect()} == {"Unknown", "m"}


def test_sales_and_returns(spark):
    ddl = "transaction_id INT, store_id INT, customer_id INT, product_id INT, quantity INT, total_amount DOUBLE, discount_applied DOUBLE"
    rows = [(1, 1, 1, 1, 1, 5.0, 0.0), (2, 1, 1, 1, -2, -10.0, 0.0), (3, 1, 1, 1, 0, 0.0, 0.0),
            (4, 1, 1, 1, None, 1.0, 0.0), (5, 1, 1, 1, 1, 1.0, -0.01), (6, 1, 1, 1, 1, 1.0, None),
            (7, None, 1, 1, 1, 1.0, 0.0), (8, 1, None, 1, 1, 1.0, 0.0), (9, 1, 1, None, -1, -1.0, 0.0)]
    df = spark.createDataFrame(rows, ddl)
    assert [r[0] for r in sales_transactions(df).collect()] == [1]
    returned = returns_transactions(df).collect()
    assert [(r["transaction_id"], r["returned_quantity"], r["returned_amount"]) for r in returned] == [(2, 2, 10.0)]
    assert "quantity" not in returned[0] and "total_amount" not in returned[0]
    assert sorted(r[0] for r in enforce(df, BATCH_RULES["sales"]).collect()) == [1, 5, 6, 7, 8]
    both = rule_metrics_of(df, {"sales": ("quantity > 0", TRANSACTION_RULES), "returns": ("quantity < 0", TRANSACTION_RULES)})
    counted = {(r["dataset"], r["rule"]): (r["n_rows"], r["n_violations"]) for r in both.collect()}
    assert counted["sales", "valid_discount"] == (5, 2)
    assert counted["returns", "valid_product_id"] == (2, 1)


@pytest.mark.parametrize("source", ["sales", "customers", "products", "stores"])
def test_fail_rule_raises_even_when_pruned(spark, source):
    (rule,) = BRONZE_RULES[source]
    key = rule.condition.split()[0]
    good = spark.createDataFrame([(1, 2)], f"{key} INT, other INT")
    bad = spark.createDataFrame([(1, 2), (None, 3)], f"{key} INT, other INT")
    assert enforce(good, [rule]).count() == 1
    for use in (lambda df: df.count(), lambda df: df.select("other").collect()):
        with pytest.raises(Exception, match=rule.name):
            use(enforce(bad, [rule]))


def test_null_condition_is_a_violation(spark):
    df = spark.createDataFrame([(None,), (1,)], "x INT")
    with pytest.raises(Exception, match="positive"):
        enforce(df, [fail("positive", "x > 0")]).collect()


def test_counters_ride_along_with_the_action(spark):
    rules = CLEANED_RULES["customers"]
    df = spark.createDataFrame(DIRTY_CUSTOMERS, CUSTOMERS)
    counters = Observation()
    assert enforce(df, rules, counters).count() == 4
    observed = metrics_frame(spark, "c", rules, counters.get)
    assert sorted(map(tuple, observed.collect())) == sorted(map(tuple, rule_metrics(df, "c", rules).collect()))
