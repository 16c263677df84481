"""The checks declared for the models: column tests per layer and the final suite."""

from __future__ import annotations

from datetime import datetime

from tidemark import schemas as S
from tidemark.quality.checks import (
    Check,
    accepted_values,
    at_least,
    freshness,
    mart_matches_facts,
    not_null,
    one_current_row,
    relationship,
    row_count_not_below,
    unique,
)

# The declared tests. Per layer and table: columns never NULL, unique columns, references
# (column, table, column) and allowed values (column, values).
COLUMN_TESTS: dict[str, dict[str, dict[str, list]]] = {
    "staging": {
        "stg_categories": {"not_null": ["category_id", "category_name"], "unique": ["category_id"]},
        "stg_customers": {
            "not_null": ["customer_id", "email"],
            "unique": ["customer_id"],
            "accepted": [("customer_grade", S.CUSTOMER_GRADES)],
        },
        "stg_products": {
            "not_null": ["product_id", "category_id"],
            "unique": ["product_id"],
            "references": [("category_id", "stg_categories", "category_id")],
            "accepted": [("product_status", S.PRODUCT_STATUSES)],
        },
        "stg_coupons": {
            "not_null": ["coupon_id"],
            "unique": ["coupon_id"],
            "accepted": [("discount_type", S.DISCOUNT_TYPES)],
        },
        "stg_orders": {
            "not_null": ["order_id", "customer_id"],
            "unique": ["order_id"],
            "references": [("customer_id", "stg_customers", "customer_id")],
            "accepted": [("order_status", S.ORDER_STATUSES)],
        },
        "stg_order_items": {
            "not_null": ["order_item_id", "order_id", "product_id"],
            "unique": ["order_item_id"],
            "references": [("order_id", "stg_orders", "order_id"), ("product_id", "stg_products", "product_id")],
        },
        "stg_payments": {
            "not_null": ["payment_id", "order_id"],
            "unique": ["payment_id"],
            "references": [("order_id", "stg_orders", "order_id")],
            "accepted": [("payment_status", S.PAYMENT_STATUSES)],
        },
        "stg_shipments": {
            "not_null": ["shipment_id", "order_id"],
            "unique": ["shipment_id"],
            "references": [("order_id", "stg_orders", "order_id")],
            "accepted": [("shipment_status", S.SHIPMENT_STATUSES)],
        },
        "stg_inventory_snapshots": {
            "not_null": ["snapshot_date", "product_id"],
            "references": [("product_id", "stg_products", "product_id")],
        },
        "stg_order_status_history": {
            "not_null": ["order_status_history_id", "order_id"],
            "unique": ["order_status_history_id"],
            "references": [("order_id", "stg_orders", "order_id")],
            "accepted": [("new_status", S.ORDER_STATUSES)],
        },
    },
    "core": {
        "dim_date": {"not_null": ["date_day"], "unique": ["date_day"]},
        "dim_category": {"not_null": ["category_id"], "unique": ["category_id"]},
        "dim_coupon": {"not_null": ["coupon_id"], "unique": ["coupon_id"]},
        "dim_customer": {"not_null": ["customer_sk", "customer_id", "row_hash"], "unique": ["customer_sk"]},
        "dim_product": {"not_null": ["product_sk", "product_id", "row_hash"], "unique": ["product_sk"]},
        "fact_order": {
            "not_null": ["order_id", "customer_id"],
            "unique": ["order_id"],
            "references": [("customer_id", "dim_customer", "customer_id")],
            "accepted": [("order_status", S.ORDER_STATUSES)],
        },
        "fact_order_item": {
            "not_null": ["order_item_id", "order_id", "product_id"],
            "unique": ["order_item_id"],
            "references": [("order_id", "fact_order", "order_id"), ("product_id", "dim_product", "product_id")],
        },
        "fact_payment": {
            "not_null": ["payment_id", "order_id"],
            "unique": ["payment_id"],
            "references": [("order_id", "fact_order", "order_id")],
            "accepted": [("payment_status", S.PAYMENT_STATUSES)],
        },
        "fact_shipment": {
            "not_null": ["shipment_id", "order_id"],
            "unique": ["shipment_id"],
            "references": [("order_id", "fact_order", "order_id")],
            "accepted": [("shipment_status", S.SHIPMENT_STATUSES)],
        },
        "fact_inventory_snapshot": {
            "not_null": ["snapshot_date", "product_id"],
            "references": [("product_id", "dim_product", "product_id")],
        },
        "fact_order_status_history": {
            "not_null": ["order_status_history_id", "order_id"],
            "unique": ["order_status_history_id"],
            "references": [("order_id", "fact_order", "order_id")],
            "accepted": [("new_status", S.ORDER_STATUSES)],
        },
    },
    "mart": {
        "mart_daily_sales": {"not_null": ["sales_date", "category_id", "daily_revenue"]},
        "mart_product_sales": {"not_null": ["sales_date", "product_id", "quantity_sold"]},
        "mart_customer_ltv": {
            "not_null": ["customer_id"],
            "unique": ["customer_id"],
            "accepted": [("customer_segment", S.CUSTOMER_SEGMENTS)],
        },
        "mart_monthly_retention": {
            "not_null": ["cohort_month", "order_month", "months_since_cohort", "customer_segment"]
        },
    },
}

COMPOSITE_KEYS = {
    "staging": {"stg_inventory_snapshots": ["snapshot_date", "product_id"]},
    "core": {"fact_inventory_snapshot": ["snapshot_date", "product_id"]},
    "mart": {
        "mart_daily_sales": ["sales_date", "category_id"],
        "mart_product_sales": ["sales_date", "product_id"],
        "mart_monthly_retention": ["cohort_month", "order_month", "customer_segment"],
    },
}

ONE_CURRENT = {"core": {"dim_customer": "customer_id", "dim_product": "product_id"}}


def layer_checks(layer: str) -> list[Check]:
    """Every declared test of one layer."""
    checks: list[Check] = []
    for table, tests in COLUMN_TESTS[layer].items():
        checks += [not_null(layer, table, col) for col in tests.get("not_null", [])]
        checks += [unique(layer, table, [col], skip_null=True) for col in tests.get("unique", [])]
        checks += [relationship(layer, table, *ref) for ref in tests.get("references", [])]
        checks += [accepted_values(layer, table, col, values) for col, values in tests.get("accepted", [])]
    checks += [unique(layer, table, cols) for table, cols in COMPOSITE_KEYS.get(layer, {}).items()]
    checks += [one_current_row(layer, table, key) for table, key in ONE_CURRENT.get(layer, {}).items()]
    return checks


def final_suite(as_of: datetime | None = None) -> list[Check]:
    """The sixteen checks (fixed values: their names) a batch must pass before its watermark moves.

    Raw tables are looked up as `raw_<table>`.
    """
    return [
        freshness("raw", "orders", "raw_orders", as_of),
        not_null("core", "fact_order", "order_id", name="fact_order_pk_not_null"),
        unique("core", "fact_order", ["order_id"], name="fact_order_pk_unique"),
        unique("core", "fact_order_item", ["order_item_id"], name="fact_order_item_pk_unique"),
        relationship("core", "fact_order_item", "order_id", "fact_order", "order_id", "fact_order_item_order_fk"),
        relationship("core", "fact_payment", "order_id", "fact_order", "order_id", "fact_payment_order_fk"),
        accepted_values("core", "fact_order", "order_status", S.ORDER_STATUSES, "fact_order_status_accepted_values"),
        accepted_values(
            "core", "fact_payment", "payment_status", S.PAYMENT_STATUSES, "fact_payment_status_accepted_values"
        ),
        at_least("core", "fact_payment", "payment_amount", name="payment_amount_non_negative"),
        at_least("core", "fact_order", "total_amount", name="order_total_amount_non_negative"),
        one_current_row("core", "dim_customer", "customer_id"),
        one_current_row("core", "dim_product", "product_id"),
        row_count_not_below("core", "fact_order", "order_id", "raw_orders", name="raw_to_core_orders_row_count"),
        at_least(
            "mart",
            "mart_daily_sales",
            "daily_revenue",
            name="mart_daily_sales_revenue_non_negative",
            check_type="metric_sanity",
        ),
        at_least(
            "mart",
            "mart_product_sales",
            "quantity_sold",
            name="mart_product_sales_quantity_non_negative",
            check_type="metric_sanity",
        ),
        mart_matches_facts("mart", "mart_daily_sales", "fact_order_item", "fact_order", S.REVENUE_STATUSES),
    ]
