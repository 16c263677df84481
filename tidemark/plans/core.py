"""Core star schema: the dimensions and facts, and how each is kept."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import HOT_VERSIONS, asof_join
from tidemark.operators.hotkeys import HOT_ROWS
from tidemark.operators.scd2 import OPEN_END, scd2_incremental, scd2_initial
from tidemark.sources.store import Layout

AUDIT_TAIL = ["created_at", "updated_at", "is_deleted", "extract_date", "loaded_at"]

# The columns whose change makes a new version.
CUSTOMER_TRACKED = ["customer_name", "email", "phone_number", "address", "customer_grade", "marketing_opt_in"]
CUSTOMER_UNTRACKED = ["signup_date"]
PRODUCT_TRACKED = ["product_name", "category_id", "list_price", "brand", "product_status"]


@dataclass(frozen=True)
class Target:
    """Merge key and layout of a stored model."""

    key: tuple[str, ...]
    layout: Layout = Layout()


# Incremental loads start at the greatest change time a table holds. Every fact is
# partitioned by a date, so that an upsert leaves the files of old dates alone.
CHANGED = "updated_at"

# Histories are partitioned by the month in which a version was closed, so that a run rewrites the open versions and
# those closed in the months it closes some in.
CLOSED = "closed_month"

# Which source table feeds a model.
FED_BY = {
    "dim_category": "categories",
    "dim_coupon": "coupons",
    "dim_customer": "customers",
    "dim_product": "products",
    "fact_order": "orders",
    "fact_order_item": "order_items",
    "fact_payment": "payments",
    "fact_shipment": "shipments",
    "fact_inventory_snapshot": "inventory_snapshots",
    "fact_order_status_history": "order_status_history",
}

TARGETS = {
    "dim_category": Target(("category_id",), Layout(track=CHANGED)),
    "dim_coupon": Target(("coupon_id",), Layout(track=CHANGED)),
    "dim_customer": Target(("customer_sk",), Layout((CLOSED,), ("customer_id",))),
    "dim_product": Target(("product_sk",), Layout((CLOSED,), ("product_id",))),
    "fact_order": Target(("order_id",), Layout(("order_date",), ("customer_id", "order_status"), CHANGED)),
    "fact_order_item": Target(("order_item_id",), Layout(("order_date",), ("product_id", "category_id"), CHANGED)),
    "fact_payment": Target(("payment_id",), Layout(("payment_date",), ("payment_status", "payment_method"), CHANGED)),
    "fact_shipment": Target(("shipment_id",), Layout(("shipped_date",), ("order_id",), CHANGED)),
    "fact_inventory_snapshot": Target(
        ("snapshot_date", "product_id"), Layout(("snapshot_date",), ("product_id", "category_id"), CHANGED)
    ),
    "fact_order_status_history": Target(
        ("order_status_history_id",), Layout(("changed_date",), ("order_id", "new_status"), CHANGED)
    ),
}


def dim_date(spark: SparkSession, start: date = date(2020, 1, 1), end: date = date(2030, 12, 31)) -> DataFrame:
    """One row per calendar day; Sunday is day 1 of the week."""
    span = F.sequence(F.lit(start.isoformat()).cast("date"), F.lit(end.isoformat()).cast("date"))
    day = F.col("date_day")
    return spark.range(1).select(F.explode(span).alias("date_day")).select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("iso_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.trunc(day, "month").alias("month_start_date"),
        F.trunc(day, "quarter").alias("quarter_start_date"),
        F.trunc(day, "year").alias("year_start_date"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_category(stg: DataFrame) -> DataFrame:
    return stg.select(
        "category_id", "parent_category_id", "category_name", "category_level", "is_active", *AUDIT_TAIL
    )


def dim_coupon(stg: DataFrame) -> DataFrame:
    return stg.select(
        "coupon_id",
        "coupon_code",
        "coupon_name",
        "discount_type",
        "discount_value",
        "valid_from",
        "valid_to",
        *AUDIT_TAIL,
    )


def dim_customer(
    stg: DataFrame, existing: DataFrame | None = None, history: bool = False, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Versions to upsert on customer_sk.

    `history=True` takes a full change log instead of staging, whose keys have
    one row each; keys of a log above `hot_rows` rows are split.
    """
    if existing is not None:
        return scd2_incremental(
            stg, existing, "customer_id", CUSTOMER_TRACKED, "customer_sk", CUSTOMER_UNTRACKED
        )
    limit = hot_rows if history else None
    return scd2_initial(stg, "customer_id", CUSTOMER_TRACKED, "customer_sk", CUSTOMER_UNTRACKED, hot_rows=limit)


def dim_product(
    stg: DataFrame, existing: DataFrame | None = None, history: bool = False, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Versions to upsert on product_sk."""
    if existing is not None:
        return scd2_incremental(stg, existing, "product_id", PRODUCT_TRACKED, "product_sk")
    return scd2_initial(stg, "product_id", PRODUCT_TRACKED, "product_sk", hot_rows=hot_rows if history else None)


def by_closing_month(versions: DataFrame) -> DataFrame:
    """Versions as they are stored; open ones are in the month of the open end."""
    return versions.withColumn(CLOSED, F.to_date(F.trunc("effective_to", "month")))


def open_versions(dim: DataFrame) -> DataFrame:
    """The versions an incremental run may close; of a table partitioned by closing month no other files are read."""
    if CLOSED not in dim.columns:
        return dim
    return dim.where(F.col(CLOSED) == F.lit(f"{OPEN_END[:7]}-01").cast("date"))


def fact_order(stg_orders: DataFrame, customers: DataFrame, hot_versions: int | None = HOT_VERSIONS) -> DataFrame:
    """Orders with the customer version valid at order time."""
    joined = asof_join(
        stg_orders, customers, "customer_id", "order_at", {"customer_sk": "customer_sk"}, hot_versions=hot_versions
    )
    return joined.select(
        "order_id",
        "customer_id",
        "customer_sk",
        "coupon_id",
        "order_status",
        "order_channel",
        "order_at",
        "order_date",
        "subtotal_amount",
        "discount_amount",
        "shipping_fee",
        "total_amount",
        *AUDIT_TAIL,
    )


def fact_order_item(
    stg_items: DataFrame, orders: DataFrame, products: DataFrame, hot_versions: int | None = HOT_VERSIONS
) -> DataFrame:
    """Items with the order's date and the product version valid at order time."""
    order_times = orders.select(F.col("order_id").alias("__order_id"), "order_date", "order_at")
    timed = stg_items.join(order_times, F.col("order_id") == F.col("__order_id"), "left")
    found = {"product_sk": "product_sk", "category_id": "category_id"}
    joined = asof_join(timed, products, "product_id", "order_at", found, hot_versions=hot_versions)
    return joined.select(
        "order_item_id",
        "order_id",
        "order_date",
        "product_id",
        "product_sk",
        "category_id",
        "quantity",
        "unit_price",
        "discount_amount",
        "item_amount",
        *AUDIT_TAIL,
    )


def fact_payment(stg: DataFrame) -> DataFrame:
    return stg.select(
        "payment_id",
        "order_id",
        "payment_method",
        "payment_status",
        "payment_amount",
        "payment_at",
        "payment_date",
        "transaction_id",
        *AUDIT_TAIL,
    )


def fact_shipment(stg: DataFrame) -> DataFrame:
    return stg.select(
        "shipment_id",
        "order_id",
        "shipment_status",
        "carrier",
        "tracking_number",
        "shipped_at",
        "delivered_at",
        F.to_date("shipped_at").alias("shipped_date"),
        F.to_date("delivered_at").alias("delivered_date"),
        *AUDIT_TAIL,
    )


def fact_inventory_snapshot(stg: DataFrame) -> DataFrame:
    return stg.select(
        "snapshot_date",
        "product_id",
        "category_id",
        "stock_quantity",
        "reserved_quantity",
        "available_quantity",
        *AUDIT_TAIL,
    )


def fact_order_status_history(stg: DataFrame) -> DataFrame:
    return stg.select(
        "order_status_history_id",
        "order_id",
        "previous_status",
        "new_status",
        "changed_at",
        F.to_date("changed_at").alias("changed_date"),
        "change_reason",
        *AUDIT_TAIL,
    )
