"""The four marts as functions of core tables.

`start` and `end` select the reporting range; `lookback_from` the first day of
an incremental run. With neither, everything is built. In a bounded run the
tables that are joined to the selection are first reduced to its keys, so a
daily run shuffles a day's share of the orders and payments and not all of them.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    conditional_sum,
    days_between,
    divide_exact,
    loaded_at,
    months_between_starts,
    not_deleted,
    safe_divide,
    share_of,
)
from tidemark.operators.reduce import only_matching
from tidemark.plans.core import Target
from tidemark.schemas import REVENUE_STATUSES
from tidemark.sources.store import Layout

# Segment thresholds and stand-ins for an unknown category or segment.
HIGH_VALUE_LTV = 1_000_000
REPEAT_ORDERS = 3
UNKNOWN_CATEGORY_ID = -1
UNKNOWN = "unknown"

# How far back an incremental run without a range reaches.
SALES_LOOKBACK_DAYS = 7
LTV_LOOKBACK_DAYS = 30
RETENTION_LOOKBACK_MONTHS = 12

TARGETS = {
    "mart_daily_sales": Target((), Layout(("sales_date",), ("category_id",))),
    "mart_product_sales": Target((), Layout(("sales_date",), ("product_id", "category_id"))),
    "mart_customer_ltv": Target(("customer_id",), Layout((), ("customer_id", "customer_segment"))),
    "mart_monthly_retention": Target((), Layout(("cohort_month",), ("customer_segment",))),
}


def _day(value: date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def in_range(df: DataFrame, col: str, start: date | None, end: date | None, lookback_from: date | None) -> DataFrame:
    if start is not None and end is not None:
        return df.where(F.col(col).between(_day(start), _day(end)))
    if lookback_from is not None:
        return df.where(F.col(col) >= _day(lookback_from))
    return df


def is_bounded(start: date | None, end: date | None, lookback_from: date | None) -> bool:
    return (start is not None and end is not None) or lookback_from is not None


def _month_start(day: date | None) -> date | None:
    return None if day is None else day.replace(day=1)


def _month_end(day: date | None) -> date | None:
    return None if day is None else (day.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


# Tasks that items without an order are spread over; their products are told apart, so distinct counts add up.
SPREAD = 1024


def order_place(by_product: bool) -> Column:
    """0 for a known order; for items without one a number by product, so that their NULL key is no hot partition."""
    known = F.pmod("order_id", F.lit(1))  # not written as a literal, which the join would drop from its keys
    if not by_product:
        return known.cast("int").alias("__place")
    return F.coalesce(known, 1 + F.pmod(F.hash("product_id"), F.lit(SPREAD))).cast("int").alias("__place")


BY_ORDER = ["order_id", "__place"]
# The steps after the move by order each hold their groups in memory, so its partitions are smaller than those of other shuffles.
FINER = 4


def by_order(items: DataFrame) -> DataFrame:
    """The items moved by order, into a given number of partitions, which AQE does not merge again."""
    return items.repartition(FINER * int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), *BY_ORDER)


def packed_key(name: str) -> list[Column]:
    """A key as bytes where it is hex text of lower case, which is half as long and as hard to compress, and else as it is."""
    key, plain = F.col(name), F.lower(F.hex(F.unhex(name)))
    same = F.coalesce(plain == key, F.lit(False))
    return [F.when(same, F.unhex(name)).alias(f"__{name}_bytes"), F.when(~same, key).alias(f"__{name}_text")]


def unpacked_key(name: str) -> Column:
    return F.coalesce(F.col(f"__{name}_text"), F.lower(F.hex(f"__{name}_bytes"))).alias(name)


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Paid and refunded amount per order, so joins to orders do not fan out."""
    return (
        payments.where(not_deleted())
        .groupBy("order_id")
        .agg(
            conditional_sum("payment_amount", "payment_status", ["paid"]).alias("paid_amount"),
            conditional_sum("payment_amount", "payment_status", ["refunded"]).alias("refunded_amount"),
        )
    )


def mart_daily_sales(
    items: DataFrame,
    categories: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    start: date | None = None,
    end: date | None = None,
    lookback_from: date | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Sales per day and category; payments are shared out by each category's part of its order.

    Items are read once and move once, by order: that partitioning serves the distinct products, the
    category totals, the order total (a window) and both joins. Items without an
    order have no order total, status or payment; they move by product.
    """
    chosen = in_range(items.where(not_deleted()), "order_date", start, end, lookback_from)
    if is_bounded(start, end, lookback_from):
        orders, payments = only_matching([orders, payments], chosen.select("order_id"))
    # Items without a category and items of the stand-in id are one group when both are called unknown.
    stand_in = categories.where(F.col("category_id") == UNKNOWN_CATEGORY_ID).agg(F.max("category_name")).scalar()
    one_group = F.coalesce(stand_in, F.lit(UNKNOWN)) == UNKNOWN
    nameless = F.col("category_id").isNull() & one_group
    chosen = chosen.withColumn(
        "category_id",
        F.when(nameless, F.lit(UNKNOWN_CATEGORY_ID).cast("long")).otherwise(F.col("category_id")),
    ).select(
        "order_id", order_place(True), "order_date", "category_id", "product_id", "quantity", "item_amount", "discount_amount"
    )
    sums = [
        F.count_distinct("product_id").alias("product_count"),
        F.sum("quantity").alias("quantity_sold"),
        F.sum("item_amount").cast("decimal(22,2)").alias("category_amount"),
        F.sum("discount_amount").cast("decimal(22,2)").alias("item_discount_amount"),
    ]
    per_category = by_order(chosen).groupBy(*BY_ORDER, "order_date", "category_id").agg(*sums)
    order_total = F.sum("category_amount").over(Window.partitionBy(*BY_ORDER))
    with_total = per_category.withColumn("order_amount", order_total.cast("decimal(17,2)"))
    statuses = orders.where(not_deleted()).select("order_id", order_place(False), "order_status")
    paid = payments_per_order(payments).select("*", order_place(False))
    joined = with_total.join(statuses, BY_ORDER, "left").join(paid, BY_ORDER, "left")
    in_order = F.col("order_id").isNotNull()

    def allocated(amount: str) -> Column:
        share = share_of(F.coalesce(F.col(amount), F.lit(0)), F.col("category_amount"), F.col("order_amount"))
        return F.when(in_order, share).alias(amount)

    per_day = (
        joined.withColumns({"in_order": F.when(in_order, 1), **{a: allocated(a) for a in ("paid_amount", "refunded_amount")}})
        .groupBy("order_date", "category_id")
        .agg(
            F.count("in_order").alias("order_count"),
            F.sum("product_count").alias("product_count"),
            F.sum("quantity_sold").alias("quantity_sold"),
            F.sum("category_amount").alias("gross_item_revenue"),
            F.sum("item_discount_amount").alias("item_discount_amount"),
            F.sum("paid_amount").alias("allocated_paid_amount"),
            F.sum("refunded_amount").alias("allocated_refunded_amount"),
            conditional_sum("category_amount", "order_status", REVENUE_STATUSES).alias("daily_revenue"),
        )
    )
    return _with_category(per_day, categories).select(
        F.col("order_date").alias("sales_date"),
        "category_id",
        "category_name",
        "order_count",
        "product_count",
        "quantity_sold",
        "gross_item_revenue",
        "item_discount_amount",
        "allocated_paid_amount",
        "allocated_refunded_amount",
        "daily_revenue",
        loaded_at(as_of).alias("mart_loaded_at"),
    )


def _with_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Category name and id of an aggregated table; unknown ones become -1 / 'unknown'."""
    names = categories.select(F.col("category_id").alias("__category_id"), "category_name")
    return df.join(names, F.col("category_id") == F.col("__category_id"), "left").withColumns(
        {
            "category_id": F.coalesce("category_id", F.lit(UNKNOWN_CATEGORY_ID).cast("long")),
            "category_name": F.coalesce("category_name", F.lit(UNKNOWN)),
        }
    )


def mart_product_sales(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    start: date | None = None,
    end: date | None = None,
    lookback_from: date | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Sales per day and product version.

    `items` has one row per order_item_id (its merge key), so items are counted
    without a distinct. They are read once and move once, by order, and attributes are joined after
    aggregation, by keys that are unique in their dimensions. Items without an
    order move by product.
    """
    chosen = in_range(items.where(not_deleted()), "order_date", start, end, lookback_from).withColumn(
        "category_id", F.coalesce("category_id", F.lit(UNKNOWN_CATEGORY_ID).cast("long"))
    )
    if is_bounded(start, end, lookback_from):
        (orders,) = only_matching([orders], chosen.select("order_id"))
    statuses = orders.where(not_deleted()).select("order_id", order_place(False), "order_status")
    grain = ["order_date", "product_id", "__product_sk_bytes", "__product_sk_text", "category_id"]
    chosen = chosen.select("*", *packed_key("product_sk")).select(
        "order_id", order_place(True), *grain, "order_item_id", "quantity", "item_amount", "discount_amount"
    )
    sums = [
        F.count("order_item_id").alias("order_item_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("item_amount").alias("item_amount"),
        F.sum("discount_amount").alias("discount_amount"),
    ]
    per_order = by_order(chosen).groupBy(*BY_ORDER, *grain).agg(*sums).join(statuses, BY_ORDER, "left")
    per_day = per_order.groupBy(*grain).agg(
        F.count("order_id").alias("order_count"),
        F.sum("order_item_count").alias("order_item_count"),
        F.sum("quantity").alias("quantity_sold"),
        F.sum("item_amount").alias("gross_revenue"),
        F.sum("discount_amount").alias("discount_amount"),
        conditional_sum("item_amount", "order_status", REVENUE_STATUSES).alias("net_revenue"),
    )
    # Grouped, so that the planner knows a version has one row and leaves the join out where no attribute is read.
    attributes = products.groupBy(F.col("product_sk").alias("__product_sk")).agg(
        *[F.any_value(c).alias(c) for c in ("product_name", "brand", "product_status")]
    )
    described = per_day.withColumn("product_sk", unpacked_key("product_sk")).join(attributes, F.col("product_sk") == F.col("__product_sk"), "left")
    return _with_category(described, categories).select(
        F.col("order_date").alias("sales_date"),
        "product_id",
        "product_sk",
        "product_name",
        "brand",
        "product_status",
        "category_id",
        "category_name",
        "order_count",
        "order_item_count",
        "quantity_sold",
        "gross_revenue",
        "discount_amount",
        "net_revenue",
        loaded_at(as_of).alias("mart_loaded_at"),
    )


def mart_customer_ltv(
    orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    as_of: datetime | None = None,
    start: date | None = None,
    end: date | None = None,
    lookback_from: date | None = None,
) -> DataFrame:
    """Lifetime value and segment per customer, over orders that count as revenue (one row per order)."""
    valid = orders.where(not_deleted() & F.col("order_status").isin(REVENUE_STATUSES)).select(
        "order_id", "customer_id", "order_date"
    )
    if is_bounded(start, end, lookback_from):
        # A customer whose last order is in range has an order in range; orders without a customer are one such group.
        (valid,) = only_matching(
            [valid], in_range(valid, "order_date", start, end, lookback_from).select("customer_id"), nulls_match=True
        )
        (payments,) = only_matching([payments], valid.select("order_id"))
    totals = (
        valid.join(payments_per_order(payments), "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count("order_id").alias("lifetime_order_count"),
            F.sum(F.coalesce("paid_amount", F.lit(0).cast("decimal(22,2)"))).alias("lifetime_paid_amount"),
            F.sum(F.coalesce("refunded_amount", F.lit(0).cast("decimal(22,2)"))).alias("lifetime_refunded_amount"),
        )
    )
    chosen = in_range(totals, "last_order_date", start, end, lookback_from)
    current = customers.where("is_current").select(
        F.col("customer_id").alias("__customer_id"),
        "customer_sk",
        "customer_name",
        "email",
        "customer_grade",
        "marketing_opt_in",
    )
    ltv = F.col("customer_ltv")
    today = F.current_date() if as_of is None else _day(as_of.date())
    return (
        chosen.withColumn(
            "customer_ltv", (F.col("lifetime_paid_amount") - F.col("lifetime_refunded_amount")).cast("decimal(22,2)")
        )
        .join(current, F.col("customer_id") == F.col("__customer_id"), "left")
        .select(
            "customer_id",
            "customer_sk",
            "customer_name",
            "email",
            "customer_grade",
            "marketing_opt_in",
            "first_order_date",
            "last_order_date",
            days_between(today, F.col("last_order_date")).alias("days_since_last_order"),
            "lifetime_order_count",
            "lifetime_paid_amount",
            "lifetime_refunded_amount",
            "customer_ltv",
            divide_exact(ltv, F.col("lifetime_order_count").cast("decimal(12,0)"), 29).alias("avg_order_value"),
            F.when(ltv >= HIGH_VALUE_LTV, "high_value")
            .when(F.col("lifetime_order_count") >= REPEAT_ORDERS, "repeat")
            .otherwise("new_or_low")
            .alias("customer_segment"),
            loaded_at(as_of).alias("mart_loaded_at"),
        )
    )


def mart_monthly_retention(
    orders: DataFrame,
    ltv: DataFrame,
    start: date | None = None,
    end: date | None = None,
    lookback_from: date | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Customers of a first-order month that ordered again, per month and segment.

    A customer has one row per month, so counting rows counts customers, and a
    cohort's size is its own count in month 0: one pass over the orders.
    """
    valid = (
        orders.where(not_deleted() & F.col("order_status").isin(REVENUE_STATUSES))
        .where(F.col("customer_id").isNotNull())
        .select("customer_id", "order_date")
    )
    first, last, since = _month_start(start), _month_end(end), _month_start(lookback_from)
    if is_bounded(start, end, lookback_from):
        # A customer of a cohort has an order in the cohort's month.
        (valid,) = only_matching([valid], in_range(valid, "order_date", first, last, since).select("customer_id"))
    months = valid.select("customer_id", F.trunc("order_date", "month").alias("order_month")).distinct()
    cohort = F.min("order_month").over(Window.partitionBy("customer_id"))
    members = in_range(
        months.withColumn("cohort_month", cohort).where(F.col("order_month").isNotNull()),
        "cohort_month",
        first,
        last,
        since,
    )
    segments = ltv.select(F.col("customer_id").alias("__customer_id"), "customer_segment")
    cells = (
        members.join(segments, F.col("customer_id") == F.col("__customer_id"), "left")
        .groupBy(
            "cohort_month",
            "order_month",
            months_between_starts(F.col("order_month"), F.col("cohort_month")).alias("months_since_cohort"),
            F.coalesce("customer_segment", F.lit(UNKNOWN)).alias("customer_segment"),
        )
        .agg(F.count("*").alias("retained_customer_count"))
    )
    size = F.max(F.when(F.col("months_since_cohort") == 0, F.col("retained_customer_count"))).over(
        Window.partitionBy("cohort_month", "customer_segment")
    )
    return cells.withColumn("cohort_customer_count", size).select(
        "cohort_month",
        "order_month",
        "months_since_cohort",
        "customer_segment",
        "cohort_customer_count",
        "retained_customer_count",
        safe_divide(F.col("retained_customer_count"), F.col("cohort_customer_count")).alias("retention_rate"),
        loaded_at(as_of).alias("mart_loaded_at"),
    )
