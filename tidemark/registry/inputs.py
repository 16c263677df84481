"""The ten source entities, derived from the shared test tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import utc
from tidemark.operators.dedupe import RECENCY, dedupe_latest
from tidemark.operators.incremental import extract_window
from tidemark.plans import core
from tidemark.plans.staging import standardize
from tidemark.schemas import entity

# Fixed values of the mapping; the oracle SQL states the same ones.
BEFORE_ORDERS = "1994-12-31 00:00:00"
EXTRACT_DATE = "2026-01-01"
EXTRACTED_AT = "2026-01-01 00:00:00"
LOADED_AT = "2026-01-01 01:00:00"


# Declared, so that reading starts no job to look at file footers.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}


def load_naive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as stored."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its timestamps as UTC instants."""
    df = load_naive(spark, sf_dir, name)
    columns = [c.split() for c in SCHEMAS[name].split(", ")]
    return df.selectExpr(*[f"cast({c} as timestamp) as {c}" if t == "timestamp_ntz" else c for c, t in columns])


def money(col: str) -> Column:
    return F.col(col).cast("decimal(12,2)")


def category_id_of(p_type: Column) -> Column:
    """A number from the whole text (60 bits of its digest), computed row by row."""
    return F.conv(F.substring(F.md5(p_type), 1, 15), 16, 10).cast("long")


def product_category(part_key: str, p_type: str) -> Column:
    """The category of a part; some have none, the stand-in id, or one that no category has."""
    key = F.col(part_key)
    return (
        F.when(key % 19 == 0, F.lit(None).cast("long"))
        .when(key % 23 == 0, F.lit(-1).cast("long"))
        .when(key % 29 == 0, F.lit(999).cast("long"))
        .otherwise(category_id_of(F.col(p_type)))
    )


def deleted_flag(key: Column, deleted: int, unknown: int) -> Column:
    """True for keys divisible by the first number, unknown for others divisible by the second."""
    unset = F.when(key % unknown == 0, F.lit(None).cast("boolean")).otherwise(F.lit(False))
    return F.when(key % deleted == 0, F.lit(True)).otherwise(unset)


def as_raw(df: DataFrame, table: str, updated_at: Column, batch_id: str = "b1", **columns: Column) -> DataFrame:
    """Raw rows of an entity: the given columns, the common tail and the lineage."""
    tail = {
        "created_at": updated_at,
        "updated_at": updated_at,
        "is_deleted": F.lit(False),
        "extract_date": F.lit(EXTRACT_DATE),
        "extracted_at": utc(EXTRACTED_AT),
        "source_table": F.lit(table),
        "batch_id": F.lit(batch_id),
        "loaded_at": utc(LOADED_AT),
    }
    values = {**tail, **columns}
    return df.select(
        *[values[f.name].cast(f.dataType.simpleString()).alias(f.name) for f in entity(table).raw_schema]
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = load(spark, sf_dir, "part").select("p_type").distinct()
    return as_raw(
        kinds,
        "categories",
        utc(BEFORE_ORDERS),
        category_id=category_id_of(F.col("p_type")),
        parent_category_id=F.lit(None),
        category_name=F.col("p_type"),
        category_level=F.lit(1),
        is_active=F.lit(True),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part, and a second version with a higher price for the large sizes."""
    part = load(spark, sf_dir, "part")

    def version(df: DataFrame, price: Column, at: str) -> DataFrame:
        return as_raw(
            df,
            "products",
            utc(at),
            product_id=F.col("p_partkey"),
            category_id=product_category("p_partkey", "p_type"),
            product_name=F.col("p_name"),
            brand=F.col("p_brand"),
            list_price=price,
            product_status=F.lit("active"),
        )

    raised = version(part.where("p_size > 25"), money("p_retailprice") + F.lit(10), "1998-01-01 00:00:00")
    return version(part, money("p_retailprice"), BEFORE_ORDERS).unionByName(raised)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(
        load(spark, sf_dir, "customer"),
        "customers",
        utc(BEFORE_ORDERS),
        is_deleted=deleted_flag(F.col("c_custkey"), 17, 13),
        customer_id=F.col("c_custkey"),
        customer_name=F.col("c_name"),
        email=F.concat("c_name", F.lit("@EXAMPLE.COM")),
        phone_number=F.lit(None),
        address=F.col("c_nationkey").cast("string"),
        customer_grade=F.col("c_mktsegment"),
        marketing_opt_in=F.col("c_acctbal") > 0,
        signup_date=F.lit("1994-01-01"),
    )


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log: every event but purchases is a new version of its user."""
    return as_raw(
        load(spark, sf_dir, "events").where("event_type <> 'purchase'"),
        "customers",
        F.col("ts"),
        customer_id=F.col("user_id"),
        customer_name=F.concat(F.lit("user "), F.col("user_id").cast("string")),
        email=F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("@EXAMPLE.COM")),
        phone_number=F.lit(None),
        address=F.lit(None),
        customer_grade=F.col("event_type"),
        marketing_opt_in=F.lit(True),
        signup_date=F.lit("2023-12-31"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in event form, to be looked up in the change log."""
    return as_raw(
        load(spark, sf_dir, "events").where("event_type = 'purchase'"),
        "orders",
        F.col("ts"),
        order_id=F.col("event_id"),
        customer_id=F.col("user_id"),
        coupon_id=F.lit(None),
        order_status=F.lit("paid"),
        order_channel=F.lit("web"),
        order_at=F.col("ts"),
        subtotal_amount=money("value"),
        discount_amount=F.lit(0),
        shipping_fee=F.lit(0),
        total_amount=money("value"),
    )


def raw_coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(
        load(spark, sf_dir, "supplier"),
        "coupons",
        utc(BEFORE_ORDERS),
        coupon_id=F.col("s_suppkey"),
        coupon_code=F.concat(F.lit("CPN"), F.col("s_suppkey").cast("string")),
        coupon_name=F.col("s_name"),
        discount_type=F.lit("fixed_amount"),
        discount_value=F.abs(money("s_acctbal")),
        valid_from=utc("1995-01-01 00:00:00"),
        valid_to=utc("2002-01-01 00:00:00"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return as_raw(
        load(spark, sf_dir, "orders"),
        "orders",
        F.col("o_orderdate"),
        is_deleted=deleted_flag(F.col("o_orderkey"), 41, 43),
        order_id=F.col("o_orderkey"),
        customer_id=F.when(F.col("o_orderkey") % 47 != 0, F.col("o_custkey")),
        coupon_id=F.lit(None),
        order_status=F.when(status == "F", "delivered").when(status == "O", "paid").otherwise("created"),
        order_channel=F.col("o_orderpriority"),
        order_at=F.col("o_orderdate"),
        subtotal_amount=money("o_totalprice"),
        discount_amount=F.lit(0),
        shipping_fee=F.lit(0),
        total_amount=money("o_totalprice"),
    )


def _price() -> Column:
    """Some orders are free, so that their total is zero."""
    return F.when(F.col("l_orderkey") % 59 == 0, F.lit(0)).otherwise(money("l_extendedprice")).cast("decimal(12,2)")


def _discount() -> Column:
    return (_price() * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(12,2)")


def _item_amount() -> Column:
    return (_price() - _discount()).cast("decimal(12,2)")


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items at the price of their part; a repeated (order, line) is a later or earlier version of the item.

    Some items have lost their order, some are deleted, and of some that is unknown.
    """
    # Grouped, so that the planner knows a part has one row and leaves the join out where no price is read.
    prices = load(spark, sf_dir, "part").groupBy("p_partkey").agg(F.max(money("p_retailprice")).alias("unit_price"))
    lines = load(spark, sf_dir, "lineitem")
    item = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return as_raw(
        lines.join(prices, lines["l_partkey"] == prices["p_partkey"], "left"),
        "order_items",
        F.col("l_shipdate"),
        is_deleted=deleted_flag(item, 37, 31),
        order_item_id=item,
        order_id=F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey")),
        product_id=F.col("l_partkey"),
        quantity=F.col("l_quantity"),
        unit_price=F.col("unit_price"),
        discount_amount=_discount(),
        item_amount=_item_amount(),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished and open orders are paid; the latest versions of returned line items are refunded."""
    orders = load(spark, sf_dir, "orders")
    paid = orders.where("o_orderstatus in ('F', 'O')").select(
        (F.col("o_orderkey") * 2).alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.lit("paid").alias("status"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("at"),
    )
    latest = dedupe_latest(
        load(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        order_by=["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
    )
    refunds = (
        latest.where("l_returnflag = 'R'")
        .groupBy("l_orderkey")
        .agg(F.sum(_item_amount()).alias("amount"), F.max("l_shipdate").alias("at"))
        .select(
            (F.col("l_orderkey") * 2 + 1).alias("payment_id"),
            F.col("l_orderkey").alias("order_id"),
            F.lit("refunded").alias("status"),
            "amount",
            "at",
        )
    )
    return as_raw(
        paid.unionByName(refunds),
        "payments",
        F.col("at"),
        is_deleted=deleted_flag(F.col("payment_id"), 29, 31),
        payment_id=F.col("payment_id"),
        order_id=F.col("order_id"),
        payment_method=F.lit("card"),
        payment_status=F.col("status"),
        payment_amount=F.col("amount"),
        payment_at=F.col("at"),
        transaction_id=F.concat(F.lit("T"), F.col("payment_id").cast("string")),
    )


def raw_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_order = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), F.max("l_linestatus").alias("line")
        )
    )
    return as_raw(
        per_order,
        "shipments",
        F.col("last"),
        shipment_id=F.col("l_orderkey"),
        order_id=F.col("l_orderkey"),
        shipment_status=F.when(F.col("line") == "F", "delivered").otherwise("shipped"),
        carrier=F.lit("post"),
        tracking_number=F.concat(F.lit("S"), F.col("l_orderkey").cast("string")),
        shipped_at=F.col("first"),
        delivered_at=F.col("last"),
    )


def raw_inventory_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as stock counts; several per day and product, so one must win."""
    kinds = load(spark, sf_dir, "part").select("p_partkey", "p_type")
    lines = load(spark, sf_dir, "lineitem")
    return as_raw(
        lines.join(kinds, lines["l_partkey"] == kinds["p_partkey"], "left"),
        "inventory_snapshots",
        F.col("l_shipdate"),
        snapshot_date=F.to_date("l_shipdate"),
        product_id=F.col("l_partkey"),
        category_id=product_category("p_partkey", "p_type"),
        stock_quantity=F.col("l_quantity"),
        reserved_quantity=F.lit(0),
        available_quantity=F.col("l_quantity"),
    )


def raw_order_status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(
        load(spark, sf_dir, "events"),
        "order_status_history",
        F.col("ts"),
        order_status_history_id=F.col("event_id"),
        order_id=F.col("user_id"),
        previous_status=F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id")),
        new_status=F.col("event_type"),
        changed_at=F.col("ts"),
        change_reason=F.lit(None),
    )


RAW = {
    "categories": raw_categories,
    "customers": raw_customers,
    "products": raw_products,
    "coupons": raw_coupons,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "payments": raw_payments,
    "shipments": raw_shipments,
    "inventory_snapshots": raw_inventory_snapshots,
    "order_status_history": raw_order_status_history,
}


# Columns of the mapping that never break a tie, so that they need not move for it: they equal another column that is
# compared (the time of the change, the total) or follow from the key (the price is that of the product, which comes before it).
NO_TIEBREAK = ("created_at",)
NO_TIEBREAK_OF = {
    "orders": ("order_at", "subtotal_amount"),
    "order_items": ("unit_price",),
    "payments": ("payment_at", "transaction_id"),
}


class Mapped:
    """Staging, core and source views of the mapped test tables, each built once.

    The mapping gives a customer one version and a product at most two, so these
    dimensions need no search for keys with very many versions.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, table: str) -> DataFrame:
        return RAW[table](self.spark, self.sf_dir)

    def stg(self, table: str) -> DataFrame:
        raw = self.raw(table)
        first = {*entity(table).key, *RECENCY, *NO_TIEBREAK, *NO_TIEBREAK_OF.get(table, ())}
        tiebreak = [c for c in raw.columns if c not in first]
        if table != "order_items":
            return standardize(raw, table, tiebreak=tiebreak)
        # The versions of an item have one order, so the move by order serves the search for the latest and the join to the orders.
        return standardize(raw.repartition("order_id"), table, tiebreak=tiebreak, with_key=["order_id"])

    def window(self, spark: SparkSession, table: str, lower: datetime, upper: datetime) -> DataFrame:
        """As an extraction source: the source columns of the raw rows."""
        names = entity(table).source_schema.names
        return extract_window(self.raw(table).select(*names), "updated_at", lower, upper)

    @cached_property
    def dim_category(self) -> DataFrame:
        return core.dim_category(self.stg("categories"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return core.dim_customer(self.stg("customers"))

    @cached_property
    def dim_product(self) -> DataFrame:
        """Both price versions: the raw table is taken as a change log."""
        return core.dim_product(self.raw("products"), history=True, hot_rows=None)

    @cached_property
    def fact_order(self) -> DataFrame:
        return core.fact_order(self.stg("orders"), self.dim_customer, hot_versions=None)

    @cached_property
    def fact_order_item(self) -> DataFrame:
        return core.fact_order_item(
            self.stg("order_items"), self.fact_order, self.dim_product, hot_versions=None
        )

    @cached_property
    def fact_payment(self) -> DataFrame:
        return core.fact_payment(self.stg("payments"))
