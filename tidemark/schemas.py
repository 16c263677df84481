"""Declared schemas of the ten source entities and of the control tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

_TYPES = {
    "long": T.LongType(),
    "string": T.StringType(),
    "bool": T.BooleanType(),
    "money": MONEY,
    "date": T.DateType(),
    "ts": T.TimestampType(),
}


def fields(text: str) -> T.StructType:
    """`"order_id:long order_at:ts"` as a StructType; every column is nullable."""
    pairs = (item.split(":") for item in text.split())
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


SOURCE_TAIL = "created_at:ts updated_at:ts is_deleted:bool"
LINEAGE = "extract_date:date extracted_at:ts source_table:string batch_id:string"


@dataclass(frozen=True)
class Entity:
    """One source table: its natural key, its columns and how staging cleans it."""

    name: str
    key: tuple[str, ...]
    columns: str
    lower_case: tuple[str, ...] = ()
    date_of: tuple[tuple[str, str], ...] = ()  # (new date column, timestamp column)
    default_not_deleted: bool = False

    @property
    def source_schema(self) -> T.StructType:
        return fields(f"{self.columns} {SOURCE_TAIL}")

    @property
    def zone_schema(self) -> T.StructType:
        """Landed Parquet files: source columns plus lineage."""
        return fields(f"{self.columns} {SOURCE_TAIL} {LINEAGE}")

    @property
    def raw_schema(self) -> T.StructType:
        """The raw append log: landed columns plus the load time."""
        return fields(f"{self.columns} {SOURCE_TAIL} {LINEAGE} loaded_at:ts")

    @property
    def staging_schema(self) -> T.StructType:
        """Columns staging casts to: the raw columns without source_table."""
        return T.StructType([f for f in self.raw_schema if f.name != "source_table"])


# Names, order and types of the columns of the ten source tables.
_ALL = [
    Entity(
        "categories",
        ("category_id",),
        "category_id:long parent_category_id:long category_name:string category_level:long is_active:bool",
    ),
    Entity(
        "customers",
        ("customer_id",),
        "customer_id:long customer_name:string email:string phone_number:string address:string "
        "customer_grade:string marketing_opt_in:bool signup_date:date",
        lower_case=("email",),
    ),
    Entity(
        "products",
        ("product_id",),
        "product_id:long category_id:long product_name:string brand:string list_price:money product_status:string",
    ),
    Entity(
        "coupons",
        ("coupon_id",),
        "coupon_id:long coupon_code:string coupon_name:string discount_type:string discount_value:money "
        "valid_from:ts valid_to:ts",
    ),
    Entity(
        "orders",
        ("order_id",),
        "order_id:long customer_id:long coupon_id:long order_status:string order_channel:string order_at:ts "
        "subtotal_amount:money discount_amount:money shipping_fee:money total_amount:money",
        date_of=(("order_date", "order_at"),),
        default_not_deleted=True,
    ),
    Entity(
        "order_items",
        ("order_item_id",),
        "order_item_id:long order_id:long product_id:long quantity:long unit_price:money "
        "discount_amount:money item_amount:money",
        default_not_deleted=True,
    ),
    Entity(
        "payments",
        ("payment_id",),
        "payment_id:long order_id:long payment_method:string payment_status:string payment_amount:money "
        "payment_at:ts transaction_id:string",
        date_of=(("payment_date", "payment_at"),),
        default_not_deleted=True,
    ),
    Entity(
        "shipments",
        ("shipment_id",),
        "shipment_id:long order_id:long shipment_status:string carrier:string tracking_number:string "
        "shipped_at:ts delivered_at:ts",
    ),
    Entity(
        "inventory_snapshots",
        ("snapshot_date", "product_id"),
        "snapshot_date:date product_id:long category_id:long stock_quantity:long reserved_quantity:long "
        "available_quantity:long",
    ),
    Entity(
        "order_status_history",
        ("order_status_history_id",),
        "order_status_history_id:long order_id:long previous_status:string new_status:string changed_at:ts "
        "change_reason:string",
    ),
]

ENTITIES: dict[str, Entity] = {entity.name: entity for entity in _ALL}


def entity(name: str) -> Entity:
    if name not in ENTITIES:
        raise ValueError(f"unknown source table: {name}")
    return ENTITIES[name]


# Columns of the control and result tables.
WATERMARKS = fields(
    "pipeline_name:string source_table:string last_success_watermark:ts current_run_watermark:ts "
    "last_run_at:ts status:string row_count:long error_message:string created_at:ts updated_at:ts"
)
BATCH_RUNS = fields(
    "batch_id:string pipeline_name:string source_table:string extract_date:date last_success_watermark:ts "
    "current_run_watermark:ts uri:string row_count:long status:string error_message:string "
    "started_at:ts finished_at:ts"
)
RAW_LOAD_RUNS = fields(
    "batch_id:string source_table:string uri:string target_table:string row_count:long status:string "
    "error_message:string started_at:ts finished_at:ts"
)
QUALITY_RESULTS = fields(
    "check_id:string check_name:string check_type:string target_dataset:string target_table:string "
    "severity:string status:string failed_row_count:long checked_at:ts batch_id:string "
    "execution_date:date error_message:string"
)

# The status lists the source system uses.
CUSTOMER_GRADES = ["bronze", "silver", "gold", "vip"]
PRODUCT_STATUSES = ["active", "inactive", "discontinued"]
DISCOUNT_TYPES = ["fixed_amount", "percentage"]
ORDER_STATUSES = ["created", "paid", "shipped", "delivered", "cancelled", "refunded"]
PAYMENT_STATUSES = ["authorized", "paid", "failed", "cancelled", "refunded"]
SHIPMENT_STATUSES = ["ready", "shipped", "delivered", "returned"]
REVENUE_STATUSES = ["paid", "shipped", "delivered"]
CUSTOMER_SEGMENTS = ["high_value", "repeat", "new_or_low"]
