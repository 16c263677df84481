"""One function per registered query: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions import hash_of, utc, utc_like
from tidemark.operators import (
    asof_join,
    dedupe_latest,
    extract_window,
    high_water_filter,
    lead_within_key,
    merge_upsert,
    scd2_incremental,
    scd2_initial,
    stamp_lineage,
)
from tidemark.plans import core, marts
from tidemark.plans.batch import BatchConfig, Warehouse, all_or_raise, extract_table, load_raw, side_by_side
from tidemark.plans.control import ControlState
from tidemark.plans.staging import standardize
from tidemark.quality import Check, checks
from tidemark.quality import run as run_checks
from tidemark.quality.checks import FAILED
from tidemark.quality.declared import final_suite
from tidemark.registry.inputs import Mapped, customer_log, load, load_naive, money, purchases
from tidemark.session import pin_result_settings, shared_folder, stored
from tidemark.sources.store import Layout, TableStore

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

AS_OF = datetime(2002, 1, 1)
SPLIT = datetime(2024, 1, 15)
SENTINEL_COLUMNS = {"effective_from", "effective_to"}


def comparable(df: DataFrame) -> DataFrame:
    """Plain types for the comparison: naive timestamps, wide integers and decimals.

    Version bounds become text because their open end is outside the range of
    nanosecond timestamps some clients convert to.
    """
    out = []
    for f in df.schema:
        value = f"`{f.name}`"
        if f.name in SENTINEL_COLUMNS:
            value = f"date_format({value}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        elif isinstance(f.dataType, T.TimestampType):
            value = f"cast({value} as timestamp_ntz)"
        elif isinstance(f.dataType, T.IntegerType):
            value = f"cast({value} as bigint)"
        elif isinstance(f.dataType, T.DecimalType):
            value = f"cast({value} as decimal(38,{f.dataType.scale}))"
        out.append(f"{value} as `{f.name}`")
    return df.selectExpr(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_result_settings(spark)
        return comparable(fn(spark, sf_dir))

    # A trailing underscore keeps a query apart from the operator of that name.
    name = fn.__name__.rstrip("_")
    run.__name__ = name
    run.__doc__ = fn.__doc__
    REGISTRY[name] = run
    return run


# -- row selection ---------------------------------------------------------------


@query
def dedupe_latest_lineitem(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem")
    return dedupe_latest(
        df, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )


@query
def dedupe_latest_events(spark, sf_dir):
    return dedupe_latest(load(spark, sf_dir, "events"), ["user_id"], ["ts"])


@query
def extract_window_events(spark, sf_dir):
    """Both bounds are event times of the data, so the open and the closed end matter."""
    events = load_naive(spark, sf_dir, "events")
    bounds = events.agg(
        F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("lo"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("hi"),
    ).first()
    lower, upper = datetime.fromisoformat(bounds["lo"]), datetime.fromisoformat(bounds["hi"])
    return stamp_lineage(
        extract_window(events, "ts", lower, upper), date(2024, 2, 1), datetime(2024, 2, 1), "events", "b1"
    )


@query
def incremental_high_water(spark, sf_dir):
    """Rows at or above the newest row of a target that ends at the split."""
    events = load_naive(spark, sf_dir, "events")
    return high_water_filter(events, events.where(F.col("ts") < utc_like(events, "ts", SPLIT)), "ts")


@query
def row_hash_customers(spark, sf_dir):
    df = Mapped(spark, sf_dir).stg("customers")
    hashed = df.withColumn("row_hash", hash_of(df, core.CUSTOMER_TRACKED))
    return hashed.select(
        "customer_id", "row_hash", hash_of(hashed, ["customer_id", "updated_at", "row_hash"]).alias("customer_sk")
    )


# -- staging ----------------------------------------------------------------------


def _staging_query(table: str) -> None:
    def fn(spark, sf_dir):
        return Mapped(spark, sf_dir).stg(table)

    fn.__name__ = f"stg_{table}"
    fn.__doc__ = f"Staging of {table}."
    query(fn)


for _table in S.ENTITIES:
    _staging_query(_table)


# -- dimensions ----------------------------------------------------------------------


@query
def dim_date(spark, sf_dir):
    """The calendar of the order dates, with the number of orders per day."""
    days = load(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date_day")).agg(
        F.count("*").alias("order_count")
    )
    return core.dim_date(spark, date(1995, 1, 1), date(2001, 12, 31)).join(days, "date_day", "left")


def _upserted(spark, name: str, first: DataFrame, second: DataFrame) -> DataFrame:
    """Table after a first load and an incremental one that starts at its high-water mark."""
    target = core.TARGETS[name]
    store = TableStore(spark, shared_folder(spark, name))
    store.merge(name, first, target.key, target.layout)
    store.merge(name, high_water_filter(second, store.read(name)), target.key, target.layout)
    return store.read(name)


@query
def dim_category_upsert(spark, sf_dir):
    """All categories; then those with a long name are renamed a day later."""
    first = Mapped(spark, sf_dir).dim_category
    renamed = first.where("length(category_name) > 5").withColumns(
        {
            "category_name": F.lower("category_name"),
            "updated_at": F.col("updated_at") + F.expr("interval 1 day"),
        }
    )
    return _upserted(spark, "dim_category", first, renamed)


@query
def dim_coupon_upsert(spark, sf_dir):
    """Coupons below 5,000 are loaded; then all arrive, the others new and those below 2,000 changed."""
    every = core.dim_coupon(Mapped(spark, sf_dir).stg("coupons"))
    changed = every.withColumns(
        {
            "discount_value": F.when(F.col("discount_value") < 2000, F.lit(5).cast("decimal(12,2)")).otherwise(
                F.col("discount_value")
            ),
            "updated_at": F.col("updated_at") + F.expr("interval 1 day"),
        }
    )
    return _upserted(spark, "dim_coupon", every.where("discount_value < 5000"), changed)


def _customer_versions(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_sk",
        "customer_id",
        "customer_grade",
        "email",
        "effective_from",
        "effective_to",
        "is_current",
        "row_hash",
    )


@query
def scd2_initial_history(spark, sf_dir):
    """Every row of the change log becomes a version."""
    return _customer_versions(core.dim_customer(customer_log(spark, sf_dir), history=True))


@query
def scd2_initial_history_split_keys(spark, sf_dir):
    """As above, with every key above 20 rows cut into ordered chunks."""
    return _customer_versions(
        scd2_initial(
            customer_log(spark, sf_dir),
            "customer_id",
            core.CUSTOMER_TRACKED,
            "customer_sk",
            core.CUSTOMER_UNTRACKED,
            hot_rows=20,
            chunk_rows=2_000,
        )
    )


@query
def scd2_initial_deduped(spark, sf_dir):
    """Staging keeps one row per key, so each key has one open version."""
    return _customer_versions(core.dim_customer(standardize(customer_log(spark, sf_dir), "customers")))


@query
def scd2_incremental_(spark, sf_dir):
    """A dimension of the users seen on the first day, then the whole log: new, changed and equal users."""
    log = customer_log(spark, sf_dir)
    early = log.where(F.col("updated_at") < utc("2024-01-02"))
    existing = core.dim_customer(standardize(early, "customers"))
    versions = scd2_incremental(
        standardize(log, "customers"),
        existing,
        "customer_id",
        core.CUSTOMER_TRACKED,
        "customer_sk",
        core.CUSTOMER_UNTRACKED,
    )
    return _customer_versions(merge_upsert(existing, versions, ["customer_sk"]))


@query
def dim_product_scd2(spark, sf_dir):
    """Parts loaded at their first price, then the price rise as an incremental run."""
    raw = Mapped(spark, sf_dir).raw("products")
    before = raw.where(F.col("updated_at") < utc("1998-01-01"))
    existing = core.dim_product(standardize(before, "products"))
    versions = core.dim_product(standardize(raw, "products"), existing)
    merged = merge_upsert(existing, versions, ["product_sk"])
    return merged.drop("created_at", "extract_date", "loaded_at")


# -- facts ---------------------------------------------------------------------------


@query
def fact_order_asof(spark, sf_dir):
    """Purchases with the customer version of their time."""
    customers = core.dim_customer(customer_log(spark, sf_dir), history=True)
    facts = core.fact_order(standardize(purchases(spark, sf_dir), "orders"), customers)
    return facts.select("order_id", "customer_id", "customer_sk", "order_at", "order_date", "total_amount")


@query
def fact_order_item_asof(spark, sf_dir):
    """Line items with the order date and the product version at order time."""
    return Mapped(spark, sf_dir).fact_order_item.drop("created_at", "extract_date", "loaded_at")


def _order_versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A customer's orders as versions, and the shipping times of their items as probes."""
    orders = load(spark, sf_dir, "orders")
    log = orders.select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderkey").alias("version_order"),
        F.col("o_orderdate").alias("effective_from"),
    )


    versions = lead_within_key(log, "custkey", ["effective_from", "version_order"], "effective_from", "next").select(
        "custkey",
        "version_order",
        "effective_from",
        F.coalesce("next", utc("9999-12-31")).alias("effective_to"),
    )
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    probes = lines.join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("custkey")), "l_orderkey"
    )
    return probes, versions


@query
def asof_join_shipments(spark, sf_dir):
    """The order a customer had placed last when an item was shipped."""
    probes, versions = _order_versions(spark, sf_dir)
    return asof_join(probes, versions, "custkey", "l_shipdate", {"version_order": "version_order"})


@query
def asof_join_split_keys(spark, sf_dir):
    """As above, with every key above 5 versions looked up by the sort-based way."""
    probes, versions = _order_versions(spark, sf_dir)
    return asof_join(
        probes,
        versions,
        "custkey",
        "l_shipdate",
        {"version_order": "version_order"},
        hot_versions=5,
        chunk_rows=10_000,
    )


def _shipping_versions(spark, sf_dir) -> DataFrame:
    """An item is open at its supplier from the order to the shipment: intervals of a supplier overlap. Read several times, so written first."""
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    open_items = lines.join(orders, "l_orderkey").select(
        "l_suppkey",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("open_item"),
        F.least("o_orderdate", "l_shipdate").alias("effective_from"),
        F.greatest("o_orderdate", "l_shipdate").alias("effective_to"),
    )
    return stored(open_items, "open-items")


@query
def asof_join_overlapping(spark, sf_dir):
    """The items a supplier had open in the first instant of every month; every supplier goes through parts of its time line."""
    versions = _shipping_versions(spark, sf_dir)

    starts = load(spark, sf_dir, "orders").select(F.date_trunc("month", "o_orderdate").alias("month")).distinct()
    keys = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    shipped = versions.select("l_suppkey", F.date_trunc("month", "effective_to").alias("month")).distinct()
    probes = shipped.join(starts, "month", "left_semi").join(keys, "l_suppkey", "left_semi")
    found = asof_join(
        probes, versions, "l_suppkey", "month", {"open_item": "open_item"}, hot_versions=20, chunk_rows=20_000, span=16
    )
    return found.groupBy("l_suppkey", "month").agg(F.count("open_item").alias("open_items"), F.sum("open_item").alias("item_sum"))


@query
def fact_payment(spark, sf_dir):
    return Mapped(spark, sf_dir).fact_payment


@query
def fact_shipment(spark, sf_dir):
    return core.fact_shipment(Mapped(spark, sf_dir).stg("shipments"))


@query
def fact_inventory_snapshot(spark, sf_dir):
    return core.fact_inventory_snapshot(Mapped(spark, sf_dir).stg("inventory_snapshots"))


@query
def fact_order_status_history(spark, sf_dir):
    return core.fact_order_status_history(Mapped(spark, sf_dir).stg("order_status_history"))


# -- writes: the end state of stored tables --------------------------------------------


def _order_rows(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.to_date(F.trunc("o_orderdate", "month")).alias("order_month"),
        money("o_totalprice").alias("total_amount"),
    )


@query
def merge_upsert_(spark, sf_dir):
    """Orders in progress and open ones are stored; then finished and open ones arrive, the latter changed."""
    rows = _order_rows(spark, sf_dir)
    store = TableStore(spark, shared_folder(spark, "merge"))
    store.merge("orders", rows.where("order_status in ('P', 'O')"), ["order_id"])
    changed = rows.where("order_status in ('F', 'O')").withColumn("total_amount", F.lit(1).cast("decimal(12,2)"))
    store.merge("orders", changed, ["order_id"])
    store.merge("orders", changed, ["order_id"])
    return store.read("orders")


@query
def merge_moved_partition(spark, sf_dir):
    """All orders of the first stored month and all finished ones move two years on: old copies must go."""
    rows = _order_rows(spark, sf_dir)
    store = TableStore(spark, shared_folder(spark, "moved"))
    layout = Layout(("order_month",), ("order_id",))
    store.merge("orders", rows, ["order_id"], layout)
    moving = rows.where("order_status = 'F' or order_month = date '1995-01-01'")
    store.merge(
        "orders", moving.withColumn("order_month", F.add_months("order_month", 24)), ["order_id"], layout
    )
    return store.read("orders")


@query
def merge_located(spark, sf_dir):
    """Old copies found by the key locator: all orders, then finished ones move two years on, then every seventh order comes back."""
    rows = _order_rows(spark, sf_dir)
    store = TableStore(spark, shared_folder(spark, "located"), locate=True)
    layout = Layout(("order_month",), ("order_id",))
    store.merge("orders", rows, ["order_id"], layout)
    moved = rows.where("order_status = 'F'").withColumn("order_month", F.add_months("order_month", 24))
    store.merge("orders", moved, ["order_id"])
    store.merge("orders", rows.where("order_id % 7 = 0").withColumn("total_amount", F.lit(7).cast("decimal(12,2)")), ["order_id"])
    return store.read("orders")


@query
def extract_order(spark, sf_dir):
    """Rows of the landed files in file order: how many come after a row of a later change time or, at the same time, a greater key."""
    source = Mapped(spark, sf_dir)
    wh = Warehouse(spark, shared_folder(spark, "landed"))
    cfg = BatchConfig("", datetime(2003, 1, 1), date(2026, 1, 1), "b1")
    folder, rows = extract_table(wh, source, "orders", datetime(1970, 1, 1), cfg.end_watermark, cfg, datetime(2026, 1, 1))
    landed = spark.read.parquet(folder).select("_metadata.file_path", "_metadata.row_index", "updated_at", "order_id")
    place = F.struct("updated_at", "order_id")
    before = F.lag(place).over(Window.partitionBy("file_path").orderBy("row_index"))
    return landed.select((before > place).alias("late")).agg(
        F.count("*").alias("landed_rows"), F.count_if("late").alias("out_of_order"), F.lit(rows).cast("long").alias("counted_rows")
    )


@query
def audit_append(spark, sf_dir):
    """Load results of two batches; the second is loaded twice, and every load stays on record."""
    source = Mapped(spark, sf_dir)
    wh = Warehouse(spark, shared_folder(spark, "audit"))
    state = ControlState(wh.audit)
    now = datetime(2026, 1, 1)
    start, middle, end = datetime(1970, 1, 1), datetime(1998, 1, 1), datetime(2003, 1, 1)
    for batch_id, lower, upper in (("b1", start, middle), ("b2", middle, end), ("b2", middle, end)):
        found = []
        for table in ("orders", "order_items"):
            cfg = BatchConfig("", upper, date(2026, 1, 1), batch_id)
            folder, _ = extract_table(wh, source, table, lower, upper, cfg, now)
            rows = load_raw(wh, folder, table, batch_id, now)
            found.append({"batch_id": batch_id, "source_table": table, "target_table": f"raw.{table}", "status": "raw_load_success", "row_count": rows, "started_at": now, "finished_at": now})
        state.audit_load(found)
    return wh.audit.read("raw_load_runs").select("batch_id", "source_table", "target_table", "status", "row_count", "started_at", "finished_at")


@query
def raw_batch_reload(spark, sf_dir):
    """Two batches; the first is loaded again under another extract date and with fewer rows."""
    source = Mapped(spark, sf_dir)
    wh = Warehouse(spark, shared_folder(spark, "reload"))
    now = datetime(2026, 1, 1, 1)

    def batch(batch_id: str, day: date, lower: datetime, upper: datetime) -> None:
        cfg = BatchConfig("", upper, day, batch_id)
        folder, _ = extract_table(wh, source, "orders", lower, upper, cfg, datetime(2026, 1, 1))
        load_raw(wh, folder, "orders", batch_id, now)

    start, middle, end = datetime(1970, 1, 1), datetime(1998, 1, 1), datetime(2003, 1, 1)
    batch("b1", date(2026, 1, 1), start, middle)
    batch("b2", date(2026, 1, 1), middle, end)
    batch("b1", date(2026, 1, 2), start, datetime(1997, 1, 1))
    return wh.raw.read("orders").select(
        "order_id", "order_status", "order_at", "total_amount", "extract_date", "source_table", "batch_id", "loaded_at"
    )


def _sales_by_month(items: DataFrame) -> DataFrame:
    """A small report to overwrite: shipped quantity per month and return flag."""
    return items.groupBy(
        F.to_date(F.trunc("l_shipdate", "month")).alias("ship_month"), F.col("l_returnflag").alias("flag")
    ).agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


def _stored_report(spark, sf_dir, first_filter: str, second_filter: str, clear_range) -> DataFrame:
    items = load(spark, sf_dir, "lineitem")
    store = TableStore(spark, shared_folder(spark, "report"))
    layout = Layout(("ship_month",), ("flag",))
    store.overwrite_partitions("report", _sales_by_month(items.where(first_filter)), layout)
    store.overwrite_partitions("report", _sales_by_month(items.where(second_filter)), layout, clear_range)
    return store.read("report")


@query
def partition_overwrite(spark, sf_dir):
    """A second load with returned items of two years replaces those months and no others."""
    return _stored_report(
        spark, sf_dir, "true", "l_returnflag = 'R' and year(l_shipdate) in (1996, 1999)", None
    )


@query
def backfill_range(spark, sf_dir):
    """The same for two years, where the second load has no rows in one of them: that year is cleared."""
    return _stored_report(
        spark, sf_dir, "true", "l_returnflag = 'R' and year(l_shipdate) = 1996", ("1996-01-01", "1997-12-31")
    )


# -- marts ----------------------------------------------------------------------------


def _daily_sales(spark, sf_dir, **bounds) -> DataFrame:
    m = Mapped(spark, sf_dir)
    mart = marts.mart_daily_sales(
        m.fact_order_item, m.dim_category, m.fact_order, m.fact_payment, as_of=AS_OF, **bounds
    )
    return mart.drop("mart_loaded_at")


@query
def mart_daily_sales(spark, sf_dir):
    return _daily_sales(spark, sf_dir)


@query
def mart_daily_sales_range(spark, sf_dir):
    """The explicit reporting range, both ends included."""
    return _daily_sales(spark, sf_dir, start=date(1997, 3, 1), end=date(1997, 4, 30))


@query
def mart_daily_sales_lookback(spark, sf_dir):
    """The look-back branch of an incremental run, seven days before the given day."""
    return _daily_sales(
        spark, sf_dir, lookback_from=date(2001, 8, 1) - timedelta(days=marts.SALES_LOOKBACK_DAYS)
    )


def _product_sales(spark, sf_dir, **bounds) -> DataFrame:
    m = Mapped(spark, sf_dir)
    mart = marts.mart_product_sales(
        m.fact_order_item, m.fact_order, m.dim_product, m.dim_category, as_of=AS_OF, **bounds
    )
    return mart.drop("mart_loaded_at")


@query
def mart_product_sales(spark, sf_dir):
    return _product_sales(spark, sf_dir)


@query
def mart_product_sales_range(spark, sf_dir):
    """The explicit reporting range, both ends included."""
    return _product_sales(spark, sf_dir, start=date(1997, 3, 1), end=date(1997, 4, 30))


def _ltv(m: Mapped, **bounds) -> DataFrame:
    return marts.mart_customer_ltv(m.fact_order, m.fact_payment, m.dim_customer, as_of=AS_OF, **bounds)


@query
def mart_customer_ltv(spark, sf_dir):
    return _ltv(Mapped(spark, sf_dir)).drop("mart_loaded_at")


@query
def mart_customer_ltv_lookback(spark, sf_dir):
    """Customers whose last order lies in the thirty days before the given day; orders without a customer are one of them."""
    since = date(2001, 8, 1) - timedelta(days=marts.LTV_LOOKBACK_DAYS)
    return _ltv(Mapped(spark, sf_dir), lookback_from=since).drop("mart_loaded_at")


@query
def mart_monthly_retention_range(spark, sf_dir):
    """Cohorts of the months the range touches, with all their later months."""
    m = Mapped(spark, sf_dir)
    mart = marts.mart_monthly_retention(
        m.fact_order, _ltv(m), start=date(1997, 3, 10), end=date(1997, 4, 20), as_of=AS_OF
    )
    return mart.drop("mart_loaded_at")


@query
def mart_monthly_retention_lookback(spark, sf_dir):
    """The look-back branch of an incremental run: cohorts of the twelve months before the given day."""
    m = Mapped(spark, sf_dir)
    since = date(2001, 8, 1).replace(year=2001 - marts.RETENTION_LOOKBACK_MONTHS // 12)
    return marts.mart_monthly_retention(m.fact_order, _ltv(m), lookback_from=since, as_of=AS_OF).drop("mart_loaded_at")


@query
def mart_monthly_retention(spark, sf_dir):
    m = Mapped(spark, sf_dir)
    return marts.mart_monthly_retention(m.fact_order, _ltv(m), as_of=AS_OF).drop("mart_loaded_at")


# -- data quality: each check on data that violates it -----------------------------------


def _counted(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    return check.failures(tables).select(F.lit(check.name).alias("check_name"), FAILED)


@query
def dq_not_null(spark, sf_dir):
    """Customers whose negative balance is taken as unknown."""
    df = load(spark, sf_dir, "customer").withColumn("balance", F.expr("if(c_acctbal < 0, null, c_acctbal)"))
    return _counted(checks.not_null("test", "customer", "balance"), {"customer": df})


@query
def dq_unique(spark, sf_dir):
    return _counted(checks.unique("test", "events", ["user_id"]), {"events": load(spark, sf_dir, "events")})


@query
def dq_unique_composite(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem")
    return _counted(checks.unique("test", "lineitem", ["l_orderkey", "l_linenumber"]), {"lineitem": df})


@query
def dq_relationships(spark, sf_dir):
    """Items whose order is not finished miss it in the finished orders."""
    tables = {
        "lineitem": load(spark, sf_dir, "lineitem"),
        "orders": load(spark, sf_dir, "orders").where("o_orderstatus = 'F'"),
    }
    return _counted(checks.relationship("test", "lineitem", "l_orderkey", "orders", "o_orderkey"), tables)


@query
def dq_accepted_values(spark, sf_dir):
    df = load(spark, sf_dir, "events")
    return _counted(checks.accepted_values("test", "events", "event_type", ["view", "click"]), {"events": df})


@query
def dq_range(spark, sf_dir):
    return _counted(checks.at_least("test", "customer", "c_acctbal"), {"customer": load(spark, sf_dir, "customer")})


@query
def dq_scd_one_current(spark, sf_dir):
    """Users with more than one event counted as current."""
    df = load(spark, sf_dir, "events").withColumn("is_current", F.col("event_type") == "signup")
    return _counted(checks.one_current_row("test", "events", "user_id"), {"events": df})


@query
def dq_row_count(spark, sf_dir):
    """The raw side lost the orders in progress."""
    orders = load(spark, sf_dir, "orders")
    tables = {"fact_order": orders, "raw_orders": orders.where("o_orderstatus <> 'P'")}
    return _counted(checks.row_count_not_below("test", "fact_order", "o_orderkey", "raw_orders"), tables)


@query
def dq_metric_sanity(spark, sf_dir):
    """Monthly sums of customer balances per nation, some of which are negative."""
    df = load(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.sum(money("c_acctbal") - F.lit(4500)).alias("balance")
    )
    check = checks.at_least("test", "balances", "balance", check_type="metric_sanity")
    return _counted(check, {"balances": df})


@query
def dq_mart_reconcile(spark, sf_dir):
    """A mart in which every day with more than 6 items reports 2 too much."""
    m = Mapped(spark, sf_dir)
    items = m.stg("order_items").join(m.stg("orders").select("order_id", "order_date"), "order_id", "left")
    statuses = m.stg("orders").select("order_id", "order_status", "is_deleted")
    mart = (
        items.join(statuses.drop("is_deleted"), "order_id", "left")
        .groupBy(F.col("order_date").alias("sales_date"))
        .agg(
            (
                F.sum(F.when(F.col("order_status").isin(S.REVENUE_STATUSES), F.col("item_amount")).otherwise(0))
                + F.when(F.count("*") > 6, 2).otherwise(0)
            ).alias("daily_revenue")
        )
    )
    check = checks.mart_matches_facts("test", "mart", "items", "orders", S.REVENUE_STATUSES)
    return _counted(check, {"mart": mart, "items": items, "orders": statuses})


@query
def dq_freshness(spark, sf_dir):
    """Newest purchase and newest click against a limit of one and of three days."""
    df = load(spark, sf_dir, "events")
    as_of = datetime(2024, 2, 1)
    rows = None
    for kind, days in (("purchase", 1), ("click", 3)):
        check = checks.freshness(
            "test", "events", kind, as_of, timedelta(days=days), name=f"{kind}_freshness", col="ts"
        )
        counted = _counted(check, {kind: df.where(F.col("event_type") == kind)})
        rows = counted if rows is None else rows.unionByName(counted)
    return rows


@query
def dq_source_freshness(spark, sf_dir):
    """Three sources, fresh, late and too late."""
    df = load(spark, sf_dir, "events")
    raw = {
        "all": df,
        "to_day_29": df.where(F.col("ts") < utc("2024-01-29 12:00:00")),
        "to_day_15": df.where(F.col("ts") < utc(SPLIT)),
    }
    return checks.source_freshness(raw, datetime(2024, 1, 31), col="ts")


# What the checks of the final suite, and the marts they look at, read of the tables that grow.
SUITE_READS = {
    "raw_orders": ["order_id", "loaded_at"],
    "fact_order": ["order_id", "order_status", "order_at", "order_date", "total_amount", "is_deleted"],
    "fact_payment": ["order_id", "payment_status", "payment_amount", "is_deleted"],
    "fact_order_item": [
        "order_item_id", "order_id", "order_date", "product_id", "product_sk", "category_id", "quantity", "discount_amount",
        "item_amount", "is_deleted",
    ],
    "mart_daily_sales": ["sales_date", "category_id", "daily_revenue"],
    "mart_product_sales": ["sales_date", "product_id", "quantity_sold"],
}


@query
def dq_suite(spark, sf_dir):
    """The whole final suite over the mapped warehouse, with results as they are recorded.

    All rows of all tables are built; they are kept for the checks and marts with the columns these read.
    """
    m = Mapped(spark, sf_dir)
    store = TableStore(spark, shared_folder(spark, "suite"))
    built = {
        "raw_orders": m.raw("orders"),
        "fact_order": m.fact_order,
        "fact_payment": m.fact_payment,
        "dim_customer": m.dim_customer,
        "dim_product": m.dim_product,
        "dim_category": m.dim_category,
    }

    def keep(tables: dict[str, DataFrame]) -> None:
        read = {name: df.select(SUITE_READS.get(name, df.columns)) for name, df in tables.items()}
        jobs = {name: lambda name=name, df=df: store.overwrite(name, df) for name, df in read.items()}
        all_or_raise(side_by_side(spark, jobs))
        t.update({name: store.read(name) for name in tables})

    t: dict[str, DataFrame] = {}
    keep(built)
    # Items of the largest quantity are made to point at an order that does not exist.
    items = core.fact_order_item(m.stg("order_items"), t["fact_order"], t["dim_product"]).withColumn(
        "order_id", F.when(F.col("quantity") == 50, -F.col("order_id") - 1).otherwise(F.col("order_id"))
    )
    keep({"fact_order_item": items})
    sales = marts.mart_daily_sales(t["fact_order_item"], t["dim_category"], t["fact_order"], t["fact_payment"], as_of=AS_OF)
    products = marts.mart_product_sales(t["fact_order_item"], t["fact_order"], t["dim_product"], t["dim_category"], as_of=AS_OF)
    keep({"mart_daily_sales": sales, "mart_product_sales": products})
    results = run_checks(
        spark,
        final_suite(datetime(2026, 1, 1, 12)),
        t,
        batch_id="b1",
        execution_date=date(2026, 1, 1),
        raise_on_failure=False,
    )
    return results.drop("check_id", "checked_at", "error_message")


# -- incremental state -----------------------------------------------------------------


def _two_extracts(spark, sf_dir, second_mode: str) -> DataFrame:
    """Watermarks after two extractions of three tables; the second ends in `second_mode`."""
    source = Mapped(spark, sf_dir)
    wh = Warehouse(spark, shared_folder(spark, "watermark"))
    state = ControlState(wh.audit)
    tables = ["orders", "order_items", "order_status_history"]
    now = datetime(2026, 1, 1)
    for batch_id, upper, mode in (
        ("b1", datetime(1998, 1, 1), "advance"),
        ("b2", datetime(2024, 1, 15), second_mode),
    ):
        known = state.watermark_rows()
        windows = {t: (state.last_success(t, known), upper) for t in tables}
        state.started(batch_id, date(2026, 1, 1), windows, now)
        done = {}
        for table, (lower, to) in windows.items():
            cfg = BatchConfig("", to, date(2026, 1, 1), batch_id)
            _, rows = extract_table(wh, source, table, lower, to, cfg, now)
            done[table] = {"row_count": rows, "status": "extract_success"}
        state.finished(batch_id, done, now)
        state.advance(mode, upper, {t: d["row_count"] for t, d in done.items()}, now)
    return wh.audit.read("etl_watermarks").select(
        "source_table", "last_success_watermark", "current_run_watermark", "status", "row_count"
    )


@query
def watermark_advance(spark, sf_dir):
    return _two_extracts(spark, sf_dir, "advance")


@query
def watermark_preserve(spark, sf_dir):
    return _two_extracts(spark, sf_dir, "preserve")


