"""The registered queries as SQL over the same tables, written independently of the operators."""

from __future__ import annotations

import re

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _text(col: str) -> str:
    return f"coalesce(cast({col} as varchar), '__null__')"


def _stamp(col: str) -> str:
    return f"strftime({col}, {TS})"


def _md5(*parts: str) -> str:
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def _deleted(key: str, deleted: int, unknown: int) -> str:
    return f"case when {key} % {deleted} = 0 then true when {key} % {unknown} = 0 then null else false end"


def _tail(at: str, table: str, batch: str = "b1", deleted: str = "false") -> str:
    return f"""{at} as created_at, {at} as updated_at, {deleted} as is_deleted,
        date '2026-01-01' as extract_date, timestamp '2026-01-01 00:00:00' as extracted_at,
        '{table}' as source_table, '{batch}' as batch_id, timestamp '2026-01-01 01:00:00' as loaded_at"""


TAIL = ["created_at", "updated_at", "is_deleted", "extract_date", "extracted_at", "batch_id", "loaded_at"]


def _latest(raw: str, keys: str, columns: list[str]) -> str:
    """One row per key, newest first, remaining columns as tie-break."""
    ties = [c for c in [*columns, "created_at", "is_deleted", "extract_date", "batch_id"] if c not in keys.split(", ")]
    order = ", ".join(f"{c} desc nulls last" for c in ["updated_at", "extracted_at", "loaded_at", *ties])
    return f"""(select * from (select *, row_number() over (partition by {keys} order by {order}) as rn from {raw})
        where rn = 1)"""


CATEGORY_ID = "cast('0x' || substr(md5(p_type), 1, 15) as bigint)"
PRODUCT_CATEGORY = f"""case when p_partkey % 19 = 0 then null when p_partkey % 23 = 0 then -1
    when p_partkey % 29 = 0 then 999 else {CATEGORY_ID} end"""
MONEY = "cast({} as decimal(12,2))"
PRICE = f"cast(case when l_orderkey % 59 = 0 then 0 else {MONEY.format('l_extendedprice')} end as decimal(12,2))"
DISCOUNT = f"cast({PRICE} * cast(l_discount as decimal(4,2)) as decimal(12,2))"
ITEM_AMOUNT = f"cast({PRICE} - {DISCOUNT} as decimal(12,2))"
EARLY = "timestamp '1994-12-31 00:00:00'"

COLUMNS = {
    "categories": "category_id parent_category_id category_name category_level is_active",
    "customers": "customer_id customer_name email phone_number address customer_grade marketing_opt_in signup_date",
    "products": "product_id category_id product_name brand list_price product_status",
    "coupons": "coupon_id coupon_code coupon_name discount_type discount_value valid_from valid_to",
    "orders": "order_id customer_id coupon_id order_status order_channel order_at subtotal_amount discount_amount "
    "shipping_fee total_amount",
    "order_items": "order_item_id order_id product_id quantity unit_price discount_amount item_amount",
    "payments": "payment_id order_id payment_method payment_status payment_amount payment_at transaction_id",
    "shipments": "shipment_id order_id shipment_status carrier tracking_number shipped_at delivered_at",
    "inventory_snapshots": "snapshot_date product_id category_id stock_quantity reserved_quantity available_quantity",
    "order_status_history": "order_status_history_id order_id previous_status new_status changed_at change_reason",
}
KEYS = {
    "categories": "category_id",
    "customers": "customer_id",
    "products": "product_id",
    "coupons": "coupon_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "payments": "payment_id",
    "shipments": "shipment_id",
    "inventory_snapshots": "snapshot_date, product_id",
    "order_status_history": "order_status_history_id",
}
MONEY_COLUMNS = {
    "list_price",
    "discount_value",
    "subtotal_amount",
    "discount_amount",
    "shipping_fee",
    "total_amount",
    "unit_price",
    "item_amount",
    "payment_amount",
}

# Common table expressions by name; `ctes` below adds the ones a query refers to.
CTES: dict[str, str] = {}

CTES["raw_categories"] = f"""select {CATEGORY_ID} as category_id, cast(null as bigint) as parent_category_id,
    p_type as category_name, cast(1 as bigint) as category_level, true as is_active,
    {_tail(EARLY, 'categories')} from (select distinct p_type from part)"""

_PRODUCT = """select p_partkey as product_id, {category} as category_id, p_name as product_name, p_brand as brand,
    cast({price} as decimal(12,2)) as list_price, 'active' as product_status, {tail} from part {where}"""
CTES["raw_products"] = (
    _PRODUCT.format(
        category=PRODUCT_CATEGORY, price=MONEY.format("p_retailprice"), tail=_tail(EARLY, "products"), where=""
    )
    + " union all "
    + _PRODUCT.format(
        category=PRODUCT_CATEGORY,
        price=MONEY.format("p_retailprice") + " + 10",
        tail=_tail("timestamp '1998-01-01 00:00:00'", "products"),
        where="where p_size > 25",
    )
)
CTES["raw_customers"] = f"""select c_custkey as customer_id, c_name as customer_name,
    c_name || '@EXAMPLE.COM' as email, cast(null as varchar) as phone_number,
    cast(c_nationkey as varchar) as address, c_mktsegment as customer_grade, c_acctbal > 0 as marketing_opt_in,
    date '1994-01-01' as signup_date,
    {_tail(EARLY, 'customers', deleted=_deleted('c_custkey', 17, 13))} from customer"""
CTES["customer_log"] = f"""select user_id as customer_id, 'user ' || user_id as customer_name,
    'U' || user_id || '@EXAMPLE.COM' as email, cast(null as varchar) as phone_number,
    cast(null as varchar) as address, event_type as customer_grade, true as marketing_opt_in,
    date '2023-12-31' as signup_date, {_tail('ts', 'customers')} from events where event_type <> 'purchase'"""
CTES["raw_coupons"] = f"""select s_suppkey as coupon_id, 'CPN' || s_suppkey as coupon_code, s_name as coupon_name,
    'fixed_amount' as discount_type, abs({MONEY.format('s_acctbal')}) as discount_value,
    timestamp '1995-01-01 00:00:00' as valid_from, timestamp '2002-01-01 00:00:00' as valid_to,
    {_tail(EARLY, 'coupons')} from supplier"""
CTES["raw_orders"] = f"""select o_orderkey as order_id,
    case when o_orderkey % 47 <> 0 then o_custkey end as customer_id, cast(null as bigint) as coupon_id,
    case o_orderstatus when 'F' then 'delivered' when 'O' then 'paid' else 'created' end as order_status,
    o_orderpriority as order_channel, o_orderdate as order_at,
    {MONEY.format('o_totalprice')} as subtotal_amount, cast(0 as decimal(12,2)) as discount_amount,
    cast(0 as decimal(12,2)) as shipping_fee, {MONEY.format('o_totalprice')} as total_amount,
    {_tail('o_orderdate', 'orders', deleted=_deleted('o_orderkey', 41, 43))} from orders"""
CTES["raw_order_items"] = f"""select l_orderkey * 10 + l_linenumber as order_item_id,
    case when l_orderkey % 97 <> 0 then l_orderkey end as order_id, l_partkey as product_id,
    cast(l_quantity as bigint) as quantity, {MONEY.format('p_retailprice')} as unit_price,
    {DISCOUNT} as discount_amount, {ITEM_AMOUNT} as item_amount,
    {_tail('l_shipdate', 'order_items', deleted=_deleted('(l_orderkey * 10 + l_linenumber)', 37, 31))}
    from lineitem left join part on l_partkey = p_partkey"""
CTES["raw_payments"] = f"""select payment_id, order_id, 'card' as payment_method, payment_status, payment_amount,
    paid_at as payment_at, 'T' || payment_id as transaction_id, {_tail('paid_at', 'payments', deleted=_deleted('payment_id', 29, 31))} from (
        select o_orderkey * 2 as payment_id, o_orderkey as order_id, 'paid' as payment_status,
            {MONEY.format('o_totalprice')} as payment_amount, o_orderdate as paid_at
        from orders where o_orderstatus in ('F', 'O')
        union all
        select l_orderkey * 2 + 1, l_orderkey, 'refunded', cast(sum({ITEM_AMOUNT}) as decimal(12,2)), max(l_shipdate)
        from (select *, row_number() over (partition by l_orderkey, l_linenumber
            order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as rn from lineitem)
        where rn = 1 and l_returnflag = 'R' group by l_orderkey)"""
CTES["raw_shipments"] = f"""select l_orderkey as shipment_id, l_orderkey as order_id,
    case when line = 'F' then 'delivered' else 'shipped' end as shipment_status, 'post' as carrier,
    'S' || l_orderkey as tracking_number, first_at as shipped_at, last_at as delivered_at,
    {_tail('last_at', 'shipments')} from (
        select l_orderkey, min(l_shipdate) as first_at, max(l_shipdate) as last_at, max(l_linestatus) as line
        from lineitem group by l_orderkey)"""
CTES["raw_inventory_snapshots"] = f"""select cast(l_shipdate as date) as snapshot_date, l_partkey as product_id,
    {PRODUCT_CATEGORY} as category_id, cast(l_quantity as bigint) as stock_quantity,
    cast(0 as bigint) as reserved_quantity, cast(l_quantity as bigint) as available_quantity,
    {_tail('l_shipdate', 'inventory_snapshots')} from lineitem left join part on l_partkey = p_partkey"""
CTES["raw_order_status_history"] = f"""select event_id as order_status_history_id, user_id as order_id,
    lag(event_type) over (partition by user_id order by ts, event_id) as previous_status, event_type as new_status, ts as changed_at,
    cast(null as varchar) as change_reason, {_tail('ts', 'order_status_history')} from events"""

DATE_OF = {"order_at": "order_date", "payment_at": "payment_date"}


def _staging(table: str, raw: str | None = None) -> str:
    columns = COLUMNS[table].split()
    out = []
    for c in columns:
        if c == "email":
            out.append("lower(email) as email")
        elif c in MONEY_COLUMNS:
            out.append(f"cast({c} as decimal(38,2)) as {c}")
        else:
            out.append(c)
        if c in DATE_OF:
            out.append(f"cast({c} as date) as {DATE_OF[c]}")
    defaulted = table in ("orders", "order_items", "payments")
    flag = "coalesce(is_deleted, false) as is_deleted" if defaulted else "is_deleted"
    tail = [flag if c == "is_deleted" else c for c in TAIL]
    return f"select {', '.join([*out, *tail])} from {_latest(raw or 'raw_' + table, KEYS[table], columns)}"


for _table in COLUMNS:
    CTES[f"stg_{_table}"] = _staging(_table)
CTES["stg_customer_log"] = _staging("customers", "customer_log")

CUSTOMER_HASH = _md5(
    *[
        _text(c)
        for c in ("customer_name", "email", "phone_number", "address", "customer_grade", "marketing_opt_in")
    ]
)
PRODUCT_HASH = _md5(
    *[
        _text(c)
        for c in ("product_name", "category_id", "cast(list_price as decimal(12,2))", "brand", "product_status")
    ]
)
CUSTOMER_SK = _md5("cast(customer_id as varchar)", _stamp("updated_at"), "row_hash")
PRODUCT_SK = _md5("cast(product_id as varchar)", _stamp("updated_at"), "row_hash")
OPEN = "timestamp '9999-12-31 00:00:00'"

CTES["dim_customer"] = f"""select *, {CUSTOMER_SK} as customer_sk, updated_at as effective_from,
    {OPEN} as effective_to, true as is_current
    from (select *, {CUSTOMER_HASH} as row_hash from stg_customers where is_deleted = false)"""
CTES["dim_product"] = f"""select *, {PRODUCT_SK} as product_sk, updated_at as effective_from,
    coalesce(lead(updated_at) over (partition by product_id order by updated_at), {OPEN}) as effective_to,
    lead(updated_at) over (partition by product_id order by updated_at) is null as is_current
    from (select *, {PRODUCT_HASH} as row_hash from raw_products)"""
CTES["log_versions"] = f"""select *, {CUSTOMER_SK} as customer_sk, updated_at as effective_from,
    coalesce(lead(updated_at) over (partition by customer_id order by updated_at), {OPEN}) as effective_to,
    lead(updated_at) over (partition by customer_id order by updated_at) is null as is_current
    from (select *, {CUSTOMER_HASH} as row_hash from customer_log)"""
CTES["fact_order"] = """select o.*, d.customer_sk from stg_orders o left join dim_customer d
    on o.customer_id = d.customer_id and o.order_at >= d.effective_from and o.order_at < d.effective_to"""
CTES["fact_order_item"] = """select i.order_item_id, i.order_id, o.order_date, i.product_id, p.product_sk,
    p.category_id, i.quantity, i.unit_price, i.discount_amount, i.item_amount, i.created_at, i.updated_at,
    i.is_deleted, i.extract_date, i.loaded_at
    from stg_order_items i left join fact_order o on i.order_id = o.order_id
    left join dim_product p on i.product_id = p.product_id
        and o.order_at >= p.effective_from and o.order_at < p.effective_to"""
CTES["order_payments"] = """select order_id,
    coalesce(sum(payment_amount) filter (where payment_status = 'paid'), 0) as paid_amount,
    coalesce(sum(payment_amount) filter (where payment_status = 'refunded'), 0) as refunded_amount
    from stg_payments where is_deleted is not true group by order_id"""


def ctes(body: str) -> str:
    """The query with every common table expression it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                needed.append(name)

    visit(body)
    head = ",\n".join(f"{name} as ({CTES[name]})" for name in needed)
    return f"with {head}\n{body}" if needed else body


def _exact_ratio(numerator: str, denominator: str, scale: str) -> str:
    """Quotient of two non-negative amounts of equal unit, rounded half up to nine digits."""
    n, d = f"cast({numerator} * {scale} as hugeint)", f"cast({denominator} * {scale} as hugeint)"
    return f"""case when {d} = 0 then null else
        cast((2 * {n} * 1000000000 + {d}) // (2 * {d}) as decimal(28,0)) * cast(0.000000001 as decimal(10,9)) end"""


def _share(amount: str, part: str, whole: str) -> str:
    """amount * part / whole of money with two digits, rounded half away from zero to nine digits."""
    n = f"(cast({amount} * 100 as hugeint) * cast({part} * 100 as hugeint) * 10000000)"
    d = f"cast({whole} * 100 as hugeint)"
    size = f"cast((2 * abs({n}) + abs({d})) // (2 * abs({d})) as decimal(28,0))"
    return f"""case when {d} = 0 then null else
        {size} * sign({n}) * sign({d}) * cast(0.000000001 as decimal(10,9)) end"""


def _daily_sales(where: str) -> str:
    def allocated(col: str) -> str:
        return f"cast(sum(cast({_share(f'coalesce({col}, 0)', 'amount', 'total')} as decimal(38,9))) as decimal(38,9))"

    return ctes(f"""
    select sales_date, category_id, category_name,
        count(distinct order_id) as order_count, cast(sum(product_count) as bigint) as product_count,
        cast(sum(quantity) as bigint) as quantity_sold, cast(sum(amount) as decimal(38,2)) as gross_item_revenue,
        cast(sum(discount) as decimal(38,2)) as item_discount_amount,
        {allocated('paid_amount')} as allocated_paid_amount,
        {allocated('refunded_amount')} as allocated_refunded_amount,
        cast(sum(case when order_status in ('paid', 'shipped', 'delivered') then amount else 0 end)
            as decimal(38,2)) as daily_revenue
    from (
        select c.*, o.order_status, t.total, p.paid_amount, p.refunded_amount
        from (
            select i.order_date as sales_date, coalesce(i.category_id, -1) as category_id,
                coalesce(g.category_name, 'unknown') as category_name, i.order_id,
                count(distinct i.product_id) as product_count, sum(i.quantity) as quantity,
                sum(i.item_amount) as amount, sum(i.discount_amount) as discount
            from fact_order_item i left join stg_categories g on i.category_id = g.category_id
            where not i.is_deleted and {where} group by all) c
        left join fact_order o on c.order_id = o.order_id and not o.is_deleted
        left join (select order_id, sum(item_amount) as total from fact_order_item i
            where not i.is_deleted and {where} group by order_id) t on c.order_id = t.order_id
        left join order_payments p on c.order_id = p.order_id)
    group by sales_date, category_id, category_name""")


def _failed(name: str, count: str) -> str:
    return f"select '{name}' as check_name, cast(({count}) as bigint) as failed_row_count"


PRODUCT_OUT = """product_sk, product_id, category_id, product_name, brand, list_price, product_status,
    effective_from, effective_to, is_current, row_hash, updated_at"""
VERSION_OUT = f"""customer_sk, customer_id, customer_grade, email, {_stamp('effective_from')} as effective_from,
    {_stamp('effective_to')} as effective_to, is_current, row_hash"""

FACTS_TAIL = "created_at, updated_at, is_deleted, extract_date, loaded_at"
SQL: dict[str, str] = {}

SQL["dedupe_latest_lineitem"] = """
    select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
    from (select *, row_number() over (partition by l_orderkey, l_linenumber
        order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as rn from lineitem)
    where rn = 1"""
SQL["dedupe_latest_events"] = """
    select event_id, ts, user_id, event_type, value, props from (
        select *, row_number() over (partition by user_id order by ts desc) as rn from events) where rn = 1"""
SQL["extract_window_events"] = """
    select *, date '2024-02-01' as extract_date, timestamp '2024-02-01 00:00:00' as extracted_at,
        'events' as source_table, 'b1' as batch_id
    from events where ts > (select min(ts) from events) and ts <= (select max(ts) from events)"""
SQL["incremental_high_water"] = """
    select * from events
    where ts >= (select coalesce(max(ts), timestamp '1970-01-01') from events where ts < timestamp '2024-01-15')"""
SQL["row_hash_customers"] = ctes(f"""
    select customer_id, row_hash, {CUSTOMER_SK} as customer_sk
    from (select *, {CUSTOMER_HASH} as row_hash from stg_customers)""")
for _table in COLUMNS:
    SQL[f"stg_{_table}"] = ctes(f"select * from stg_{_table}")

SQL["dim_date"] = """
    with days as (select cast(d as date) as date_day
        from generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day) as g(d)),
    n as (select cast(o_orderdate as date) as date_day, count(*) as order_count from orders group by 1)
    select days.date_day, year(days.date_day) as year, quarter(days.date_day) as quarter,
        month(days.date_day) as month, day(days.date_day) as day_of_month,
        dayofweek(days.date_day) + 1 as day_of_week, weekofyear(days.date_day) as iso_week,
        dayname(days.date_day) as day_name, strftime(days.date_day, '%Y-%m') as year_month,
        cast(date_trunc('month', days.date_day) as date) as month_start_date,
        cast(date_trunc('quarter', days.date_day) as date) as quarter_start_date,
        cast(date_trunc('year', days.date_day) as date) as year_start_date,
        dayofweek(days.date_day) in (0, 6) as is_weekend, n.order_count
    from days left join n on days.date_day = n.date_day"""
SQL["dim_category_upsert"] = ctes(f"""
    select category_id, parent_category_id,
        case when length(category_name) > 5 then lower(category_name) else category_name end as category_name,
        category_level, is_active, created_at,
        case when length(category_name) > 5 then updated_at + interval 1 day else updated_at end as updated_at,
        is_deleted, extract_date, loaded_at
    from stg_categories""")
SQL["dim_coupon_upsert"] = ctes("""
    select coupon_id, coupon_code, coupon_name, discount_type,
        case when discount_value < 2000 then cast(5 as decimal(38,2)) else discount_value end as discount_value,
        valid_from, valid_to, created_at, updated_at + interval 1 day as updated_at, is_deleted, extract_date, loaded_at
    from stg_coupons""")
SQL["scd2_initial_history"] = ctes(f"select {VERSION_OUT} from log_versions")
SQL["scd2_initial_history_split_keys"] = SQL["scd2_initial_history"]
SQL["scd2_initial_deduped"] = ctes(f"""
    select {VERSION_OUT} from (
        select *, {CUSTOMER_SK} as customer_sk, updated_at as effective_from, {OPEN} as effective_to,
            true as is_current
        from (select *, {CUSTOMER_HASH} as row_hash from stg_customer_log))""")
SQL["scd2_incremental"] = ctes(f"""
    select {VERSION_OUT} from (
        with hashed as (select *, {CUSTOMER_HASH} as row_hash from (
            select customer_id, customer_name, lower(email) as email, phone_number, address, customer_grade,
                marketing_opt_in, updated_at from customer_log)),
        keyed as (select *, {CUSTOMER_SK} as customer_sk from hashed),
        first_load as (select * from keyed where updated_at < timestamp '2024-01-02'
            qualify row_number() over (partition by customer_id order by updated_at desc) = 1),
        last_load as (select * from keyed
            qualify row_number() over (partition by customer_id order by updated_at desc) = 1)
        select f.*, f.updated_at as effective_from,
            case when l.row_hash <> f.row_hash then l.updated_at else {OPEN} end as effective_to,
            l.row_hash = f.row_hash as is_current
        from first_load f join last_load l on f.customer_id = l.customer_id
        union all
        select l.*, l.updated_at, {OPEN}, true
        from last_load l left join first_load f on f.customer_id = l.customer_id
        where f.customer_id is null or l.row_hash <> f.row_hash)""")
SQL["dim_product_scd2"] = ctes(f"""
    select product_sk, product_id, category_id, product_name, brand, cast(list_price as decimal(38,2)) as list_price,
        product_status, {_stamp('effective_from')} as effective_from, {_stamp('effective_to')} as effective_to,
        is_current, row_hash, updated_at
    from dim_product""")
SQL["fact_order_asof"] = ctes("""
    select e.event_id as order_id, e.user_id as customer_id, v.customer_sk, e.ts as order_at,
        cast(e.ts as date) as order_date, cast(cast(e.value as decimal(12,2)) as decimal(38,2)) as total_amount
    from events e left join log_versions v
        on e.user_id = v.customer_id and e.ts >= v.effective_from and e.ts < v.effective_to
    where e.event_type = 'purchase'""")
SQL["fact_order_item_asof"] = ctes("""
    select order_item_id, order_id, order_date, product_id, product_sk, category_id, quantity, unit_price,
        discount_amount, item_amount, updated_at, is_deleted from fact_order_item""")
SQL["asof_join_shipments"] = """
    with versions as (select o_custkey as custkey, o_orderkey as version_order, o_orderdate as effective_from,
        coalesce(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey),
            timestamp '9999-12-31') as effective_to from orders)
    select l.l_orderkey, cast(l.l_linenumber as bigint) as l_linenumber, l.l_partkey, l.l_shipdate,
        o.o_custkey as custkey, v.version_order
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey
    left join versions v on o.o_custkey = v.custkey
        and l.l_shipdate >= v.effective_from and l.l_shipdate < v.effective_to"""
SQL["asof_join_split_keys"] = SQL["asof_join_shipments"]
SQL["asof_join_overlapping"] = """
    with versions as (select l_suppkey, l_orderkey * 10 + l_linenumber as open_item,
        least(o_orderdate, l_shipdate) as effective_from, greatest(o_orderdate, l_shipdate) as effective_to
        from lineitem join orders on l_orderkey = o_orderkey),
    probes as (select distinct l_suppkey, date_trunc('month', effective_to)::timestamp as month from versions
        where date_trunc('month', effective_to) in (select date_trunc('month', o_orderdate) from orders)
            and l_suppkey in (select s_suppkey from supplier))
    select p.l_suppkey, p.month, count(v.open_item) as open_items, sum(v.open_item)::bigint as item_sum
    from probes p left join versions v on p.l_suppkey = v.l_suppkey and p.month >= v.effective_from and p.month < v.effective_to
    group by all"""
SQL["fact_payment"] = ctes(f"""
    select payment_id, order_id, payment_method, payment_status, payment_amount, payment_at, payment_date,
        transaction_id, {FACTS_TAIL} from stg_payments""")
SQL["fact_shipment"] = ctes(f"""
    select shipment_id, order_id, shipment_status, carrier, tracking_number, shipped_at, delivered_at,
        cast(shipped_at as date) as shipped_date, cast(delivered_at as date) as delivered_date, {FACTS_TAIL}
    from stg_shipments""")
SQL["fact_inventory_snapshot"] = ctes(f"""
    select snapshot_date, product_id, category_id, stock_quantity, reserved_quantity, available_quantity,
        {FACTS_TAIL} from stg_inventory_snapshots""")
SQL["fact_order_status_history"] = ctes(f"""
    select order_status_history_id, order_id, previous_status, new_status, changed_at,
        cast(changed_at as date) as changed_date, change_reason, {FACTS_TAIL} from stg_order_status_history""")

ORDER_MONTH = "cast(date_trunc('month', o_orderdate) as date)"
SQL["merge_upsert"] = f"""
    select o_orderkey as order_id, o_orderstatus as order_status, {ORDER_MONTH} as order_month,
        cast(case when o_orderstatus = 'P' then {MONEY.format('o_totalprice')} else 1 end as decimal(38,2))
            as total_amount
    from orders where o_orderstatus in ('P', 'O', 'F')"""
SQL["merge_moved_partition"] = f"""
    select o_orderkey as order_id, o_orderstatus as order_status,
        case when o_orderstatus = 'F' or {ORDER_MONTH} = date '1995-01-01'
            then cast({ORDER_MONTH} + interval 24 month as date) else {ORDER_MONTH} end as order_month,
        cast({MONEY.format('o_totalprice')} as decimal(38,2)) as total_amount
    from orders"""
SQL["merge_located"] = f"""
    select o_orderkey as order_id, o_orderstatus as order_status,
        case when o_orderstatus = 'F' and o_orderkey % 7 <> 0
            then cast({ORDER_MONTH} + interval 24 month as date) else {ORDER_MONTH} end as order_month,
        cast(case when o_orderkey % 7 = 0 then 7 else {MONEY.format('o_totalprice')} end as decimal(38,2)) as total_amount
    from orders"""
SQL["extract_order"] = "select count(*) as landed_rows, 0::bigint as out_of_order, count(*) as counted_rows from orders"
_LOADED = """select '{batch}' as batch_id, '{table}' as source_table, 'raw.{table}' as target_table, 'raw_load_success' as status,
    count(*) as row_count, timestamp '2026-01-01' as started_at, timestamp '2026-01-01' as finished_at from {source} where {ts} {window}"""
SQL["audit_append"] = " union all ".join(
    _LOADED.format(batch=batch, table=table, source=source, ts=ts, window=window)
    for batch, window in (("b1", "<= timestamp '1998-01-01'"), *[("b2", "> timestamp '1998-01-01'")] * 2)
    for table, source, ts in (("orders", "orders", "o_orderdate"), ("order_items", "lineitem", "l_shipdate"))
)
SQL["raw_batch_reload"] = ctes("""
    select order_id, order_status, order_at, cast(total_amount as decimal(38,2)) as total_amount,
        case when updated_at <= timestamp '1998-01-01' then date '2026-01-02' else date '2026-01-01' end
            as extract_date,
        'orders' as source_table,
        case when updated_at <= timestamp '1998-01-01' then 'b1' else 'b2' end as batch_id, loaded_at
    from raw_orders
    where updated_at <= timestamp '1997-01-01' or updated_at > timestamp '1998-01-01'""")

REPORT = """select cast(date_trunc('month', l_shipdate) as date) as ship_month, l_returnflag as flag,
    cast(sum(cast(l_quantity as bigint)) as bigint) as quantity from lineitem where {} group by all"""
SQL["partition_overwrite"] = f"""
    with again as ({REPORT.format("l_returnflag = 'R' and year(l_shipdate) in (1996, 1999)")})
    select * from ({REPORT.format('true')}) where ship_month not in (select ship_month from again)
    union all select * from again"""
SQL["backfill_range"] = f"""
    select * from ({REPORT.format('true')}) where ship_month not between date '1996-01-01' and date '1997-12-31'
    union all select * from ({REPORT.format("l_returnflag = 'R' and year(l_shipdate) = 1996")})"""

SQL["mart_daily_sales"] = _daily_sales("true")
SQL["mart_daily_sales_range"] = _daily_sales("i.order_date between date '1997-03-01' and date '1997-04-30'")
SQL["mart_daily_sales_lookback"] = _daily_sales("i.order_date >= date '2001-07-25'")


def _product_sales(where: str) -> str:
    return ctes(f"""
    select i.order_date as sales_date, i.product_id, i.product_sk, p.product_name, p.brand, p.product_status,
        coalesce(i.category_id, -1) as category_id, coalesce(g.category_name, 'unknown') as category_name,
        count(distinct i.order_id) as order_count, count(distinct i.order_item_id) as order_item_count,
        cast(sum(i.quantity) as bigint) as quantity_sold, cast(sum(i.item_amount) as decimal(38,2)) as gross_revenue,
        cast(sum(i.discount_amount) as decimal(38,2)) as discount_amount,
        cast(sum(case when o.order_status in ('paid', 'shipped', 'delivered') then i.item_amount else 0 end)
            as decimal(38,2)) as net_revenue
    from fact_order_item i left join fact_order o on i.order_id = o.order_id and not o.is_deleted
    left join dim_product p on i.product_sk = p.product_sk
    left join stg_categories g on coalesce(i.category_id, -1) = g.category_id
    where not i.is_deleted and {where} group by all""")


SQL["mart_product_sales"] = _product_sales("true")
SQL["mart_product_sales_range"] = _product_sales("i.order_date between date '1997-03-01' and date '1997-04-30'")

_AVERAGE = """cast((2 * cast(customer_ltv * 100 as hugeint) * 10000000 + sign(customer_ltv) * lifetime_order_count)
    // (2 * lifetime_order_count) as decimal(28,0)) * cast(0.000000001 as decimal(10,9))"""
CTES["ltv"] = """select co.*, cast(paid - refunded as decimal(38,2)) as customer_ltv,
    if(paid - refunded >= 1000000, 'high_value', if(lifetime_order_count >= 3, 'repeat', 'new_or_low'))
        as customer_segment
    from (select o.customer_id, min(o.order_date) as first_order_date, max(o.order_date) as last_order_date,
            count(distinct o.order_id) as lifetime_order_count, sum(coalesce(p.paid_amount, 0)) as paid,
            sum(coalesce(p.refunded_amount, 0)) as refunded
        from fact_order o left join order_payments p on o.order_id = p.order_id
        where o.order_status in ('paid', 'shipped', 'delivered') and not o.is_deleted
        group by o.customer_id) co"""


def _value(where: str) -> str:
    return ctes(f"""
    select ltv.customer_id, d.customer_sk, d.customer_name, d.email, d.customer_grade, d.marketing_opt_in,
        first_order_date, last_order_date, date_diff('day', last_order_date, date '2002-01-01')
            as days_since_last_order,
        lifetime_order_count, cast(paid as decimal(38,2)) as lifetime_paid_amount,
        cast(refunded as decimal(38,2)) as lifetime_refunded_amount, customer_ltv,
        cast({_AVERAGE} as decimal(38,9)) as avg_order_value, customer_segment
    from ltv left join dim_customer d on ltv.customer_id = d.customer_id
    where {where}""")


SQL["mart_customer_ltv"] = _value("true")
SQL["mart_customer_ltv_lookback"] = _value("last_order_date >= date '2001-07-02'")


def _retention(where: str) -> str:
    return ctes(f"""
    select b.*, s.cohort_customer_count,
        b.retained_customer_count / s.cohort_customer_count as retention_rate
    from (
        select c.cohort_month, m.order_month, date_diff('month', c.cohort_month, m.order_month)
                as months_since_cohort,
            coalesce(l.customer_segment, 'unknown') as customer_segment,
            count(distinct m.customer_id) as retained_customer_count
        from (select distinct customer_id, cast(date_trunc('month', order_date) as date) as order_month
            from fact_order where order_status in ('paid', 'shipped', 'delivered') and not is_deleted) m
        join (select customer_id, cast(date_trunc('month', min(order_date)) as date) as cohort_month
            from fact_order where order_status in ('paid', 'shipped', 'delivered') and not is_deleted
            group by customer_id) c on m.customer_id = c.customer_id
        left join ltv l on m.customer_id = l.customer_id
        group by all) b
    left join (
        select cast(date_trunc('month', first_order_date) as date) as cohort_month, customer_segment,
            count(*) as cohort_customer_count from ltv where customer_id is not null group by all) s
    on b.cohort_month = s.cohort_month and b.customer_segment = s.customer_segment
    where {where}""")


SQL["mart_monthly_retention"] = _retention("true")
SQL["mart_monthly_retention_lookback"] = _retention("b.cohort_month >= date '2000-08-01'")
SQL["mart_monthly_retention_range"] = _retention("b.cohort_month between date '1997-03-01' and date '1997-04-01'")

SQL["dq_not_null"] = _failed("customer_balance_not_null", "select count(*) from customer where c_acctbal < 0")
SQL["dq_unique"] = _failed(
    "events_user_id_unique",
    "select count(*) from (select user_id from events group by user_id having count(*) > 1)",
)
SQL["dq_unique_composite"] = _failed(
    "lineitem_l_orderkey_l_linenumber_unique",
    "select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)",
)
SQL["dq_relationships"] = _failed(
    "lineitem_l_orderkey_in_orders",
    """select count(*) from lineitem where l_orderkey is not null and not exists
        (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')""",
)
SQL["dq_accepted_values"] = _failed(
    "events_event_type_accepted_values", "select count(*) from events where event_type not in ('view', 'click')"
)
SQL["dq_range"] = _failed("customer_c_acctbal_at_least_0", "select count(*) from customer where c_acctbal < 0")
SQL["dq_scd_one_current"] = _failed(
    "events_one_current_row",
    "select count(*) from (select 1 from events where event_type = 'signup' group by user_id having count(*) > 1)",
)
SQL["dq_row_count"] = _failed(
    "raw_orders_to_fact_order_row_count",
    """select case when (select count(distinct o_orderkey) from orders where o_orderstatus <> 'P')
        < (select count(distinct o_orderkey) from orders) then 1 else 0 end""",
)
SQL["dq_metric_sanity"] = _failed(
    "balances_balance_at_least_0",
    """select count(*) from (select 1 from customer group by c_nationkey, c_mktsegment
        having sum(cast(c_acctbal as decimal(12,2)) - 4500) < 0)""",
)
SQL["dq_mart_reconcile"] = ctes(
    _failed(
        "mart_aggregate_validation",
        """select count(*) from (
            select o.order_date as day, if(count(*) > 6, 2, 0)
                + sum(if(o.order_status in ('paid', 'shipped', 'delivered'), i.item_amount, 0)) as reported
            from stg_order_items i left join stg_orders o on i.order_id = o.order_id group by o.order_date) m
        left join (
            select o.order_date as day, sum(i.item_amount) as revenue
            from stg_order_items i join stg_orders o on i.order_id = o.order_id
            where not i.is_deleted and not o.is_deleted and o.order_status in ('paid', 'shipped', 'delivered')
            group by o.order_date) f on m.day = f.day
        where abs(reported - coalesce(revenue, 0)) > 1""",
    )
)
SQL["dq_freshness"] = """
    select 'purchase_freshness' as check_name, cast(count(*) as bigint) as failed_row_count
    from (select max(ts) as m from events where event_type = 'purchase')
    where m is null or m < timestamp '2024-02-01' - interval 1 day
    union all
    select 'click_freshness', cast(count(*) as bigint)
    from (select max(ts) as m from events where event_type = 'click')
    where m is null or m < timestamp '2024-02-01' - interval 3 day"""
SQL["dq_source_freshness"] = """
    select source_table, max_loaded_at,
        case when max_loaded_at is null or max_loaded_at < timestamp '2024-01-31' - interval 48 hour then 'error'
            when max_loaded_at < timestamp '2024-01-31' - interval 24 hour then 'warn' else 'pass' end as status
    from (select 'all' as source_table, max(ts) as max_loaded_at from events
        union all select 'to_day_29', max(ts) from events where ts < timestamp '2024-01-29 12:00:00'
        union all select 'to_day_15', max(ts) from events where ts < timestamp '2024-01-15')"""

_SUITE = [
    ("raw_orders_freshness", "freshness", "raw", "orders", "ERROR", "select 0"),
    ("fact_order_pk_not_null", "not_null", "core", "fact_order", "ERROR",
     "select count(*) from fact_order where order_id is null"),
    ("fact_order_pk_unique", "unique", "core", "fact_order", "ERROR",
     "select count(*) from (select 1 from fact_order group by order_id having count(*) > 1)"),
    ("fact_order_item_pk_unique", "unique", "core", "fact_order_item", "ERROR",
     "select count(*) from (select 1 from fact_order_item group by order_item_id having count(*) > 1)"),
    ("fact_order_item_order_fk", "relationship", "core", "fact_order_item", "ERROR",
     "select count(*) from fact_order_item where quantity = 50 and order_id is not null"),
    ("fact_payment_order_fk", "relationship", "core", "fact_payment", "ERROR",
     """select count(*) from stg_payments p where not exists
        (select 1 from fact_order o where o.order_id = p.order_id)"""),
    ("fact_order_status_accepted_values", "accepted_values", "core", "fact_order", "ERROR",
     """select count(*) from fact_order
        where order_status not in ('created', 'paid', 'shipped', 'delivered', 'cancelled', 'refunded')"""),
    ("fact_payment_status_accepted_values", "accepted_values", "core", "fact_payment", "ERROR",
     """select count(*) from stg_payments
        where payment_status not in ('authorized', 'paid', 'failed', 'cancelled', 'refunded')"""),
    ("payment_amount_non_negative", "range", "core", "fact_payment", "ERROR",
     "select count(*) from stg_payments where payment_amount < 0"),
    ("order_total_amount_non_negative", "range", "core", "fact_order", "ERROR",
     "select count(*) from fact_order where total_amount < 0"),
    ("dim_customer_one_current_row", "scd_type_2", "core", "dim_customer", "ERROR",
     "select count(*) from (select 1 from dim_customer where is_current group by customer_id having count(*) > 1)"),
    ("dim_product_one_current_row", "scd_type_2", "core", "dim_product", "ERROR",
     "select count(*) from (select 1 from dim_product where is_current group by product_id having count(*) > 1)"),
    ("raw_to_core_orders_row_count", "row_count", "core", "fact_order", "WARN",
     """select case when (select count(distinct o_orderkey) from orders)
        < (select count(distinct order_id) from fact_order) then 1 else 0 end"""),
    ("mart_daily_sales_revenue_non_negative", "metric_sanity", "mart", "mart_daily_sales", "ERROR",
     """select count(*) from (select 1 from fact_order_item where quantity <> 50
        group by order_date, category_id having sum(item_amount) < 0)"""),
    ("mart_product_sales_quantity_non_negative", "metric_sanity", "mart", "mart_product_sales", "ERROR",
     "select count(*) from (select 1 from fact_order_item group by order_date, product_sk having sum(quantity) < 0)"),
    ("mart_daily_sales_aggregate_validation", "mart_aggregate_validation", "mart", "mart_daily_sales", "WARN",
     "select 0"),
]
SQL["dq_suite"] = ctes(
    " union all ".join(
        f"""select '{name}' as check_name, '{kind}' as check_type, '{dataset}' as target_dataset,
        '{table}' as target_table, '{severity}' as severity,
        case when ({count}) = 0 then 'pass' else 'fail' end as status,
        cast(({count}) as bigint) as failed_row_count, 'b1' as batch_id, date '2026-01-01' as execution_date"""
        for name, kind, dataset, table, severity, count in _SUITE
    )
)

_WATERMARK = """
    select '{table}' as source_table, timestamp '{success}' as last_success_watermark,
        timestamp '2024-01-15 00:00:00' as current_run_watermark, '{status}' as status,
        (select count(*) from {rows} where {ts} > timestamp '1998-01-01' and {ts} <= timestamp '2024-01-15')
            as row_count"""


def _watermarks(success: str, status: str) -> str:
    tables = (
        ("orders", "orders", "o_orderdate"),
        ("order_items", "lineitem", "l_shipdate"),
        ("order_status_history", "events", "ts"),
    )
    return " union all ".join(
        _WATERMARK.format(table=t, rows=rows, ts=ts, success=success, status=status) for t, rows, ts in tables
    )


SQL["watermark_advance"] = _watermarks("2024-01-15 00:00:00", "success")
SQL["watermark_preserve"] = _watermarks("1998-01-01 00:00:00", "extract_success")
