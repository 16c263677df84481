"""One daily batch: extract, load, build, check, and only then move the watermark."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import loaded_at, parse_utc
from tidemark.operators.incremental import stamp_lineage
from tidemark.operators.reduce import only_matching
from tidemark.plans import core, marts
from tidemark.plans.control import ControlState
from tidemark.plans.staging import standardize
from tidemark.quality import Check, DataQualityError
from tidemark.quality import run as run_checks
from tidemark.quality.declared import final_suite, layer_checks
from tidemark.schemas import ENTITIES, entity
from tidemark.sources.raw_zone import RawZone
from tidemark.sources.store import Layout, TableStore

RAW_LAYOUT = Layout(("extract_date", "batch_id"), ("updated_at",), track="updated_at")


class Source(Protocol):
    def window(self, spark: SparkSession, table: str, lower: datetime, upper: datetime) -> DataFrame: ...


@dataclass(frozen=True)
class BatchConfig:
    """One run. `start_watermark` re-reads from an earlier time without touching the stored one.

    Watermarks may be given as ISO-8601 text with or without an offset; they are UTC from then on.
    """

    root: str
    end_watermark: datetime
    extract_date: date
    batch_id: str = field(default_factory=lambda: f"batch_{uuid.uuid4().hex}")
    start_watermark: datetime | None = None
    watermark_mode: str = "advance"
    mart_start: date | None = None
    mart_end: date | None = None
    clear_mart_range: bool = False
    tables: tuple[str, ...] = tuple(ENTITIES)
    pipeline_name: str = "daily_batch"
    now: datetime | None = None  # fixed clock for repeatable runs

    def __post_init__(self) -> None:
        for name in ("end_watermark", "start_watermark"):
            if isinstance(getattr(self, name), str):
                object.__setattr__(self, name, parse_utc(getattr(self, name)))


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    row_counts: Mapping[str, int]
    watermark_moved: bool


class Warehouse:
    """The stores of one warehouse root: raw, core, mart and audit tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.zone = RawZone(spark, f"{root}/zone")
        self.raw = TableStore(spark, f"{root}/raw")
        self.core = TableStore(spark, f"{root}/core", locate=True)
        self.mart = TableStore(spark, f"{root}/mart")
        self.audit = TableStore(spark, f"{root}/audit")

    def prepare(self) -> None:
        """Empty raw tables where there are none, so that a batch over some tables can build everything."""
        for table, spec in ENTITIES.items():
            if not self.raw.exists(table):
                self.raw.overwrite(table, self.spark.createDataFrame([], spec.raw_schema), RAW_LAYOUT)

    def never_loaded(self) -> set[str]:
        return {t for t in ENTITIES if not self.raw.exists(t) or not self.raw.snapshot(t).parts}

    def not_included(self, tables: Sequence[str]) -> set[str]:
        """Tables outside `tables` that no batch has loaded; a load of zero rows is a load."""
        loaded = set()
        if self.audit.exists("raw_load_runs"):
            done = self.audit.read("raw_load_runs").where("status = 'raw_load_success'")
            loaded = {r["source_table"] for r in done.select("source_table").distinct().collect()}
        return self.never_loaded() - set(tables) - loaded

    def tidy(self) -> None:
        """Drop the files only older versions use; the last two stay, for readers that are under way."""
        for store in (self.raw, self.core, self.mart, self.audit):
            for table in store.tables():
                store.expire(table)

    def staging(self, table: str, since: datetime | None = None) -> DataFrame:
        return standardize(self.raw.read(table, tracked_from=since), table, since)

    def staging_tables(self) -> dict[str, DataFrame]:
        """For the layer tests, which read few columns of each table."""
        narrow = ("batch_id",)
        return {
            f"stg_{t}": standardize(self.raw.read(t), t, tiebreak=narrow) for t in ENTITIES if self.raw.exists(t)
        }

    def core_tables(self) -> dict[str, DataFrame]:
        names = ["dim_date", *core.TARGETS]
        return {n: self.core.read(n) for n in names if self.core.exists(n)}

    def mart_tables(self) -> dict[str, DataFrame]:
        return {n: self.mart.read(n) for n in marts.TARGETS if self.mart.exists(n)}

    def raw_tables(self) -> dict[str, DataFrame]:
        return {f"raw_{t}": self.raw.read(t) for t in ENTITIES if self.raw.exists(t)}


def side_by_side(spark: SparkSession, tasks: Mapping[str, Callable[[], object]], width: int = 4) -> dict[str, object]:
    """Run independent Spark jobs at the same time so that one's tail does not idle the cluster.

    Every task runs to its end; its result, or the exception it raised, is returned by name.
    """

    def guarded(task: Callable[[], object]) -> object:
        try:
            return task()
        except Exception as problem:  # handed to the caller by name
            return problem

    with ThreadPoolExecutor(width) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(guarded), task) for name, task in tasks.items()}
        return {name: future.result() for name, future in started.items()}


def all_or_raise(results: Mapping[str, object]) -> None:
    for problem in results.values():
        if isinstance(problem, Exception):
            raise problem


def extract_table(
    wh: Warehouse, source: Source, table: str, lower: datetime, upper: datetime, cfg: BatchConfig, now: datetime
) -> tuple[str, int]:
    """Land one window and count it; the count reads file footers only."""
    df = stamp_lineage(source.window(wh.spark, table, lower, upper), cfg.extract_date, now, table, cfg.batch_id)
    folder = wh.zone.write(table, df, cfg.extract_date.isoformat(), cfg.batch_id)
    return folder, wh.zone.read(folder).count()


def load_raw(wh: Warehouse, folder: str, table: str, batch_id: str, now: datetime) -> int:
    """Replace the batch in the raw table; the load time is set in the same write."""
    landed = wh.zone.read(folder)
    wh.raw.replace_batch(table, landed.withColumn("loaded_at", loaded_at(now)), batch_id, RAW_LAYOUT)
    return landed.count()


TAKEN = "_taken"


def raw_version_taken(wh: Warehouse, name: str) -> int | None:
    """The version of its raw table that the stored dimension has taken up; unknown after any other write to it."""
    if not wh.core.exists(name):
        return None
    prefix = f"v{wh.core.snapshot(name).version}-raw"
    notes = [n for n in wh.core._children(name, TAKEN) if n.startswith(prefix)]
    return max((int(n.removeprefix(prefix)) for n in notes), default=None)


def note_raw_version(wh: Warehouse, name: str, raw_version: int) -> None:
    old = wh.core._children(name, TAKEN)
    note = f"v{wh.core.snapshot(name).version}-raw{raw_version}"
    path = wh.core._path(name, TAKEN, note)
    wh.core._fs(path).create(path, True).close()
    for other in old:
        if other != note:
            path = wh.core._path(name, TAKEN, other)
            wh.core._fs(path).delete(path, False)


def history_changes(wh: Warehouse, name: str, table: str) -> DataFrame | None:
    """Versions to upsert into a dimension, None if there is nothing new; the same as a comparison of all keys gives.

    Only keys with a row in a raw partition that came or went since the dimension was last brought up to date are looked
    at. The latest row of a key is at least as new as one that came, so if none went, partitions that
    end before the oldest row that came are not opened. Open versions are looked for among the open ones alone.
    """
    build = getattr(core, name)
    taken, now = raw_version_taken(wh, name), wh.raw.snapshot(table)
    if taken is None or taken not in wh.raw.versions(table):
        return build(wh.staging(table), wh.core.read_or_none(name))
    before = wh.raw.snapshot(table, taken)
    came = [p for p in now.parts if p not in before.parts]
    went = [p for p in before.parts if p not in now.parts]
    if not came and not went:
        return None
    key = list(entity(table).key)
    touched = wh.raw._read_parts(table, now, came).select(*key, core.CHANGED)
    since = None
    if went:
        touched = touched.unionByName(wh.raw._read_parts(table, before, went).select(*key, core.CHANGED))
    else:
        time = F.date_format(F.min(core.CHANGED), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        oldest = touched.agg(time.alias("t"), F.count("*").alias("n"), F.count(core.CHANGED).alias("timed")).first()
        if not oldest["n"]:
            return None
        if oldest["n"] == oldest["timed"]:
            since = datetime.fromisoformat(oldest["t"])
    rows = wh.raw.read(table, tracked_from=since)
    rows, current = only_matching([rows, core.open_versions(wh.core.read(name))], touched.select(*key))
    return build(standardize(rows, table), current)


def update_history(wh: Warehouse, name: str, table: str) -> None:
    """Close and open the versions of changed keys; closed versions of earlier months are not rewritten."""
    raw_version = wh.raw.snapshot(table).version
    versions = history_changes(wh, name, table)
    if versions is not None:
        target = core.TARGETS[name]
        wh.core.merge(name, core.by_closing_month(versions), target.key, target.layout)
    note_raw_version(wh, name, raw_version)


def build_core(wh: Warehouse) -> None:
    """Dimensions and plain facts side by side, then the facts that look them up; all read stored tables."""

    def merge(name: str, df: DataFrame) -> None:
        target = core.TARGETS[name]
        wh.core.merge(name, df, target.key, target.layout)

    def incremental(name: str, table: str) -> DataFrame:
        return wh.staging(table, wh.core.high_water(name))

    def run(**tasks: Callable[[], None]) -> None:
        all_or_raise(side_by_side(wh.spark, tasks))

    def fact(name: str, table: str) -> Callable[[], None]:
        return lambda: merge(name, getattr(core, name)(incremental(name, table)))

    run(
        dim_date=lambda: wh.core.overwrite("dim_date", core.dim_date(wh.spark)),
        dim_category=fact("dim_category", "categories"),
        dim_coupon=fact("dim_coupon", "coupons"),
        dim_customer=lambda: update_history(wh, "dim_customer", "customers"),
        dim_product=lambda: update_history(wh, "dim_product", "products"),
        fact_payment=fact("fact_payment", "payments"),
        fact_shipment=fact("fact_shipment", "shipments"),
        fact_inventory_snapshot=fact("fact_inventory_snapshot", "inventory_snapshots"),
        fact_order_status_history=fact("fact_order_status_history", "order_status_history"),
    )
    customers, products = wh.core.read("dim_customer"), wh.core.read("dim_product")
    merge("fact_order", core.fact_order(incremental("fact_order", "orders"), customers))
    orders, items = wh.core.read("fact_order"), incremental("fact_order_item", "order_items")
    if wh.core.exists("fact_order_item"):
        (orders,) = only_matching([orders], items.select("order_id"))
    merge("fact_order_item", core.fact_order_item(items, orders, products))


def build_marts(
    wh: Warehouse,
    start: date | None = None,
    end: date | None = None,
    as_of: datetime | None = None,
    clear_range: bool = False,
) -> None:
    """Rebuild the marts for a range; without one, the look-back of each stored mart, or everything."""
    today = (as_of or datetime.now(timezone.utc)).date()
    ranged = start is not None and end is not None

    def reach(name: str, since: date) -> dict:
        return {
            "start": start,
            "end": end,
            "lookback_from": None if ranged or not wh.mart.exists(name) else since,
            "as_of": as_of,
        }

    def overwrite(name: str, df: DataFrame, bounds: tuple[date, date] | None) -> None:
        cleared = (bounds[0].isoformat(), bounds[1].isoformat()) if clear_range and bounds else None
        wh.mart.overwrite_partitions(name, df, marts.TARGETS[name].layout, cleared)

    t = wh.core_tables()
    days = (start, end) if ranged else None
    months = (start.replace(day=1), end.replace(day=1)) if ranged else None
    week_ago = today - timedelta(days=marts.SALES_LOOKBACK_DAYS)
    year_ago = today.replace(day=1, year=today.year - marts.RETENTION_LOOKBACK_MONTHS // 12)
    target = marts.TARGETS["mart_customer_ltv"]
    all_or_raise(
        side_by_side(
            wh.spark,
            {
                "mart_daily_sales": lambda: overwrite(
                    "mart_daily_sales",
                    marts.mart_daily_sales(
                        t["fact_order_item"],
                        t["dim_category"],
                        t["fact_order"],
                        t["fact_payment"],
                        **reach("mart_daily_sales", week_ago),
                    ),
                    days,
                ),
                "mart_product_sales": lambda: overwrite(
                    "mart_product_sales",
                    marts.mart_product_sales(
                        t["fact_order_item"],
                        t["fact_order"],
                        t["dim_product"],
                        t["dim_category"],
                        **reach("mart_product_sales", week_ago),
                    ),
                    days,
                ),
                "mart_customer_ltv": lambda: wh.mart.merge(
                    "mart_customer_ltv",
                    marts.mart_customer_ltv(
                        t["fact_order"],
                        t["fact_payment"],
                        t["dim_customer"],
                        **reach("mart_customer_ltv", today - timedelta(days=marts.LTV_LOOKBACK_DAYS)),
                    ),
                    target.key,
                    target.layout,
                ),
            },
        )
    )
    overwrite(
        "mart_monthly_retention",
        marts.mart_monthly_retention(
            t["fact_order"], wh.mart.read("mart_customer_ltv"), **reach("mart_monthly_retention", year_ago)
        ),
        months,
    )


def left_out(checks: Sequence[Check], not_included: set[str]) -> dict[str, str]:
    """Why checks are left out, by name: references to, and freshness of, tables no batch has included yet."""
    fed_by = {f"stg_{t}": t for t in ENTITIES} | core.FED_BY
    about = {c.name: fed_by.get(c.parent) for c in checks}
    about |= {
        c.name: c.target_table.removeprefix("raw_")
        for c in checks
        if c.check_type == "freshness" and c.target_dataset == "raw"
    }
    return {name: f"no batch has included {table} yet" for name, table in about.items() if table in not_included}


def test_layer(wh: Warehouse, layer: str, tables_of_batch: Sequence[str]) -> None:
    """Run the declared tests of a layer; a failure stops the batch."""
    tables = {"staging": wh.staging_tables, "core": wh.core_tables, "mart": wh.mart_tables}[layer]()
    present = [c for c in layer_checks(layer) if c.target_table in tables]
    run_checks(wh.spark, present, tables, skipped=left_out(present, wh.not_included(tables_of_batch)))


def check_quality(wh: Warehouse, cfg: BatchConfig, now: datetime, names: Sequence[str] | None = None) -> DataFrame:
    """Run the final suite and append its results, passed or not, before blocking."""
    tables = {**wh.raw_tables(), **wh.core_tables(), **wh.mart_tables()}
    suite = final_suite(cfg.now)
    try:
        results = run_checks(
            wh.spark,
            suite,
            tables,
            batch_id=cfg.batch_id,
            execution_date=cfg.extract_date,
            checked_at=now,
            names=names,
            skipped=left_out(suite, wh.not_included(cfg.tables)),
        )
    except DataQualityError as problem:
        record_quality(wh, problem.results)
        raise
    record_quality(wh, results)
    return results


def record_quality(wh: Warehouse, results: DataFrame) -> None:
    dated = results.withColumn("checked_on", F.to_date("checked_at"))
    wh.audit.append("data_quality_results", dated, Layout(("checked_on",), ("target_table", "check_type", "status")))


def run_batch(spark: SparkSession, cfg: BatchConfig, source: Source) -> BatchResult:
    """Run every stage in order. Any failure leaves the stored watermark as it was."""
    wh = Warehouse(spark, cfg.root)
    state = ControlState(wh.audit, cfg.pipeline_name)

    def clock() -> datetime:
        return cfg.now or datetime.now(timezone.utc).replace(tzinfo=None)

    known = state.watermark_rows()
    windows = {}
    for table in cfg.tables:
        lower = cfg.start_watermark or state.last_success(entity(table).name, known)
        if lower >= cfg.end_watermark:
            raise ValueError(f"start {lower} of {table} must be earlier than end {cfg.end_watermark}")
        windows[table] = (lower, cfg.end_watermark)

    state.started(cfg.batch_id, cfg.extract_date, windows, clock())
    landed = side_by_side(
        spark,
        {
            table: lambda table=table, lower=lower, upper=upper: extract_table(
                wh, source, table, lower, upper, cfg, clock()
            )
            for table, (lower, upper) in windows.items()
        },
    )
    extracted = {
        table: {"status": "extract_failed", "error_message": str(done)}
        if isinstance(done, Exception)
        else {"uri": done[0], "row_count": done[1], "status": "extract_success"}
        for table, done in landed.items()
    }
    state.finished(cfg.batch_id, extracted, clock())
    all_or_raise(landed)

    wh.prepare()
    started = clock()
    loaded = side_by_side(
        spark,
        {
            table: lambda table=table, done=done: load_raw(wh, done["uri"], table, cfg.batch_id, clock())
            for table, done in extracted.items()
        },
    )
    state.audit_load(
        {
            "batch_id": cfg.batch_id,
            "source_table": table,
            "uri": extracted[table]["uri"],
            "target_table": f"raw.{table}",
            "started_at": started,
            "finished_at": clock(),
            **(
                {"status": "raw_load_failed", "error_message": str(rows)}
                if isinstance(rows, Exception)
                else {"status": "raw_load_success", "row_count": rows}
            ),
        }
        for table, rows in loaded.items()
    )
    all_or_raise(loaded)

    test_layer(wh, "staging", cfg.tables)
    build_core(wh)
    test_layer(wh, "core", cfg.tables)
    build_marts(wh, cfg.mart_start, cfg.mart_end, cfg.now, cfg.clear_mart_range)
    test_layer(wh, "mart", cfg.tables)
    check_quality(wh, cfg, clock())
    counts = {table: done["row_count"] for table, done in extracted.items()}
    moved = state.advance(cfg.watermark_mode, cfg.end_watermark, counts, clock())
    wh.tidy()
    return BatchResult(cfg.batch_id, counts, moved)
