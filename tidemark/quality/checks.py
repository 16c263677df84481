"""Check constructors. A check finds `failed_row_count`; zero means it passes.

Row checks are predicates on one table; the suite evaluates all of a table's
predicates in one scan. Table checks are one-row DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import loaded_at, utc

Tables = Mapping[str, DataFrame]
FAILED = "failed_row_count"


@dataclass(frozen=True)
class Check:
    name: str
    check_type: str
    target_dataset: str
    target_table: str
    severity: str = "ERROR"
    predicate: Callable[[], Column] | None = None  # true for a failing row
    count: Callable[[Tables], DataFrame] | None = None  # one row, one column
    parent: str | None = None  # the table a reference points to

    def __post_init__(self):
        if (self.predicate is None) == (self.count is None):
            raise ValueError(f"check {self.name} needs either a predicate or a count")
        if self.severity not in ("ERROR", "WARN"):
            raise ValueError(f"unknown severity {self.severity}")

    def failures(self, tables: Tables) -> DataFrame:
        if self.count is not None:
            return self.count(tables)
        return tables[self.target_table].agg(failing(self.predicate()).alias(FAILED))


def failing(predicate: Column) -> Column:
    """Rows for which the predicate is true; unknown is not a failure."""
    return F.count_if(predicate)


# -- row checks ----------------------------------------------------------------


def not_null(dataset: str, table: str, col: str, name: str | None = None, severity: str = "ERROR") -> Check:
    return Check(
        name or f"{table}_{col}_not_null", "not_null", dataset, table, severity, lambda: F.col(col).isNull()
    )


def accepted_values(
    dataset: str, table: str, col: str, values: Sequence[str], name: str | None = None, severity: str = "ERROR"
) -> Check:
    return Check(
        name or f"{table}_{col}_accepted_values",
        "accepted_values",
        dataset,
        table,
        severity,
        lambda: ~F.col(col).isin(list(values)),
    )


def at_least(
    dataset: str,
    table: str,
    col: str,
    minimum: int = 0,
    name: str | None = None,
    severity: str = "ERROR",
    check_type: str = "range",
) -> Check:
    return Check(
        name or f"{table}_{col}_at_least_{minimum}", check_type, dataset, table, severity, lambda: F.col(col) < minimum
    )


# -- table checks --------------------------------------------------------------


def count_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("__n")).agg(F.count_if(F.col("__n") > 1).alias(FAILED))


def unique(
    dataset: str,
    table: str,
    cols: Sequence[str],
    name: str | None = None,
    severity: str = "ERROR",
    skip_null: bool = False,
) -> Check:
    """Keys that repeat. A repeated NULL key counts once unless `skip_null`."""

    def count(tables: Tables) -> DataFrame:
        df = tables[table]
        if skip_null:
            df = df.dropna(subset=list(cols))
        return count_repeated(df, cols)

    return Check(name or f"{table}_{'_'.join(cols)}_unique", "unique", dataset, table, severity, count=count)


def orphans(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose key is not NULL and missing in the parent.

    Child keys are counted before they move, so a key that fills a third of the
    child is one row in the join. The join is an outer one with a NULL test: an
    anti join would be pushed below the counting by the optimizer.
    """
    counts = child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("__key")).agg(F.count("*").alias("__n"))
    known = parent.select(F.col(parent_col).alias("__parent"), F.lit(True).alias("__found"))
    missing = counts.join(known, F.col("__key") == F.col("__parent"), "left").where(F.col("__found").isNull())
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0).cast("long")).alias(FAILED))


def relationship(
    dataset: str,
    table: str,
    col: str,
    parent: str,
    parent_col: str,
    name: str | None = None,
    severity: str = "ERROR",
    check_type: str = "relationship",
) -> Check:
    return Check(
        name or f"{table}_{col}_in_{parent}",
        check_type,
        dataset,
        table,
        severity,
        count=lambda tables: orphans(tables[table], col, tables[parent], parent_col),
        parent=parent,
    )


def one_current_row(
    dataset: str, table: str, key: str, name: str | None = None, severity: str = "ERROR"
) -> Check:
    return Check(
        name or f"{table}_one_current_row",
        "scd_type_2",
        dataset,
        table,
        severity,
        count=lambda tables: count_repeated(tables[table].where("is_current"), [key]),
    )


def row_count_not_below(
    dataset: str, table: str, key: str, raw: str, name: str | None = None, severity: str = "WARN"
) -> Check:
    """1 if the raw table has fewer distinct keys than `table`."""

    def count(tables: Tables) -> DataFrame:
        sides = [tables[t].select(key, F.lit(t == table).alias("__core")) for t in (raw, table)]
        keys = sides[0].unionByName(sides[1]).where(F.col(key).isNotNull()).distinct()
        counts = keys.agg(F.count_if(~F.col("__core")).alias("raw_n"), F.count_if("__core").alias("core_n"))
        return counts.select((F.col("raw_n") < F.col("core_n")).cast("long").alias(FAILED))

    return Check(name or f"{raw}_to_{table}_row_count", "row_count", dataset, table, severity, count=count)


def mart_matches_facts(
    dataset: str,
    mart: str,
    items: str,
    orders: str,
    revenue_statuses: Sequence[str],
    tolerance: int = 1,
    name: str | None = None,
    severity: str = "WARN",
) -> Check:
    """Days whose mart revenue differs from the facts by more than `tolerance`."""

    def count(tables: Tables) -> DataFrame:
        in_mart = tables[mart].groupBy("sales_date").agg(F.sum("daily_revenue").alias("mart_revenue"))
        # Only revenue orders add to the sum; items shrink to (order, day) before the join.
        per_order = (
            tables[items]
            .where(~F.col("is_deleted"))
            .groupBy("order_id", "order_date")
            .agg(F.sum("item_amount").cast("decimal(22,2)").alias("amount"))
        )
        revenue_orders = tables[orders].where(~F.col("is_deleted") & F.col("order_status").isin(list(revenue_statuses)))
        in_facts = (
            per_order.join(revenue_orders.select("order_id"), "order_id")
            .groupBy(F.col("order_date").alias("sales_date"))
            .agg(F.sum("amount").alias("fact_revenue"))
        )
        known = in_mart.join(in_facts, "sales_date", "left")
        gap = F.abs(F.col("mart_revenue") - F.coalesce("fact_revenue", F.lit(0)))
        return known.agg(F.count_if(gap > tolerance).alias(FAILED))

    return Check(
        name or f"{mart}_aggregate_validation", "mart_aggregate_validation", dataset, mart, severity, count=count
    )


def freshness(
    dataset: str,
    table: str,
    alias: str,
    as_of: datetime | None = None,
    max_age: timedelta = timedelta(days=1),
    name: str | None = None,
    severity: str = "ERROR",
    col: str = "loaded_at",
) -> Check:
    """1 if the newest `col` is missing or older than `max_age` before `as_of`."""

    def count(tables: Tables) -> DataFrame:
        oldest = utc(as_of - max_age) if as_of else F.current_timestamp() - F.expr(_interval(max_age))
        newest = tables[alias].agg(F.max(col).alias("__newest"))
        stale = F.col("__newest").isNull() | (F.col("__newest") < oldest)
        return newest.select(stale.cast("long").alias(FAILED))

    return Check(name or f"{alias}_freshness", "freshness", dataset, table, severity, count=count)


def _interval(span: timedelta) -> str:
    return f"interval '{int(span.total_seconds())}' second"


def source_freshness(
    raw: Tables,
    as_of: datetime | None = None,
    warn_after: timedelta = timedelta(hours=24),
    error_after: timedelta = timedelta(hours=48),
    col: str = "loaded_at",
) -> DataFrame:
    """Per raw table its newest load time, and pass, warn or error by its age."""
    rows = None
    for table, df in raw.items():
        newest = df.agg(F.max(col).alias("max_loaded_at")).select(F.lit(table).alias("source_table"), "max_loaded_at")
        rows = newest if rows is None else rows.unionByName(newest)
    now = loaded_at(as_of)
    loaded = F.col("max_loaded_at")
    status = (
        F.when(loaded.isNull() | (loaded < now - F.expr(_interval(error_after))), "error")
        .when(loaded < now - F.expr(_interval(warn_after)), "warn")
        .otherwise("pass")
    )
    return rows.withColumn("status", status)
