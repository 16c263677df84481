"""Watermark windows and high-water filters."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import utc, utc_like


def extract_window(df: DataFrame, ts_col: str, lower: datetime, upper: datetime) -> DataFrame:
    """Rows changed in `(lower, upper]`; the bounds are literals, so sources can prune."""
    if lower >= upper:
        raise ValueError(f"the window start {lower} must be earlier than its end {upper}")
    return df.where((F.col(ts_col) > utc_like(df, ts_col, lower)) & (F.col(ts_col) <= utc_like(df, ts_col, upper)))


def stamp_lineage(
    df: DataFrame, extract_date: date, extracted_at: datetime, source_table: str, batch_id: str
) -> DataFrame:
    return df.withColumns(
        {
            "extract_date": F.lit(extract_date.isoformat()).cast("date"),
            "extracted_at": utc(extracted_at),
            "source_table": F.lit(source_table),
            "batch_id": F.lit(batch_id),
        }
    )


def high_water_mark(target: DataFrame | None, col: str = "updated_at") -> datetime | None:
    """Greatest value in the target: one narrow scan, one row to the driver.

    The text form keeps the value independent of the driver's time zone.
    """
    if target is None:
        return None
    top = target.agg(F.date_format(F.max(col), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("top")).first()["top"]
    return None if top is None else datetime.fromisoformat(top)


def high_water_filter(df: DataFrame, target: DataFrame | None, col: str = "updated_at") -> DataFrame:
    """Rows at or above the target's greatest value; all rows of known time if it is empty.

    The mark is read first and put in as a literal, so the filter reaches the
    Parquet scan of `df`.
    """
    if target is None:
        return df
    mark = high_water_mark(target, col) or datetime(1970, 1, 1)
    return df.where(F.col(col) >= utc_like(df, col, mark))
