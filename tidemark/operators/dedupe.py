"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECENCY = ("updated_at", "extracted_at", "loaded_at")


def orderable(df: DataFrame, names: Sequence[str]) -> list[str]:
    unordered = (T.MapType, T.VariantType)
    schema = df.schema
    return [n for n in names if not isinstance(schema[n].dataType, unordered)]


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = RECENCY,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest `order_by` values of each key (NULL is least).

    Rows that tie are told apart by the remaining columns, so a rerun keeps the
    same row. Because the filter on the row number is written right above the
    window, Spark keeps one row per key in every input partition before the
    shuffle; a key with very many versions therefore reaches its reducer as at
    most one row per input partition.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in {*keys, *order_by}]
    ranking = ", ".join(f"`{c}` desc nulls last" for c in [*order_by, *orderable(df, tiebreak)])
    grouping = ", ".join(f"`{c}`" for c in keys)
    rank = F.expr(f"row_number() over (partition by {grouping} order by {ranking})")
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
