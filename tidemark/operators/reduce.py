"""Joins against a small set of keys, where the size is measured before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import durable

# Bytes of plain values; the hash table that is built of them is several times larger.
BROADCAST_BYTES = 32 * 1024 * 1024

_WIDTH = {T.LongType: 8, T.TimestampType: 8, T.DateType: 4, T.IntegerType: 4, T.BooleanType: 1}
_OTHER_WIDTH = 64


def fits_broadcast(schema: T.StructType, rows: int, limit: int = BROADCAST_BYTES) -> bool:
    return rows * sum(_WIDTH.get(type(f.dataType), _OTHER_WIDTH) for f in schema) <= limit


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint if its known row count allows, else as it is."""
    return F.broadcast(df) if fits_broadcast(df.schema, rows, limit) else df


def only_matching(
    frames: Sequence[DataFrame], keys: DataFrame, limit: int = BROADCAST_BYTES, nulls_match: bool = False
) -> list[DataFrame]:
    """Each frame without the rows whose key is not in `keys`.

    For tables that are about to be joined to a selection by that key: the rows left
    out could not match. The distinct keys are written once and counted; few are
    broadcast, and with many the semi join is a shuffled one. The rows are the same
    either way. For the selected table itself pass `nulls_match=True`: a NULL key then matches a NULL key.
    """
    few = durable(keys.distinct())
    few = broadcast_if_small(few, few.count(), limit)
    if not nulls_match:
        return [frame.join(few, keys.columns, "left_semi") for frame in frames]
    named = few.toDF(*(f"__key_{c}" for c in keys.columns))
    same = [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in keys.columns]
    return [frame.join(named, same, "left_semi") for frame in frames]
