"""Hash keys over several columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# NULL marker and separator of the hashed text.
NULL_MARK = "__null__"
SEPARATOR = "|"

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 hex of the columns as text; NULL is a marker, so the key is never NULL."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *texts))


def hash_of(df: DataFrame, cols: list[str]) -> Column:
    """`surrogate_key` with timestamps in a fixed text form.

    Floating-point columns are refused: their text differs between engines and
    versions, so the key would not be stable.
    """
    parts = []
    for name in cols:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            raise TypeError(f"cannot build a stable key on floating-point column {name}")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            parts.append(F.date_format(name, TIMESTAMP_TEXT))
        else:
            parts.append(F.col(name))
    return surrogate_key(*parts)
