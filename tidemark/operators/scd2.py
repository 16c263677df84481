"""Type 2 history: one row per version of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import hash_of, utc
from tidemark.operators.hotkeys import HOT_ROWS, lead_within_key

# Fixed value: end of an open version.
OPEN_END = "9999-12-31 00:00:00"


def _with_hashes(source: DataFrame, key: str, tracked: Sequence[str], sk: str, ts: str) -> DataFrame:
    hashed = source.withColumn("row_hash", hash_of(source, list(tracked)))
    return hashed.withColumn(sk, hash_of(hashed, [key, ts, "row_hash"]))


def _version_columns(key: str, attributes: Sequence[str], sk: str) -> list[str]:
    return [
        sk,
        key,
        *attributes,
        "effective_from",
        "effective_to",
        "is_current",
        "row_hash",
        "created_at",
        "updated_at",
        "extract_date",
        "loaded_at",
    ]


def scd2_initial(
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    untracked: Sequence[str] = (),
    ts: str = "updated_at",
    tiebreak: str = "loaded_at",
    hot_rows: int | None = HOT_ROWS,
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """First build: a version lasts until the next change of the same key.

    `source` may be a deduplicated table (each key then has one open version;
    pass `hot_rows=None`) or a full change log. Rows that are deleted or of
    unknown deletion state are left out.
    """
    live = source.where(~F.col("is_deleted"))
    hashed = _with_hashes(live, key, tracked, sk, ts)
    stepped = lead_within_key(hashed, key, [ts, tiebreak], ts, "__next", hot_rows=hot_rows, chunk_rows=chunk_rows)
    versions = stepped.withColumns(
        {
            "effective_from": F.col(ts),
            "effective_to": F.coalesce(F.col("__next"), utc(OPEN_END)),
            "is_current": F.col("__next").isNull(),
        }
    )
    return versions.select(*_version_columns(key, [*tracked, *untracked], sk))


def scd2_incremental(
    source: DataFrame,
    dim: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    untracked: Sequence[str] = (),
    ts: str = "updated_at",
) -> DataFrame:
    """Versions to upsert on `sk`: closed old ones and new open ones.

    One left join of the source with the current versions finds new and changed
    keys; each changed pair then yields its closing and its opening row, so
    neither input is scanned or shuffled twice.
    """
    columns = _version_columns(key, [*tracked, *untracked], sk)
    current = dim.where("is_current").select(
        F.col(key).alias("__key"), F.struct(*columns).alias("__old"), F.col("row_hash").alias("__old_hash")
    )
    live = _with_hashes(source.where(~F.col("is_deleted")), key, tracked, sk, ts)
    changed = live.join(current, F.col(key) == F.col("__key"), "left").where(
        F.col("__key").isNull() | (F.col("row_hash") != F.col("__old_hash"))
    )
    opening = {"effective_from": F.col(ts), "effective_to": utc(OPEN_END), "is_current": F.lit(True)}
    closing = {"effective_to": F.col(ts), "is_current": F.lit(False)}

    def cast_like_dim(value, name):
        return value.cast(dim.schema[name].dataType).alias(name)

    new_row = F.struct(*[cast_like_dim(opening.get(c, F.col(c)), c) for c in columns])
    old_row = F.struct(*[cast_like_dim(closing.get(c, F.col(f"__old.{c}")), c) for c in columns])
    rows = F.when(F.col("__key").isNull(), F.array(new_row)).otherwise(F.array(old_row, new_row))
    return changed.select(F.inline(rows))
