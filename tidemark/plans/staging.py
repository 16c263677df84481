"""Staging: typed, one row per natural key, as a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import utc
from tidemark.operators.dedupe import dedupe_latest
from tidemark.schemas import entity


def standardize(
    raw: DataFrame,
    table: str,
    since: datetime | None = None,
    tiebreak: Sequence[str] | None = None,
    with_key: Sequence[str] = (),
) -> DataFrame:
    """Latest raw row per key, cast to the declared types and cleaned.

    All raw columns break ties by default, so all are read. A caller that uses
    few columns may pass `tiebreak=("batch_id",)`: a batch holds a key once.
    `with_key` names columns that all rows of a key have in common; rows already moved by them do not move again.

    `since` keeps keys whose latest change is at or after it. The filter is
    applied to the raw rows before deduplication, where it can reach the scan:
    the latest row of a key passes it exactly if any row of the key does, and
    no row it removes could have won.
    """
    spec = entity(table)
    rows = raw if since is None else raw.where(F.col("updated_at") >= utc(since))
    latest = dedupe_latest(rows, [*with_key, *spec.key], tiebreak=tiebreak)
    dates = {source: name for name, source in spec.date_of}
    out = []
    for f in spec.staging_schema:
        value = f"cast({f.name} as {f.dataType.simpleString()})"
        if f.name in spec.lower_case:
            value = f"lower({value})"
        if f.name == "is_deleted" and spec.default_not_deleted:
            value = f"coalesce({value}, false)"
        out.append(f"{value} as {f.name}")
        if f.name in dates:
            out.append(f"to_date(cast({f.name} as timestamp)) as {dates[f.name]}")
    return latest.selectExpr(*out)
