"""Ordered work inside a key that may hold a large share of all rows.

A window function puts all rows of a key into one task. For the few keys above
a row limit, the rows are put in one order by a range partitioning over (key, order)
and cut by their place in it: every chunk is a contiguous stretch of one or more keys, windows run inside
(key, chunk), and one summary row per (key, chunk) carries the value across the
cut. The chunk number is written to the shared checkpoint folder before use,
since a recomputed range partitioning may cut elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import orderable
from tidemark.session import durable

CHUNK = "__chunk"
PLACE = "__place"
PIECE_ROWS = 1_000_000  # rows of a range partition, about
HOT_ROWS = 5_000_000


def keys_above(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than `limit` rows and their counts; combined before the shuffle."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("__rows"))
        .where(F.col("__rows") > limit)
    )


def in_order(df: DataFrame, key: str, order: Sequence[str], chunk_rows: int, total: int) -> DataFrame:
    """`df` by range in (key, order), with the sorted place of each row: the partition in the upper bits, from bit 33, the row in it below.

    Small chunks do not make more partitions than the session's shuffles have: the bounds come from a sample on the driver
    that is in proportion to the number of partitions, and holds the columns of the order.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = min(-(-total // chunk_rows), max(usual, -(-total // PIECE_ROWS)))
    ranged = df.repartitionByRange(max(2, pieces), key, *order).sortWithinPartitions(key, *order)
    return ranged.withColumn(PLACE, F.monotonically_increasing_id())


def ordered_chunks(df: DataFrame, key: str, order: Sequence[str], chunk_rows: int, total: int) -> DataFrame:
    """`df` with a chunk number that ascends with (key, order) and has at most `chunk_rows` rows; `total` need not be exact."""
    row = F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    chunk = F.col(PLACE) - row + F.floor(row / chunk_rows)
    return durable(in_order(df, key, order, chunk_rows, total).withColumn(CHUNK, chunk).drop(PLACE))


def _lead_plain(df: DataFrame, key: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(out, F.lead(value).over(window))


def _lead_chunked(
    df: DataFrame, key: str, order: Sequence[str], value: str, out: str, chunk_rows: int, total: int
) -> DataFrame:
    columns = df.columns
    # Equal copies collapse to one counted row before any shuffle and are spread again at the end.
    copies = df.groupBy(*columns).agg(F.count("*").alias("__copies"))
    chunks = ordered_chunks(copies, key, order, chunk_rows, total)
    inside = Window.partitionBy(key, CHUNK).orderBy(*order)
    across = Window.partitionBy(key).orderBy(CHUNK)
    firsts = (
        chunks.groupBy(key, CHUNK)
        .agg(F.min(F.struct(*order, F.col(value).alias("__value"))).alias("__head"))
        .select(key, CHUNK, F.lead("__head.__value").over(across).alias("__carry"))
    )
    stepped = (
        chunks.withColumns({"__next": F.lead(value).over(inside), "__last": F.lead(F.lit(True)).over(inside).isNull()})
        .join(firsts, [key, CHUNK])
        .withColumn("__next", F.when(F.col("__last"), F.col("__carry")).otherwise(F.col("__next")))
    )
    # Of m equal copies, m - 1 are followed by a copy and one by the next row.
    block = 100_000
    blocks = stepped.withColumn("__block", F.explode(F.sequence(F.lit(0), F.expr(f"(__copies - 1) div {block}"))))
    spread = blocks.repartition(F.hash(*columns), F.col("__block")).withColumn(
        "__copy",
        F.explode(
            F.sequence(
                F.col("__block") * block + 1,
                F.least(F.col("__copies"), (F.col("__block") + 1) * block),
            )
        ),
    )
    following = F.when(F.col("__copy") < F.col("__copies"), F.col(value)).otherwise(F.col("__next"))
    return spread.select(*columns, following.alias(out))


def lead_within_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    value: str,
    out: str,
    hot_rows: int | None = HOT_ROWS,
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """Add the `value` of the next row of the same key in `order_by` order.

    Remaining columns break ties. Pass `hot_rows=None` when no key can be hot,
    for instance after `dedupe_latest`; this saves the counting job.
    """
    rest = orderable(df, [c for c in df.columns if c != key and c not in order_by])
    order = [*order_by, *rest]
    if hot_rows is None:
        return _lead_plain(df, key, order, value, out)
    hot = keys_above(df, key, hot_rows)
    # At most rows / hot_rows keys can pass; only their number and row total come here.
    found = hot.agg(F.count("*").alias("n"), F.sum("__rows").alias("rows")).first()
    if not found["n"]:
        return _lead_plain(df, key, order, value, out)
    hot = durable(hot.select(key))
    cold_rows = df.join(hot, key, "left_anti")
    hot_rows_df = df.join(hot, key, "left_semi")
    return _lead_plain(cold_rows, key, order, value, out).unionByName(
        _lead_chunked(hot_rows_df, key, order, value, out, chunk_rows, found["rows"])
    )
