"""Shards cut along a Hilbert curve through several metadata dimensions.

Every dimension is quantised to bins of near equal counts (boundaries over all rows; texts by the rank of the whole
value, so a common beginning does not matter); the bins of a row give its place on the curve. Rows in curve order are cut into shards whose
row counts differ by one at most. Neighbours on the curve have similar values in every
dimension, so the smallest and largest values of a shard let a reader skip it.

Rows are range-partitioned by place on the curve and then id, so a value that a third of the
rows share is still cut into many partitions. A row's rank is its number in its partition
plus the sizes of the partitions before; both are written before use, as a partitioning by
sampled ranges may come out otherwise if a lost executor makes Spark repeat it.

Defined results: null dimension values sort first; null or equal ids are ordered by the other
columns; equal rows are interchangeable; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import partitions, stored

BITS = 6
ACCURACY = 10_000


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def as_number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column; of a text the text itself."""
    column = F.col(f"`{name}`")
    if is_text(df, name):
        return column
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType)):
        return column.cast("timestamp").cast("double")
    return column.cast("double")


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with `bits` bits in each column of `axes` (Gray-code transform in place)."""
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for d in range(dims):
            high = (x[d] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            x[d] ^= swap
        level >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    twist = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        twist ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= twist
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[d] >> bit) & 1)
    return index


def running(rows: DataFrame, n: str) -> DataFrame:
    """`rows`, written by task (__task), with __before: the sum of `n` over the tasks before. One row per task is summed in a window."""
    sizes = rows.groupBy("__task").agg(F.sum(n).alias("__n"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return rows.join(ahead, "__task")


def text_boundaries(df: DataFrame, name: str, bits: int) -> list[tuple[str, int]]:
    """(smallest value, bin) of every bin but the first, at most 2 ** bits - 1; a value's bin is its rank among all rows, scaled.

    Values are counted before they are ordered, so one that a third of the rows share is one row here.
    """
    counted = df.groupBy(F.col(f"`{name}`").alias("v")).agg(F.count("*").alias("n"))
    ordered = counted.repartitionByRange(partitions(df.sparkSession), "v").withColumn("__task", F.spark_partition_id())
    ordered = stored(ordered, "text-ranks")
    smaller = Window.partitionBy("__task").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("__before") + F.coalesce(F.sum("n").over(smaller), F.lit(0))
    total = ordered.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bins = running(ordered, "n").select("v", F.floor(rank * F.lit(2**bits) / F.lit(max(total, 1))).alias("bin")).where("v is not null and bin > 0")
    return sorted((r["v"], r["bin"]) for r in bins.groupBy("bin").agg(F.min("v").alias("v")).collect())


def text_bins(column: pa.Array, bounds: list[tuple[str, int]]) -> np.ndarray:
    """The bin of every text; a null is in the first."""
    coded = column.dictionary_encode()
    starts, numbers = [v for v, _ in bounds], [0, *(n for _, n in bounds)]
    of_value = np.array([*(numbers[bisect_right(starts, v)] for v in coded.dictionary.to_pylist()), 0], dtype=np.int64)
    return of_value[coded.indices.fill_null(len(of_value) - 1).to_numpy(zero_copy_only=False)]


def boundaries(df: DataFrame, dimensions: Sequence[str], bits: int) -> list:
    """For every dimension the bin boundaries, at most 2 ** bits - 1; all rows count."""
    cuts = F.array(*(F.lit(k / 2**bits) for k in range(1, 2**bits)))
    numbers = [d for d in dimensions if not is_text(df, d)]
    found = df.agg(*(F.percentile_approx(as_number(df, d), cuts, F.lit(ACCURACY)).alias(d) for d in numbers)).first() if numbers else []
    inner = {d: np.unique(np.array(values or [], dtype=np.float64)) for d, values in zip(numbers, found)}
    return [text_boundaries(df, d, bits) if is_text(df, d) else inner[d] for d in dimensions]


def on_curve(df: DataFrame, dimensions: Sequence[str], bits: int) -> DataFrame:
    """`df` with a column __curve."""
    bounds = boundaries(df, dimensions, bits)
    numbered = df.select("*", *(as_number(df, d).alias(f"__{k}") for k, d in enumerate(dimensions)))
    names = [*df.columns, "__curve"]
    kept = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = []
            for k, inner in enumerate(bounds):
                column = batch.column(kept + k)
                if isinstance(inner, list):
                    bins.append(text_bins(column, inner))
                    continue
                values = column.fill_null(-np.inf).to_numpy(zero_copy_only=False)
                bins.append(np.searchsorted(inner, values, side="right"))
            curve = hilbert_index(np.stack(bins, axis=1), bits)
            columns = [batch.column(k) for k in range(kept)] + [pa.array(curve, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return numbered.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("__curve", T.LongType())]))


def curve_shards(df: DataFrame, dimensions: Sequence[str], shards: int, order: Sequence[str], bits: int = BITS) -> DataFrame:
    """`df` with shard (0 to shards - 1) and slot (0 on, without gaps, in curve order); the counts differ by one at most.

    `df` should hold ids and metadata, not texts; existing columns named shard or slot are replaced. `order` breaks ties
    on the curve and is the order of the slots there.
    """
    spark = df.sparkSession
    rows = df.drop("shard", "slot")
    keys = ["__curve", *order]
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = on_curve(rows, dimensions, bits).repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    dealt = stored(dealt.withColumns({"__task": F.spark_partition_id(), "__number": number}), "curve-order")
    total = dealt.count()
    least, more = divmod(total, shards)
    wide = more * (least + 1)  # rows in the shards that have one more
    rank = F.col("__before") + F.col("__number")
    in_wide = F.floor(rank / F.lit(least + 1))
    in_rest = F.lit(more) + F.floor((rank - wide) / F.lit(max(least, 1)))
    shard = F.when(rank < wide, in_wide).otherwise(in_rest)
    start = F.when(shard < more, shard * (least + 1)).otherwise(wide + (shard - more) * least)
    return running(dealt.withColumn("__one", F.lit(1)), "__one").select(*(f"`{c}`" for c in rows.columns), shard.cast("int").alias("shard"), (rank - start).cast("long").alias("slot"))


def shard_ranges(layout: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Per shard its row count and the smallest and largest value of every dimension."""
    bounds = [f(F.col(f"`{d}`")).alias(f"{n}_{d}") for d in dimensions for n, f in (("min", F.min), ("max", F.max))]
    return layout.groupBy("shard").agg(F.count("*").alias("n_rows"), *bounds)


def write_shards(docs: DataFrame, layout: DataFrame, path: str, key: str = "doc_id", files_per_shard: int = 1) -> None:
    """Write whole rows by shard, in slot order, with the layout's shard and slot; joined by a unique `key`."""
    placed = docs.drop("shard", "slot").join(layout.select(key, "shard", "slot"), key)
    shards = layout.agg(F.coalesce(F.max("shard"), F.lit(0)) + 1).first()[0]
    ordered = placed.repartitionByRange(shards * files_per_shard, "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
