"""Exact top-k search over integer vectors with vector-approximation files.

Components become floor(scale * x). Every dimension is cut into at most 2 ** `bits` cells at quantiles over all
vectors; the approximation file holds one byte per dimension. A scan of the approximations alone gives, for a query
and a vector, the largest and the smallest inner product any vector of these cells can have. Of a chunk of the file
only vectors whose upper bound reaches the k-th best lower bound of the chunk are passed on, then only those that reach
the k-th best lower bound of the query. Their exact vectors are read in the order of the upper bounds, some per query
and round, until no unread bound reaches the k-th best score found: then the result is certain.

A task of the scan holds one chunk of at most `chunk_rows` approximations and one block of about `query_rows` queries.
Equal vectors are one class from the start, which keeps its near + 1 smallest ids, so a vector that very many rows share is
read and scored once.

Defined results: vectors that are null, empty, or hold null or non-finite numbers take no part, nor do rows without id
or whose length is not the most frequent one (the longer of equal counts); zero vectors do take part. Integers are held
to +-10**15 and scores to the range of a long. Rows that repeat an id are candidates one by one, but never of a query with that
id; a repeated query id is searched once, with its smallest vector; ties go to the smaller id; fewer candidates than
wanted are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SCALE = 256
LARGEST = 10**15
BITS = 6
ACCURACY = 1000
CHUNK_ROWS = 16_384
QUERY_ROWS = 2048
SCORE_BLOCK = 128
FOUND = "query_id long, node long, lower double, upper double"


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, ints) of the rows that take part."""
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size("vector") > 0))
    held = lambda x: F.greatest(F.least(x * F.lit(float(scale)), F.lit(float(LARGEST))), F.lit(float(-LARGEST)))
    rows = stored(rows.select("vec_id", F.transform("vector", lambda x: F.floor(held(x)).cast("long")).alias("ints")), "integer-vectors")
    sizes = rows.groupBy(F.size("ints").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("ints") == (sizes["n"] if sizes else 0))


def vector_classes(rows: DataFrame, near: int) -> DataFrame:
    """(node, ints, ids, only): one row per distinct vector with its near + 1 smallest ids and how often each comes; `only` is the id of a class with one."""
    counted = rows.groupBy("ints", "vec_id").agg(F.count("*").alias("times"))
    first = Window.partitionBy("ints").orderBy("vec_id")
    few = counted.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= near + 1)
    ids = F.array_sort(F.collect_list(F.struct("vec_id", "times")))
    classes = few.groupBy("ints").agg(ids.alias("ids"))
    only = F.when(F.size("ids") == 1, F.col("ids")[0]["vec_id"])
    return stored(classes.select(F.monotonically_increasing_id().alias("node"), "ints", "ids", only.alias("only")), "vector-classes")


class Cells:
    """The cells of every dimension: where they begin, their middles and half widths."""

    def __init__(self, bounds: list[tuple[int, int, list[int]]]) -> None:
        self.inner = [np.unique([x for x in cuts if low < x <= high]).astype(np.int64) for low, high, cuts in bounds]
        width = max((len(x) for x in self.inner), default=0) + 1
        self.middle, self.half = np.zeros((len(bounds), width)), np.zeros((len(bounds), width))
        for d, (low, high, _) in enumerate(bounds):
            begins = np.concatenate([[low], self.inner[d]]).astype(float)
            ends = np.concatenate([self.inner[d] - 1, [high]]).astype(float)
            self.middle[d, : len(begins)] = (begins + ends) / 2
            self.half[d, : len(begins)] = (ends - begins) / 2

    def place(self, ints: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(inner, ints[:, d], side="right") for d, inner in enumerate(self.inner)]
        return np.stack(found, axis=1).astype(np.uint8) if found else np.empty((len(ints), 0), np.uint8)

    def spread(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(cells.shape[1])
        return self.middle[at, cells], self.half[at, cells]


def fit_cells(classes: DataFrame, bits: int) -> Cells:
    """Cells at the quantiles of all classes; one row per dimension reaches the driver."""
    cuts = F.array(*(F.lit(k / 2**bits) for k in range(1, 2**bits)))
    values = classes.select(F.posexplode("ints").alias("d", "x")).groupBy("d").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.percentile_approx("x", cuts, F.lit(ACCURACY)).alias("cuts")
    )
    return Cells([(r["low"], r["high"], r["cuts"]) for r in sorted(values.collect(), key=lambda r: r["d"])])


def _matrix(column, kind) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(kind)


def approximations(classes: DataFrame, cells: Cells) -> DataFrame:
    """The approximation file: (node, only, cells), one byte per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = cells.place(_matrix(batch.column(2), np.int64)) if batch.num_rows else []
            packed = pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["node", "only", "cells"])

    return classes.select("node", "only", "ints").mapInArrow(run, "node long, only long, cells binary")


def bounded(queries: pa.Table, points: pa.Table, cells: Cells, near: int) -> Iterator[pa.Table]:
    """(query_id, node, lower, upper) of the points that could be among the `near` best of their chunk, by their cells alone."""
    names = queries["query_id"].to_numpy()
    wanted = _matrix(queries["ints"], np.float64)
    node = points["node"].to_numpy()
    lone = points["only"].is_valid().to_numpy()
    only = points["only"].fill_null(0).to_numpy()
    packed = np.frombuffer(b"".join(points["cells"].to_pylist()), dtype=np.uint8).reshape(len(node), -1)
    middle, half = cells.spread(packed)
    # Sums of products may round; the bounds are widened by more than that.
    largest = np.linalg.norm(np.abs(middle) + half, axis=1).max()
    for at in range(0, len(names), SCORE_BLOCK):
        block, own = wanted[at : at + SCORE_BLOCK], names[at : at + SCORE_BLOCK]
        centre, reach = block @ middle.T, np.abs(block) @ half.T
        reach += (np.linalg.norm(block, axis=1) * largest * 1e-12)[:, None]
        lower, upper = centre - reach, centre + reach
        same = lone[None, :] & (own[:, None] == only[None, :])
        lower[same] = upper[same] = -np.inf
        if near < len(node):
            least = np.partition(lower, len(node) - near, axis=1)[:, len(node) - near]
        else:
            least = np.full(len(block), -np.inf)
        q, p = np.nonzero((upper >= least[:, None]) & (upper > -np.inf))
        yield pa.table({"query_id": own[q], "node": node[p], "lower": lower[q, p], "upper": upper[q, p]})


def _score(large: bool) -> Column:
    """The inner product of `asked` and `ints`; in decimals, held to the range of a long, where products could pass it."""
    if not large:
        return F.aggregate(F.zip_with("asked", "ints", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    wide = "decimal(38,0)"
    product = F.zip_with("asked", "ints", lambda a, b: (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(wide))
    total = F.aggregate(product, F.lit(0).cast(wide), lambda s, x: (s + x).cast(wide))
    top = F.lit(2**63 - 1).cast(wide)
    return F.greatest(F.least(total, top), (-top - 1).cast(wide)).cast("long")


def exact_search(
    df: DataFrame,
    is_query: Column,
    near: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    bits: int = BITS,
    chunk_rows: int = CHUNK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): of the rows where `is_query` (over column vec_id) the `near` other rows with the largest integer inner product."""
    rows = integer_vectors(df, vec_id, vector, scale)
    classes = vector_classes(rows, near)
    cells = fit_cells(classes, bits)
    queries = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("ints").alias("ints"))
    queries = stored(queries, "queries")
    chunks = max(1, -(-classes.count() // chunk_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    # Where a product is summed in longs it cannot pass their range.
    reach = float(np.abs(cells.middle).max(initial=0) + cells.half.max(initial=0))
    large = reach**2 * len(cells.inner) >= 2.0**62

    points = approximations(classes, cells).withColumn("chunk", F.pmod(F.hash("node"), F.lit(chunks)))
    points = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn("block", F.pmod(F.hash("query_id"), F.lit(blocks)))
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "lower": pa.array([], pa.float64()), "upper": pa.array([], pa.float64())})
        return pa.concat_tables(list(bounded(left, right, cells, near)))

    met = asked.groupBy("block", "chunk").cogroup(points.groupBy("block", "chunk")).applyInArrow(scan, FOUND)
    by_lower = Window.partitionBy("query_id").orderBy(F.desc("lower"))
    whole = by_lower.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    least = F.nth_value("lower", near).over(whole)
    by_upper = Window.partitionBy("query_id").orderBy(F.desc("upper"), "node")
    kept = met.withColumn("least", least).where(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
    kept = stored(kept.select("query_id", "node", "upper", F.row_number().over(by_upper).alias("turn")), "bounded")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def read(some: DataFrame) -> DataFrame:
        """(query_id, vec_id, score) of exact vectors, for the rows of a class one by one."""
        named = queries.select("query_id", F.col("ints").alias("asked"))
        both = some.select("query_id", "node").join(classes.select("node", "ints", "ids"), "node").join(named, "query_id")
        others = F.filter("ids", lambda x: x["vec_id"] != F.col("query_id"))
        each = F.transform(others, lambda x: F.array_repeat(x["vec_id"], F.least(x["times"], F.lit(near)).cast("int")))
        scored = both.select("query_id", _score(large).alias("score"), F.flatten(each).alias("others"))
        return scored.select("query_id", F.explode("others").alias("vec_id"), "score")

    done, until = 0, 2 * near
    found = None
    while True:
        turn = F.col("turn")
        if found is None:
            left = kept
        else:
            sure = found.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
            left = kept.where(turn > done).join(sure.where(F.col("n") == near), "query_id", "left")
            left = left.where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth")))
            if left.isEmpty():
                break
        more = read(left.where(turn <= until))
        more = more if found is None else more.unionByName(found.select("query_id", "vec_id", "score"))
        ranked = more.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= near)
        found = stored(ranked, "best-so-far")
        done, until = until, 4 * until
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
