"""Nearest neighbours by learned partitions.

On a sample of bounded size: the graph of each vector's nearest neighbours is cut into balanced
parts (recursive spectral bisection, refined by swapping pairs across the cut), and a small
network learns which parts a vector and its neighbours lie in. The network then places every row
of the table in its most probable part, and sends a query to the several most probable ones. How
many is measured: for sample vectors the network has not learned from, the nearest rows in the whole
table are found by brute force, and as few parts are searched as reach the wanted recall of them.

Parts above `chunk_rows` rows are cut into chunks by id, so a vector that very many rows share is no
hot group; the queries are cut into blocks of about `query_rows` by id, so a task holds one chunk and one block at most. Each
returns the best of its chunk, in double precision on the original vectors, and the best of those
per query are kept; that is `near` rows per query and chunk searched, so chunks are as large as memory allows. Only the fitted model and the row counts of the parts reach the driver.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers take no part,
nor do rows without id or whose length is not the most frequent one (the longer of equal counts); rows
that repeat an id are candidates one by one, but never of a query with that id, and a repeated query
id is searched once, with its smallest vector; ties go to the smaller id; fewer candidates than wanted
are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import sampled, stored

SAMPLE_ROWS = 4096
PART_ROWS = 8192
MOST_PARTS = 64
FEW_PARTS, LEAST_ROWS = 16, 128  # small tables have up to so many parts, of so many rows
CHUNK_ROWS = 16_384
RECALL = 0.96
GRAPH_DEGREE = 10
QUERY_BLOCK = 256
QUERY_ROWS = 65_536
MEASURED = 256  # sample vectors whose nearest rows are found by brute force


# -- fitting on the sample -----------------------------------------------------------


def nearest(queries: np.ndarray, points: np.ndarray, k: int, skip: np.ndarray | None = None) -> np.ndarray:
    """Places of the k points with the largest inner product per query; `skip` is each query's own place."""
    out = []
    for at in range(0, len(queries), 512):
        scores = queries[at : at + 512] @ points.T
        if skip is not None:
            scores[np.arange(len(scores)), skip[at : at + 512]] = -np.inf
        out.append(np.argpartition(-scores, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def bisect(left: np.ndarray, right: np.ndarray, size: int, first: int, rng: np.random.Generator) -> np.ndarray:
    """True for the `first` nodes of one side of a graph with `size` nodes and edges left-right."""
    degree = np.bincount(left, minlength=size) + np.bincount(right, minlength=size) + 1e-9
    x = rng.normal(size=size)
    for _ in range(60):
        x -= (x * degree).sum() / degree.sum()
        around = np.bincount(left, x[right], size) + np.bincount(right, x[left], size)
        x = 0.5 * x + 0.5 * around / degree
        x /= np.abs(x).max() + 1e-30
    side = np.zeros(size, dtype=bool)
    side[np.argsort(x, kind="stable")[:first]] = True
    for _ in range(20):
        across = (side[left] != side[right]) * 2.0 - 1
        gain = np.bincount(left, across, size) + np.bincount(right, across, size)
        ours, theirs = np.flatnonzero(side), np.flatnonzero(~side)
        ours, theirs = ours[np.argsort(-gain[ours])], theirs[np.argsort(-gain[theirs])]
        n = min(len(ours), len(theirs))
        better = int((gain[ours[:n]] + gain[theirs[:n]] > 2).sum())
        if not better:
            break
        some = max(1, better // 4)  # neighbours that change sides together gain less than the sum
        side[ours[:some]], side[theirs[:some]] = False, True
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """Parts 0 to parts - 1 of near equal size with few edges across; row i of `graph` has the neighbours of node i."""
    rng = np.random.default_rng(seed)
    out = np.zeros(len(graph), dtype=np.int64)
    left = np.repeat(np.arange(len(graph)), graph.shape[1])
    right = graph.ravel()

    def split(nodes: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[nodes] = low
            return
        middle = (low + high) // 2
        place = np.full(len(graph), -1)
        place[nodes] = np.arange(len(nodes))
        inside = (place[left] >= 0) & (place[right] >= 0)
        first = len(nodes) * (middle - low) // (high - low)
        side = bisect(place[left[inside]], place[right[inside]], len(nodes), first, rng)
        split(nodes[side], low, middle)
        split(nodes[~side], middle, high)

    split(np.arange(len(graph)), 0, parts)
    return out


@dataclass
class Router:
    """One hidden layer over the unit vector; gives the probability of every part."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.out_bias)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.maximum(unit @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def place(self, vectors: np.ndarray) -> np.ndarray:
        return self.scores(vectors).argmax(axis=1)


def learn(vectors: np.ndarray, targets: np.ndarray, width: int = 128, rounds: int = 30, seed: int = 5) -> Router:
    """Adam steps on the cross entropy against the shares of parts around each vector."""
    rng = np.random.default_rng(seed)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    weights = [
        rng.normal(0, 1.5 / np.sqrt(unit.shape[1]), (unit.shape[1], width)), np.zeros(width),
        rng.normal(0, 1 / np.sqrt(width), (width, targets.shape[1])), np.zeros(targets.shape[1]),
    ]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(rounds):
        for rows in np.array_split(rng.permutation(len(unit)), max(1, len(unit) // 128)):
            step += 1
            raised = np.maximum(unit[rows] @ weights[0] + weights[1], 0)
            logits = raised @ weights[2] + weights[3]
            share = np.exp(logits - logits.max(axis=1, keepdims=True))
            slope = (share / share.sum(axis=1, keepdims=True) - targets[rows]) / len(rows)
            back = (slope @ weights[2].T) * (raised > 0)
            for k, g in enumerate((unit[rows].T @ back, back.sum(axis=0), raised.T @ slope, slope.sum(axis=0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                weights[k] -= 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Router(*weights)


def fit(sample: np.ndarray, parts: int, near: int, recall: float = RECALL) -> Router:
    """Graph, balanced parts and router of a sample; probes so that held-out vectors find their `near` nearest in it."""
    if parts < 2 or len(sample) < 4 * parts:
        dims = sample.shape[1] if sample.ndim == 2 else 1
        return Router(np.zeros((dims, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    held = max(16, len(sample) // 5)
    rest = sample[held:]
    graph = nearest(rest, rest, min(GRAPH_DEGREE, len(rest) - 1), np.arange(len(rest)))
    part = balanced_parts(graph, parts)
    targets = np.eye(parts)[part] * 0.5
    for column in graph.T:
        targets += np.eye(parts)[part[column]] * (0.5 / graph.shape[1])
    router = learn(rest, targets)
    found = nearest(sample[:held], sample, min(near, len(sample) - 1), np.arange(held))
    order = np.argsort(-router.scores(sample[:held]), axis=1)
    turn = np.argsort(order, axis=1)  # at which probe a part is searched
    turns = np.take_along_axis(turn, router.place(sample)[found], axis=1)
    share = np.bincount(turns.ravel(), minlength=parts).cumsum() / turns.size
    router.probes = int(np.searchsorted(share, recall)) + 1
    return router


def measured_probes(placed: DataFrame, router: Router, ids: np.ndarray, asked: np.ndarray, near: int, recall: float) -> int:
    """As few parts as hold `recall` of the `near` nearest rows of the table for the vectors `asked`, whose own ids are left out.

    A task keeps the best of its rows per vector, so at most `near` rows a vector and task are shuffled.
    """

    def best(batches):
        score, part = np.empty((len(asked), 0)), np.empty((len(asked), 0), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            names, matrix, parts = batch.column(0).to_numpy(), _matrix(batch.column(1)), batch.column(2).to_numpy()
            for at in range(0, len(names), 4096):
                block = slice(at, at + 4096)
                rough = asked @ matrix[block].T
                rough[ids[:, None] == names[None, block]] = -np.inf
                score = np.hstack([score, rough])
                part = np.hstack([part, np.broadcast_to(parts[block], rough.shape)])
                if score.shape[1] > near:
                    top = np.argpartition(-score, near - 1, axis=1)[:, :near]
                    score, part = np.take_along_axis(score, top, axis=1), np.take_along_axis(part, top, axis=1)
        query, at = np.nonzero(score > -np.inf)
        columns = [pa.array(query, pa.int32()), pa.array(score[query, at], pa.float64()), pa.array(part[query, at], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "score", "part"])

    order = Window.partitionBy("query").orderBy(F.desc("score"), "part")
    found = placed.mapInArrow(best, "query int, score double, part int").withColumn("rank", F.row_number().over(order))
    turn = np.argsort(np.argsort(-router.scores(asked), axis=1), axis=1)  # at which probe a part is searched
    hits = np.zeros(router.parts)
    for r in found.where(F.col("rank") <= near).groupBy("query", "part").count().collect():
        hits[turn[r["query"], r["part"]]] += r["count"]
    return int(np.searchsorted(hits.cumsum(), recall * hits.sum())) + 1


# -- the table -----------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def usable_rows(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (sizes["n"] if sizes else 0))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def best_of_chunk(queries: pa.Table, points: pa.Table, near: int) -> pa.Table:
    """(query_id, vec_id, score) of the `near` best points per query; ties to smaller ids."""
    ids = points["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, matrix = ids[order], _matrix(points["vector"])[order]
    largest = np.linalg.norm(matrix, axis=1).max()
    names = queries["vec_id"].to_numpy()
    wanted = _matrix(queries["vector"])
    out = [[], [], []]
    for at in range(0, len(names), QUERY_BLOCK):
        block = wanted[at : at + QUERY_BLOCK]
        rough = block @ matrix.T
        rough[names[at : at + QUERY_BLOCK, None] == ids[None, :]] = -np.inf
        if near < len(ids):
            least = np.partition(rough, len(ids) - near, axis=1)[:, len(ids) - near]
        else:
            least = np.full(len(block), -np.inf)
        # Products of different shape may round differently: all that could be among the best are measured again alike.
        slack = np.linalg.norm(block, axis=1) * largest * 1e-12
        for k, query in enumerate(block):
            close = np.flatnonzero((rough[k] >= least[k] - slack[k]) & (rough[k] > -np.inf))
            score = (matrix[close] * query).sum(axis=1)
            best = np.lexsort((ids[close], -score))[:near]
            out[0].append(np.full(len(best), names[at + k]))
            out[1].append(ids[close][best])
            out[2].append(score[best])
    columns = [np.concatenate(x) if x else np.empty(0) for x in out]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})


def _routes(router: Router, chunks: list[int], probes: int) -> Callable:
    """For a batch of queries, a row for every chunk of the parts each is sent to."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-router.scores(_matrix(batch.column(1))), axis=1)
            rows, parts, pieces = [], [], []
            for k, own in enumerate(order.tolist()):
                for part in own[:probes]:
                    for piece in range(chunks[part]):
                        rows.append(k)
                        parts.append(part)
                        pieces.append(piece)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(parts, pa.int32()), pa.array(pieces, pa.int32())],
                ["vec_id", "vector", "part", "chunk"],
            )

    return run


def nearest_neighbours(
    df: DataFrame,
    is_query: Column,
    near: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    recall: float = RECALL,
    part_rows: int = PART_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): of the rows where `is_query` (over column vec_id) the nearest other rows, by inner product."""
    rows = stored(usable_rows(df, vec_id, vector), "vectors")
    total = rows.count()
    drawn = sampled(rows, {"vec_id": F.col("vec_id"), "vector": F.col("vector")}, ["vec_id"], sample_rows)
    sample = np.array([r["vector"] for r in drawn], dtype=np.float64)
    parts = min(MOST_PARTS, max(1, -(-total // part_rows), min(FEW_PARTS, total // LEAST_ROWS)))
    router = fit(sample, parts, near, recall)

    def place(batches):
        for batch in batches:
            found = router.place(_matrix(batch.column(1))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], ["vec_id", "vector", "part"])

    placed = stored(rows.mapInArrow(place, "vec_id long, vector array<double>, part int"), "placed-vectors")
    if router.parts > 1:
        asked = min(MEASURED, max(16, len(sample) // 5))  # of those held back from the fit
        ids = np.array([r["vec_id"] for r in drawn[:asked]])
        router.probes = measured_probes(placed, router, ids, sample[:asked], near, recall)
    count = dict(placed.groupBy("part").count().collect())
    chunks = [-(-count.get(p, 0) // chunk_rows) for p in range(router.parts)]
    # Parts may be uneven: enough of them that even the smallest hold several times what is wanted.
    sizes = sorted(count.get(p, 0) for p in range(router.parts))
    probes = max(router.probes, int(np.searchsorted(np.cumsum(sizes), min(total, 4 * near))) + 1)
    probes = min(probes, router.parts)
    cuts = F.array(*(F.lit(max(c, 1)) for c in chunks))
    points = placed.withColumn("chunk", F.pmod(F.hash("vec_id"), F.element_at(cuts, F.col("part") + 1)))
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-rows.where(is_query).count() // query_rows))
    routed = queries.mapInArrow(_routes(router, chunks, probes), "vec_id long, vector array<double>, part int, chunk int")
    routed = routed.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    points = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return best_of_chunk(left, right, near)

    schema = T.StructType(
        [T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())]
    )
    found = routed.groupBy("part", "chunk", "block").cogroup(points.groupBy("part", "chunk", "block")).applyInArrow(search, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= near)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
