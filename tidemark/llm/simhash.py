"""SimHash near-dedup by a segment-popcount embedding and a grid range join.

A fingerprint word of 64 bits is mapped to the bit counts of its 2-bit segments. The
Manhattan distance of two such count vectors never exceeds the number of differing
bits, so pairs within `radius` bits lie within `radius` in the grid of counts, and one
of the two halves of the word lies within `radius // 2`. For radius 3 that is 1: a
fingerprint is stored in the grid cell of each half and looked up in that cell and in
the cells one step up in one segment (the pair is found from its lower side). Pairs
that meet in a cell are verified on the whole fingerprints.

Equal fingerprints are one row from the start. The lookup streams: of a cell only its
stored fingerprints are in memory, cells with more than `cell_rows` of them are cut
into several, each of which sees all lookups. Tasks return the links they find as
stars, so a group of n near copies gives about n links and not n squared.

Defined results: a null text counts as empty; texts without words have fingerprint zero
and are linked to each other; repeated rows share their component; null ids are ignored
when the smallest id of a component is taken (null if there is no other).

The corpus pipeline (keep_one) has another contract: documents whose sets of 5-word shingles have a Jaccard
similarity of 0.8 or more are near copies. The grid comes first there too, over the SimHash words of the shingle sets; the
links it finds are verified on the sets. It meets few pairs as far apart as 0.8, so candidates for the rest, documents that
the grid has not connected, come from MinHash bands. In a band each document is compared with its neighbour in the order of the segment counts and with the most
central one, whose bands are the fullest: the original of many copies, mostly, which links them all. Of bands whose documents are then not all connected, documents meet that share one of their rarest shingles: of two sets
with that similarity the rarest fifth of each, and one more, have a shingle in common, whatever the counts. A
passage that all documents of a band share is among their rarest in none, so it makes no pairs, and documents that share
no band do not meet. Every link is verified on the sets,
and nothing but the sets refuses one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, in_files, partitions, stored, utf8_list
from tidemark.llm.components import component_roots
from tidemark.operators.reduce import broadcast_if_small

SEED = 42
RADIUS = 3
STEP = 1 << 16
FILE_DOCUMENTS = 10_000  # documents whose rows make a scratch file


def shingle_hashes(data: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of the lower-cased words, in blocks; one of all words if they are fewer."""
    tokens = data.lower().split()
    if len(tokens) <= words:
        if tokens:
            yield np.array([xxhash.xxh64_intdigest(b" ".join(tokens), SEED)], dtype=np.uint64)
        return
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(tokens) - words] + 1]).tolist()
    ends = ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), STEP):
        block = [digest(line[a:b], SEED) for a, b in zip(starts[at : at + STEP], ends[at : at + STEP])]
        yield np.array(block, dtype=np.uint64)


def remix(hashes: np.ndarray, turn: int) -> np.ndarray:
    """The hashes themselves for turn 0, else another 64-bit hash derived from them."""
    if not turn:
        return hashes
    x = hashes + np.uint64((0x9E3779B97F4A7C15 * turn) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(data: bytes, words: int, turns: int = 1) -> list[int]:
    """`turns` words of 64 bits; a bit is set if it is set in over half of the shingle hashes."""
    return majority(shingle_hashes(data, words), turns)


def majority(blocks: Iterable[np.ndarray], turns: int) -> list[int]:
    total, counts = 0, np.zeros((turns, 64), dtype=np.int64)
    for hashes in blocks:
        total += len(hashes)
        for turn in range(turns):
            octets = remix(hashes, turn).view(np.uint8).reshape(-1, 8)
            counts[turn] += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > total, axis=1, bitorder="little").view(np.int64).ravel().tolist()


def fingerprints(docs: DataFrame, words: int, turns: int) -> DataFrame:
    """(doc_id, w0, w1, ...) per row of (doc_id, text)."""
    names = [f"w{k}" for k in range(turns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x, words, turns) for x in utf8_list(batch.column(1))]
            table = np.array(found, dtype=np.int64).reshape(-1, turns)
            columns = [pa.array(table[:, k]) for k in range(turns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names)
    return docs.mapInArrow(run, schema)


def _counts(word: np.ndarray) -> np.ndarray:
    """The bit counts of the 2-bit segments, each in its own two bits."""
    return word - ((word >> np.uint64(1)) & np.uint64(0x5555555555555555))


def _cells(batches: Iterator[pa.RecordBatch], turns: int) -> Iterator[pa.RecordBatch]:
    """Rows (cell, probe, node, words) for every half of every word: where it is stored and where it is looked up.

    A cell number holds the 16 counts of the half, the half, and the word's place.
    """
    for batch in batches:
        node = batch.column(0).to_numpy()
        words = [batch.column(1 + k).to_numpy() for k in range(turns)]
        cells, probes, rows = [], [], []
        index = np.arange(len(node))
        for k in range(turns):
            counts = _counts(words[k].view(np.uint64))
            for half in range(2):
                part = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
                base = part | np.uint64(((2 * k + half) << 32))
                cells.append(base)
                probes.append(np.zeros(len(node), dtype=np.int8))
                rows.append(index)
                for segment in range(16):
                    room = ((part >> np.uint64(2 * segment)) & np.uint64(3)) < 2
                    cells.append(base[room] + np.uint64(1 << (2 * segment)))
                    probes.append(np.ones(int(room.sum()), dtype=np.int8))
                    rows.append(index[room])
        order = np.concatenate(rows)
        columns = [np.concatenate(cells).view(np.int64), np.concatenate(probes), node[order]]
        columns += [w[order] for w in words]
        names = ["cell", "probe", "node", *[f"w{k}" for k in range(turns)]]
        whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
        for at in range(0, whole.num_rows, STEP):
            yield whole.slice(at, STEP)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as the given ones: each node with the smallest of its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        old = root.copy()
        np.minimum.at(root, old[x], low)
        np.minimum.at(root, old[y], low)
        root = root[root]
        if np.array_equal(root, old):
            break
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _links(batches: Iterator[pa.RecordBatch], turns: int, radius: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Links between a stored fingerprint and any later row of its cell; rows come sorted by cell, stored ones first.

    A link needs at most `bits` differing bits over all words; with one word that is `radius`.
    """
    width, limit = 1 << 21, 1 << 20
    kept: tuple | None = None
    found_a: list[np.ndarray] = []
    found_b: list[np.ndarray] = []
    held = 0

    def reduced() -> tuple[np.ndarray, np.ndarray]:
        return stars(np.concatenate(found_a), np.concatenate(found_b))

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        cell, chunk, probe, node = (batch.column(k).to_numpy() for k in range(4))
        words = [batch.column(4 + k).to_numpy().view(np.uint64) for k in range(turns)]
        old = 0
        if kept is not None:
            old = len(kept[0])
            cell, chunk, probe, node = (np.concatenate([kept[k], v]) for k, v in enumerate((cell, chunk, probe, node)))
            words = [np.concatenate([kept[4 + k], w]) for k, w in enumerate(words)]
        change = np.flatnonzero((cell[1:] != cell[:-1]) | (chunk[1:] != chunk[:-1])) + 1
        ends = np.concatenate([change, [len(cell)]])
        end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
        store = np.flatnonzero(probe == 0)
        first = np.maximum(store + 1, old)
        many = np.maximum(end[store] - first, 0)
        done = 0
        until = np.cumsum(many)
        while done < len(store):
            base = until[done - 1] if done else 0
            stop = max(int(np.searchsorted(until, base + width, side="right")), done + 1)
            n = many[done:stop]
            left = np.repeat(store[done:stop], n)
            right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[done:stop], n)
            apart = sum(np.bitwise_count(w[left] ^ w[right]).astype(np.int16) for w in words)
            hit = np.flatnonzero((apart <= bits) & (node[left] != node[right]))
            if len(hit):
                found_a.append(node[left[hit]])
                found_b.append(node[right[hit]])
                held += len(hit)
            done = stop
        if held > limit:
            a, b = reduced()
            if len(a) > limit // 2:
                yield out(a, b)
                found_a, found_b, held = [], [], 0
            else:
                found_a, found_b, held = [a], [b], len(a)
        last = store[(cell[store] == cell[-1]) & (chunk[store] == chunk[-1])] if len(cell) else store
        kept = tuple(v[last] for v in (cell, chunk, probe, node, *words))
    if held:
        yield out(*reduced())


def near_links(classes: DataFrame, turns: int, bits: int = RADIUS, cell_rows: int = 20_000) -> DataFrame:
    """Links (a, b) between the nodes of `classes` (node, w0, ...), reduced to stars per task.

    Every pair within 3 bits in some word and within `bits` bits over all words is connected by the links returned,
    and every link is between nodes within `bits` bits or between nodes such links connect.
    """
    spark = classes.sparkSession
    words = [f"w{k}" for k in range(turns)]
    schema = "cell long, probe tinyint, node long, " + ", ".join(f"{w} long" for w in words)
    cells = classes.select("node", *words).mapInArrow(lambda it: _cells(it, turns), schema)
    crowded = (
        cells.where("probe = 0").groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
        .select("cell", F.ceil(F.col("n") / cell_rows).cast("int").alias("chunks"))
    )
    crowded = in_files(crowded, classes.count(), "crowded-cells", FILE_DOCUMENTS)
    several = crowded.count()
    dealt = cells.withColumn("chunk", F.lit(0))
    if several:
        parts = cells.join(broadcast_if_small(crowded, several), "cell", "left")
        own = F.when(F.col("probe") == 0, F.pmod(F.hash("node"), F.col("chunks"))).otherwise(F.col("chunks") - 1)
        whole = F.sequence(F.lit(0), F.coalesce(own, F.lit(0)))
        dealt = parts.withColumn("own", own).withColumn("chunk", F.explode(whole))
        dealt = dealt.withColumn("probe", F.when(F.col("chunk") < F.col("own"), F.lit(1)).otherwise(F.col("probe")).cast("tinyint"))
    dealt = dealt.select("cell", "chunk", "probe", "node", *words)
    sorted_cells = dealt.repartition(partitions(spark), "cell", "chunk").sortWithinPartitions("cell", "chunk", "probe")
    return sorted_cells.mapInArrow(lambda it: _links(it, turns, RADIUS, bits), "a long, b long")


def near_components(
    docs: DataFrame, words: int = 5, turns: int = 1, bits: int = RADIUS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, the fingerprint words w0, ..., and component_id, the smallest id reachable."""
    names = [f"w{k}" for k in range(turns)]
    prints = stored(fingerprints(id_and_text(docs, doc_id, text), words, turns), "fingerprints")
    classes = prints.groupBy(*names).agg(F.min("doc_id").alias("first"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "fingerprint-classes")
    links = stored(near_links(classes, turns, bits), "near-links")
    roots = component_roots(links)
    rooted = stored(classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    labelled = stored(rooted.join(smallest, "root").select(*names, "component_id"), "labelled")
    return prints.join(labelled, names).select("doc_id", *names, "component_id")


# For the corpus. Bands of five minima: a pair at similarity 0.8 shares one of 20 with probability 0.9996.
WORDS = 5
BANDS, DEPTH = 20, 5
SIMILAR = (4, 5)  # shared shingles of all shingles of a pair, at least
HUB = 64  # pairs of a node that are verified together
FILE_PAIRS = 2_000  # pairs, or crowded nodes with their shingles, of a scratch file
_DRAWS = np.random.default_rng(SEED).integers(0, 2**63, (2, BANDS * DEPTH, 1), dtype=np.uint64)
_XOR, _ODD = _DRAWS[0], _DRAWS[1] * np.uint64(2) + np.uint64(1)


def shingle_set(data: bytes, words: int) -> np.ndarray:
    blocks = list(shingle_hashes(data, words))
    return np.unique(np.concatenate(blocks)) if blocks else np.empty(0, dtype=np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets have the wanted Jaccard similarity; empty ones are equal."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared * SIMILAR[1] >= (len(a) + len(b) - shared) * SIMILAR[0]


def bands(shingles: np.ndarray) -> np.ndarray:
    """One hash per band of minima, none for an empty set."""
    if not len(shingles):
        return np.empty(0, dtype=np.int64)
    least = np.full(BANDS * DEPTH, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, ((shingles[None, at : at + 4096] ^ _XOR) * _ODD).min(axis=1))
    mixed = np.arange(BANDS, dtype=np.uint64)
    for k in range(DEPTH):
        mixed = remix(mixed ^ least[k::DEPTH], k + 1)
    return mixed.view(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, s0, s1, place, w0, bands) per row of (doc_id, text): s0 and s1 are a digest of the shingle set, w0 its SimHash, place the segment counts of that."""
    names = ["s0", "s1", "place", "w0"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for data in utf8_list(batch.column(1)):
                own = shingle_set(data, words)
                digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), dtype=np.int64).tolist()
                word = np.array(majority([own], 1), dtype=np.int64).view(np.uint64)
                rows.append([*digest, int(_counts(word).view(np.int64)[0]), int(word.view(np.int64)[0])])
                found.append(bands(own))
            numbers = np.array(rows, dtype=np.int64).reshape(-1, len(names))
            columns = [pa.array(numbers[:, k]) for k in range(len(names))] + [pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names, "bands"])

    longs = ", ".join(f"{n} long" for n in names)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {longs}, bands array<long>")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose band another row has too; rows come sorted by band."""
    kept: pa.RecordBatch | None = None
    shared = False  # whether the band of the kept row was met before it
    for batch in batches:
        rows = batch if kept is None else pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        band = rows.column(0).to_numpy()
        same = band[1:] == band[:-1]
        several = np.concatenate([[shared], same]) | np.concatenate([same, [False]])
        shared = bool(several[-1])
        yield rows.filter(pa.array(np.concatenate([several[:-1], [False]])))
        kept = rows.slice(len(band) - 1)
    if kept is not None and shared:
        yield kept


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of a node with the one before it in its band; rows (band, node) come sorted by band."""
    band, before = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        bands_, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        fresh = np.concatenate([[band is None or bands_[0] != band], bands_[1:] != bands_[:-1]])
        previous = np.concatenate([[before], nodes[:-1]])
        yield pa.RecordBatch.from_arrays([pa.array(nodes[~fresh]), pa.array(previous[~fresh])], ["a", "b"])
        band, before = bands_[-1], nodes[-1]


def _centres(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of every node with the most central one of each of its bands: the one whose own bands hold most rows."""
    full = met.join(met.groupBy("band").agg(F.count("*").alias("n")), "band")
    weights = full.groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = met.select("band", "node").join(weights, "node")
    centres = weighed.groupBy("band").agg(F.max(F.struct("weight", "node")).alias("best"))
    return met.select("band", F.col("node").alias("a")).join(centres, "band").select("a", F.col("best.node").alias("b")).where("a <> b").distinct()


HEAD = 6  # first rare shingles of a node that its rows carry, to tell pairs that met before


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of different roots that share a shingle and a band and whose sizes and ranks allow the similarity.

    Rows (shingle, node, root, size, rank, bands, head) come sorted by shingle; a row is compared with those before it, in
    blocks, so the rows of a shingle are in memory and not the pairs. Where the heads show that a pair meets at an earlier
    shingle, it is left to that one.
    """
    width = 1 << 17
    kept: pa.Table | None = None

    def complete(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        shingle, node, root, size, rank = (rows.column(k).to_numpy() for k in range(5))
        bands_, head = (rows.column(k).combine_chunks() for k in (5, 6))
        bands_, head = (x.flatten().to_numpy().reshape(len(node), -1) for x in (bands_, head))
        at = np.arange(len(node))
        begin = np.maximum.accumulate(np.where(np.concatenate([[True], shingle[1:] != shingle[:-1]]), at, 0))
        until = np.cumsum(at - begin)
        done = 0
        while done < len(node):
            base = until[done - 1] if done else 0
            stop = max(int(np.searchsorted(until, base + width, side="right")), done + 1)
            n = (at - begin)[done:stop]
            right = np.repeat(at[done:stop], n)
            left = np.arange(len(right)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[done:stop], n)
            less, more = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
            good = (root[left] != root[right]) & (less * SIMILAR[1] >= more * SIMILAR[0])
            # At the first shingle a pair shares, so many can follow in both; the similarity needs a share of both sizes.
            room = 1 + np.minimum(size[left] - rank[left], size[right] - rank[right])
            good &= sum(SIMILAR) * room >= SIMILAR[0] * (size[left] + size[right])
            left, right = left[good], right[good]
            good = (bands_[left] == bands_[right]).any(axis=1)
            left, right = left[good], right[good]
            same = np.zeros(len(left), dtype=bool)
            for i in range(HEAD):
                for j in range(HEAD):
                    same |= (head[left, i] == head[right, j]) & (rank[left] > i + 1) & (rank[right] > j + 1) & (head[left, i] != 0)
            left, right = left[~same], right[~same]
            yield pa.RecordBatch.from_arrays([pa.array(node[right]), pa.array(node[left])], ["a", "b"])
            done = stop

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if kept is not None:
            rows = pa.concat_tables([kept, rows])
        if not rows.num_rows:
            continue
        own = rows.column(0).to_numpy()
        last = int(np.searchsorted(own, own[-1]))
        if last:
            yield from complete(rows.slice(0, last))
        kept = rows.slice(last)
    if kept is not None and kept.num_rows:
        yield from complete(kept)


def _verified(pairs: DataFrame, sets: DataFrame, purpose: str) -> DataFrame:
    """The pairs whose sets (node, shingles) are similar. A set that many pairs name is dealt out in copies, one per HUB pairs."""
    pairs = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = in_files(pairs.distinct(), sets.count(), f"{purpose}-pairs", FILE_DOCUMENTS)
    chunks = pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB).cast("int").alias("chunks"))
    hubs = chunks.join(sets, chunks.b == sets.node).select("b", "chunks", F.col("shingles").alias("other"))
    hubs = hubs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = pairs.join(chunks, "b").select("a", "b", F.pmod(F.hash("a"), F.col("chunks")).alias("chunk"))
    own = dealt.join(sets, dealt.a == sets.node).select("a", "b", "chunk", "shingles")
    both = own.join(hubs, ["b", "chunk"]).select("a", "b", "shingles", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = ([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column(k)] for k in (2, 3))
            good = pa.array([similar(x, y) for x, y in zip(own, other)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return in_files(both.mapInArrow(run, "a long, b long"), pairs.count(), f"{purpose}-links", FILE_PAIRS)


def _rarest(sets: DataFrame, nodes: DataFrame, bands_of: DataFrame) -> DataFrame:
    """(shingle, node, root, size, rank, bands, head): of every node (node, root) the rarest fifth of its shingles and one more, if another node has them.

    The counts are over these nodes; any common order would do, this one lets few nodes meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, root, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = np.frombuffer(data.as_buffer(), dtype=np.int64)
                for at in range(0, len(own), STEP):
                    part = own[at : at + STEP]
                    fixed = [pa.array(np.full(len(part), x)) for x in (node, root, len(own))]
                    yield pa.RecordBatch.from_arrays([pa.array(part), *fixed], ["shingle", "node", "root", "size"])

    chosen = nodes.join(sets, "node").select("node", "root", "shingles")
    many = nodes.count()
    rows = in_files(chosen.mapInArrow(run, "shingle long, node long, root long, size long"), many, "crowded-shingles", FILE_PAIRS)
    several = rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    counted = rows.join(several, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("n", "shingle"))
    few = counted.withColumn("rank", rank).where(F.col("rank") <= F.col("size") - F.ceil(F.col("size") * SIMILAR[0] / SIMILAR[1]) + 1)
    shared = in_files(few.where("n > 1").select("shingle", "node", "root", "size", "rank"), many, "rare-shingles", FILE_PAIRS)
    # The heads hold a node's first shared shingles by rank; a shingle number of zero stands for none.
    first = [F.max(F.when(F.col("rank") == k + 1, F.col("shingle"))) for k in range(HEAD)]
    heads = shared.where(F.col("rank") <= HEAD).groupBy("node").agg(F.array(*(F.coalesce(x, F.lit(0)) for x in first)).alias("head"))
    empty = F.array(*[F.lit(0).cast("long")] * HEAD)
    whole = shared.join(bands_of, "node").join(heads, "node", "left").withColumn("head", F.coalesce("head", empty))
    return whole.select("shingle", "node", "root", "size", F.col("rank").cast("long").alias("rank"), "bands", "head")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) that `roots` (node, root) does not connect already."""
    rooted = pairs
    for name in ("a", "b"):
        own = roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
        rooted = rooted.join(own, name, "left").withColumn(f"root_{name}", F.coalesce(f"root_{name}", name))
    return rooted.where("root_a <> root_b").select("a", "b")


def similar_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, component_id) per row of (doc_id, text): the smallest id reachable over similar pairs that the grid finds or that share a band."""
    spark = docs.sparkSession
    prints = stored(sketches(docs, words), "sketches")
    many = prints.count()
    classes = prints.groupBy("s0", "s1").agg(F.min("doc_id").alias("first"), F.min(F.struct("place", "w0", "bands")).alias("one"))
    classes = classes.select("s0", "s1", "first", "one.place", "one.w0", "one.bands", F.monotonically_increasing_id().alias("node"))
    classes = in_files(classes, many, "shingle-classes", FILE_DOCUMENTS)
    grid = in_files(near_links(classes.select("node", "w0"), 1), many, "grid-links", FILE_DOCUMENTS)
    rows = classes.select(F.explode("bands").alias("band"), "node", "place")
    rows = rows.repartition(partitions(spark), "band").sortWithinPartitions("band", "place", "node")
    met = in_files(rows.mapInArrow(_met, "band long, node long, place long"), many, "bands-met", FILE_DOCUMENTS)

    nodes = met.select("node").union(grid.select("a")).union(grid.select("b"))
    wanted = nodes.distinct().join(classes.select("node", "first"), "node")
    found = docs.select(F.col("doc_id").alias("name"), "text").join(
        wanted, F.col("name.id").eqNullSafe(F.col("first.id")) & (F.col("name.key") == F.col("first.key"))
    )

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(x, words).tobytes() for x in utf8_list(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "shingles"])

    once = found.select("node", "text").dropDuplicates(["node"])
    sets = in_files(once.mapInArrow(as_sets, "node long, shingles binary"), many, "met-sets", FILE_DOCUMENTS)
    close = _verified(grid, sets, "grid")
    grid_roots = in_files(component_roots(close), many, "grid-roots")
    dealt = met.repartition(partitions(spark), "band").sortWithinPartitions("band", "place", "node")
    stars_of = dealt.select("band", "node").mapInArrow(_neighbours, "a long, b long").unionByName(_centres(met))
    links = close.union(_verified(_apart(stars_of, grid_roots), sets, "star"))
    roots = in_files(component_roots(links), many, "star-roots")
    rooted = met.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    # In a band of two, or of one component, nothing is left to compare.
    open_bands = rooted.groupBy("band").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    open_bands = open_bands.where("n > 2 and low <> high").select("band")
    crowded = in_files(rooted.join(open_bands, "band").select("node", "root").distinct(), many, "crowded-nodes")
    sharing = _rarest(sets, crowded, classes.select("node", "bands")).repartition(partitions(spark), "shingle").sortWithinPartitions("shingle")
    more = _verified(sharing.mapInArrow(_sharing, "a long, b long"), sets, "rest")
    roots = component_roots(links.union(more))
    rooted = in_files(classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), many, "rooted")
    smallest = in_files(rooted.groupBy("root").agg(F.min("first").alias("component_id")), many, "component-ids")
    labelled = in_files(rooted.join(smallest, "root").select("s0", "s1", "component_id"), many, "labelled")
    return prints.join(labelled, ["s0", "s1"]).select("doc_id", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of `docs`, of each component only the one with the smallest id (null first), then the smallest text hash.

    Rows that repeat both id and text are one document here: they stay or go together.
    """
    key = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    named = docs.select(F.struct(F.col(f"`{doc_id}`").alias("id"), key.alias("key")).alias("name"), F.col(f"`{text}`").alias("text"))
    found = similar_components(id_and_text(named, "name", "text"), words)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id.id").alias("__id"), F.col("doc_id.key").alias("__key"))
    gone = in_files(gone.distinct(), docs.count(), "near-copies")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    return docs.join(gone, same, "left_anti")
