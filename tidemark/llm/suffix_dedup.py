"""Removal of byte strings that repeat earlier documents, by bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of `length` bytes that covers it also starts in a document with a
smaller id. The text of the whole corpus is never sorted in one place:

1. Of rows with equal texts only the smallest id goes on; the others are removed whole.
2. Documents are dealt to blocks of bounded size, stored once as a bucketed table.
3. Every window of `length` bytes names an anchor, its 16-gram with the smallest hash; equal
   windows name equal anchors. Blocks send their distinct anchor hashes to hash buckets
   and learn which of them other blocks have too.
4. For those, the blocks send the stretch of text whose windows name the anchor, each
   distinct stretch once with the smallest id, to the anchor's bucket.
5. A bucket concatenates its stretches, builds the transform and expands intervals
   breadth-first by backward extension. Extension number n fixes the boundaries where n
   characters are common; it stops at `length`, and what is not bounded by then are the
   windows that are equal. Windows with a smaller id in their group are reported back.
6. The blocks cut the reported windows and hash what remains.

A block takes part in a bucket with each distinct anchor once, so neither a passage in all
documents nor thousands of copies make a hot group. Nothing reaches the driver but totals.

Defined results: a null text is empty and has nothing to remove; null ids count as smaller than all
others; rows with equal ids never remove each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, partitions, stored
from tidemark.session import shared_folder

LENGTH = 50
GRAM = 16
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
PIECE = 1 << 20
SEPARATOR = 0xFF  # in no UTF-8 text
LOWEST = -(2**63)


# -- anchors -----------------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes from every position on."""
    raw = np.ascontiguousarray(data)
    low = np.ndarray(len(raw) - 15, dtype="<u8", buffer=raw, strides=(1,))
    high = np.ndarray(len(raw) - 15, dtype="<u8", buffer=raw, offset=8, strides=(1,))
    x = low * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += high
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, position, hash) of every anchor; windows that name it are neighbours."""
    span = length - GRAM + 1
    parts = []
    for at in range(0, len(data) - length + 1, PIECE):
        windows = min(PIECE, len(data) - length + 1 - at)
        hashes = gram_hashes(data[at : at + windows + length - 1])
        best, place, width = hashes, np.arange(len(hashes), dtype=np.int32), 1
        while width < span:
            step = min(width, span - width)
            left, right = best[: len(best) - step], best[step:]
            worse = right < left  # the leftmost of equal hashes stays
            best = np.where(worse, right, left)
            place = np.where(worse, place[step:], place[: len(place) - step])
            width += step
        change = np.flatnonzero(np.diff(place[:windows])) + 1
        first = np.concatenate([[0], change])
        last = np.concatenate([change, [windows]]) - 1
        position = place[first].astype(np.int64)
        # The smallest hash of a window is a small number; mixed again, buckets get even shares.
        mixed = hashes[position] * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        parts.append((first + at, last + at, position + at, mixed))
    if not parts:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, empty.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*parts))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by the high bits, evenly for any number of buckets below 2 ** 31."""
    return ((hashes >> np.uint64(33)) * np.uint64(buckets) >> np.uint64(31)).astype(np.int64)


# -- the transform -----------------------------------------------------------------


def rotations(text: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of `text` in order of their first `depth` bytes at least, by doubling ranks."""
    n = len(text)
    around = np.concatenate([text, np.resize(text, 8)])
    word = np.ndarray(n, dtype=">u8", buffer=around, strides=(1,)).astype(np.uint64)
    done = 8
    while True:
        order = np.argsort(word)  # the order of equal rotations does not matter
        ranked = word[order]
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])]).astype(np.uint64)
        if done >= depth:
            return order
        word = (rank << np.uint64(32)) | np.roll(rank, -done)
        done *= 2


def window_groups(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The rotations in order, and True where one begins that shares fewer than `length` bytes with the one before."""
    n = len(text)
    order = rotations(text, length)
    last = text[order - 1]  # the transform: the byte before each rotation
    by_byte = np.argsort(last, kind="stable")
    step = np.empty(n, dtype=np.int64)  # where a rotation goes when its byte before is put in front
    step[by_byte] = np.arange(n)
    same = last[by_byte[1:]] == last[by_byte[:-1]]
    following = np.full(n, n, dtype=np.int64)  # next and previous place of the same byte
    following[by_byte[:-1][same]] = by_byte[1:][same]
    previous = np.full(n, -1, dtype=np.int64)
    previous[by_byte[1:][same]] = by_byte[:-1][same]
    bound = np.zeros(n + 1, dtype=bool)
    bound[0] = bound[n] = True
    begin, end = np.array([0]), np.array([n])
    for _ in range(length):
        sizes = end - begin
        total = int(sizes.sum())
        if not total:
            break
        inside = np.arange(total) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        firsts = inside[previous[inside] < np.repeat(begin, sizes)]
        lasts = inside[following[inside] >= np.repeat(end, sizes)]
        new_begin, new_end = np.sort(step[firsts]), np.sort(step[lasts]) + 1
        fresh = ~bound[new_end]
        begin, end = new_begin[fresh], new_end[fresh]
        bound[end] = True
    return order, bound[:n]


def earlier_windows(pieces: list[bytes], keys: np.ndarray, length: int) -> list[np.ndarray]:
    """For every piece the windows (starts) that a piece with a smaller key has too."""
    text = np.frombuffer(b"\xff".join([*pieces, b""]), dtype=np.uint8)
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    valid = np.arange(len(text)) - starts[owner] <= sizes[owner] - length
    order, begins = window_groups(text, length)
    own = np.where(valid, keys[owner], np.iinfo(np.int64).max)[order]
    least = np.minimum.reduceat(own, np.flatnonzero(begins))
    earlier = np.empty(len(text), dtype=bool)
    earlier[order] = least[np.cumsum(begins) - 1] < own
    earlier &= valid
    hits = np.flatnonzero(earlier)
    cuts = np.searchsorted(hits, starts[1:])
    return [h - s for h, s in zip(np.split(hits, cuts), starts.tolist())]


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    breaks = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [len(starts) - 1]])]


# -- what blocks and buckets do ----------------------------------------------------


class Block:
    """The documents of one block, each distinct (key, text) once, in a fixed order."""

    def __init__(self, table: pa.Table, length: int):
        seen = {}
        for key, digest, text in zip(table["key"].to_pylist(), table["digest"].to_pylist(), table["text"].cast(pa.binary())):
            seen[(key, digest)] = text.as_py()
        self.rows = sorted(seen)
        self.texts = [seen[r] for r in self.rows]
        found = [anchors(np.frombuffer(t, dtype=np.uint8), length) for t in self.texts]
        self.row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 4
        self.first, self.last, self.position, self.hash = columns


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


ANCHORS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary())])
SHARED = pa.schema([("block", pa.int64()), ("hashes", pa.binary())])
PIECES = pa.schema([("bucket", pa.int64()), ("block", pa.int64())] + [(n, pa.binary()) for n in ("keys", "rows", "starts", "sizes", "places", "text")])
CUTS = pa.schema([("block", pa.int64())] + [(n, pa.binary()) for n in ("rows", "starts", "ends")])
RESULTS = pa.schema([("digest", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def send_anchors(table: pa.Table, block: int, length: int, buckets: int) -> pa.Table:
    hashes = np.unique(Block(table, length).hash)
    to = bucket_of(hashes, buckets)  # ascends with the hash
    cuts = np.flatnonzero(np.diff(to)) + 1
    parts = np.split(hashes, cuts) if len(hashes) else []
    return _table([(int(bucket_of(p[:1], buckets)[0]), block, p.tobytes()) for p in parts], ANCHORS)


def find_shared(table: pa.Table) -> pa.Table:
    """The hashes of a bucket that several blocks sent, per block."""
    parts = [np.frombuffer(x, dtype=np.uint64) for x in table["hashes"].to_pylist()]
    hashes = np.concatenate(parts)
    sender = np.repeat(np.array(table["block"].to_pylist(), dtype=np.int64), [len(p) for p in parts])
    order = np.argsort(hashes, kind="stable")
    hashes, sender = hashes[order], sender[order]
    equal = hashes[1:] == hashes[:-1]
    several = np.concatenate([equal, [False]]) | np.concatenate([[False], equal])
    hashes, sender = hashes[several], sender[several]
    order = np.argsort(sender, kind="stable")
    hashes, sender = hashes[order], sender[order]
    cuts = np.flatnonzero(np.diff(sender)) + 1
    groups = zip(np.split(sender, cuts), np.split(hashes, cuts)) if len(sender) else []
    return _table([(int(s[0]), h.tobytes()) for s, h in groups], SHARED)


def _ints(values, kind: str) -> bytes:
    return np.array(values, dtype=kind).tobytes()


def send_pieces(table: pa.Table, shared: pa.Table, block: int, length: int, buckets: int) -> tuple[list[tuple], list[tuple]]:
    """Rows of PIECES for the buckets, and rows of CUTS for what the block itself knows to be repeated."""
    own = Block(table, length)
    known = [np.frombuffer(x, dtype=np.uint64) for x in shared["hashes"].to_pylist()]
    _, inverse, count = np.unique(own.hash, return_inverse=True, return_counts=True)
    wanted = np.flatnonzero(np.isin(own.hash, np.concatenate(known) if known else []) | (count[inverse] > 1))
    keys = [k for k, _ in own.rows]
    to = bucket_of(own.hash[wanted], buckets).tolist()
    first, last, row = own.first[wanted].tolist(), own.last[wanted].tolist(), own.row[wanted].tolist()
    place = (own.position - own.first)[wanted].tolist()
    seen: dict[bytes, int] = {}
    out: dict[int, list] = {}
    cut_rows, cut_starts, cut_ends = [], [], []
    # Rows ascend by key, so the first to bring a stretch has the smallest id of the block.
    for b, a, z, r, p in zip(to, first, last, row, place):
        text = own.texts[r][a : z + length]
        key = keys[r]
        if seen.setdefault(text, key) < key:
            cut_rows.append(r)
            cut_starts.append(a)
            cut_ends.append(z + length)
        else:
            out.setdefault(b, []).append((key, r, a, len(text), p, text))
    pieces = []
    for b, found in out.items():
        k, r, a, n, p, t = zip(*found)
        pieces.append((b, block, _ints(k, "<i8"), _ints(r, "<i4"), _ints(a, "<i8"), _ints(n, "<i4"), _ints(p, "<i4"), b"".join(t)))
    cuts = [(block, _ints(cut_rows, "<i4"), _ints(cut_starts, "<i8"), _ints(cut_ends, "<i8"))] if cut_rows else []
    return pieces, cuts


def near_alike(texts: list[bytes], places: list[int], numbers: list[int], length: int) -> list[int]:
    """Those of `numbers` that could share a window with another.

    A shared window has `length` - GRAM more bytes around the anchor in common, some on the left and the rest on the
    right. However they fall, one of the four cuts below is common whole.
    """
    more = length - GRAM
    low, mid, high = more // 4 + 1, more // 2, more - more // 4
    cuts = [(0, high), (low, mid), (mid, low), (high, 0)]
    out: set[int] = set()
    for left, right in cuts:
        first: dict[bytes, int] = {}
        for k in numbers:
            at, text = places[k], texts[k]
            if at >= left and len(text) - at - GRAM >= right:
                other = first.setdefault(text[at - left : at + GRAM + right], k)
                if other != k:
                    out.add(k)
                    out.add(other)
    return sorted(out)


def find_repeats(table: pa.Table, length: int) -> pa.Table:
    """Rows of CUTS for the stretches of a bucket whose windows start in a document with a smaller id."""
    blocks, keys, rows, starts, sizes = [], [], [], [], []
    numbers: dict[bytes, int] = {}
    which: list[int] = []
    by_anchor: dict[bytes, list[int]] = {}
    places: list[int] = []
    for block, k, r, a, n, p, text in zip(*(table[c].to_pylist() for c in ("block", *PIECES.names[2:]))):
        n = np.frombuffer(n, dtype="<i4")
        blocks.append(np.full(len(n), block))
        keys.append(np.frombuffer(k, dtype="<i8"))
        rows.append(np.frombuffer(r, dtype="<i4"))
        starts.append(np.frombuffer(a, dtype="<i8"))
        sizes.append(n)
        at = 0
        for size, place in zip(n.tolist(), np.frombuffer(p, dtype="<i4").tolist()):
            number = numbers.setdefault(text[at : at + size], len(numbers))
            which.append(number)
            if number == len(places):
                places.append(place)
                by_anchor.setdefault(text[at + place : at + place + GRAM], []).append(number)
            at += size
    block, key, row, start, size = (np.concatenate(x) for x in (blocks, keys, rows, starts, sizes))
    which = np.array(which)
    texts = list(numbers)
    least = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(least, which, key)
    later = key > least[which]
    out_piece = [np.flatnonzero(later)]
    out_start = [np.zeros(int(later.sum()), dtype=np.int64)]
    out_end = [size[later].astype(np.int64)]
    # Distinct stretches with the same anchor can share some of their windows; one that is alone with its anchor cannot.
    several = sorted(k for g in by_anchor.values() if len(g) > 1 for k in g)
    compare = np.array(near_alike(texts, places, several, length), dtype=np.int64)
    if len(compare):
        hits = earlier_windows([texts[k] for k in compare], least[compare], length)
        some = [i for i, h in enumerate(hits) if len(h)]
        place = np.full(len(texts), -1)
        place[compare[some]] = np.arange(len(some))
        found = [runs(hits[i]) for i in some]
        for j in np.flatnonzero((place[which] >= 0) & ~later).tolist():
            low, high = found[place[which[j]]]
            out_piece.append(np.full(len(low), j))
            out_start.append(low)
            out_end.append(high + length)
    piece = np.concatenate(out_piece)
    begin = np.concatenate(out_start) + start[piece]
    end = np.concatenate(out_end) + start[piece]
    order = np.argsort(block[piece], kind="stable")
    piece, begin, end = piece[order], begin[order], end[order]
    to = block[piece]
    marks = np.flatnonzero(np.diff(to)) + 1
    groups = zip(*(np.split(x, marks) for x in (to, row[piece], begin, end))) if len(to) else []
    return _table([(int(t[0]), _ints(r, "<i4"), _ints(b, "<i8"), _ints(e, "<i8")) for t, r, b, e in groups], CUTS)


def cut_text(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, str]:
    """Bytes and runs removed by the union of [start, end), and the SHA-256 of the rest."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate([[True], starts[1:] > ends[:-1]])
    begin = starts[fresh]
    end = ends[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(ends) - 1]])]
    digest, at = hashlib.sha256(), 0
    for b, e in zip(begin.tolist(), end.tolist()):
        digest.update(text[at:b])
        at = e
    digest.update(text[at:])
    return int((end - begin).sum()), len(begin), digest.hexdigest()


def apply_cuts(table: pa.Table, cuts: pa.Table, length: int) -> pa.Table:
    rows: dict[tuple, bytes] = {}
    for key, digest, text in zip(table["key"].to_pylist(), table["digest"].to_pylist(), table["text"].cast(pa.binary())):
        rows[(key, digest)] = text.as_py()
    names = sorted(rows)
    row, start, end = (
        np.concatenate([np.frombuffer(x, dtype=t) for x in cuts[c].to_pylist()] or [np.empty(0, t)])
        for c, t in (("rows", "<i4"), ("starts", "<i8"), ("ends", "<i8"))
    )
    order = np.argsort(row, kind="stable")
    row, start, end = row[order], start[order], end[order]
    bounds = np.searchsorted(row, np.arange(len(names) + 1)).tolist()
    out = []
    for k, name in enumerate(names):
        a, z = bounds[k], bounds[k + 1]
        if z > a:
            out.append((name[1], *cut_text(rows[name], start[a:z], end[a:z])))
    return _table(out, RESULTS)


# -- the job -----------------------------------------------------------------------


def _blocks(keyed: DataFrame, owners: DataFrame, blocks: int, buckets: int) -> DataFrame:
    """Each owner's text, as a table bucketed by block: later steps read it without moving text again."""
    spark = keyed.sparkSession
    block = F.pmod(F.xxhash64("key", "digest"), F.lit(blocks)).alias("block")
    texts = keyed.select("key", "digest", "text", block).repartition(buckets, "block")
    chosen = owners.select(F.col("first").alias("key"), "digest", F.pmod(F.xxhash64("first", "digest"), F.lit(blocks)).alias("block"))
    kept = texts.join(chosen.repartition(buckets, "block").hint("shuffle_hash"), ["block", "key", "digest"], "left_semi")
    path = shared_folder(spark, "text-blocks")
    name = "text_blocks_" + path.rsplit("-", 1)[-1]
    kept.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    rows = id_and_text(docs, doc_id, text)
    spark = rows.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    keyed = rows.select("doc_id", key.alias("key"), F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("digest"), "text")
    counted = keyed.groupBy("digest", "key").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("doc_id"), F.max(F.octet_length("text")).cast("long").alias("n_bytes")
    )
    counted = stored(counted, "text-counts")
    owners = stored(counted.groupBy("digest").agg(F.min("key").alias("first"), F.max("n_bytes").alias("n_bytes")), "text-owners")
    long_enough = owners.where(F.col("n_bytes") >= length)
    total = long_enough.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    files = partitions(spark)
    blocks = max(files, -(-total // BLOCK_BYTES))
    buckets = max(files, -(-total // BUCKET_BYTES))
    texts = _blocks(keyed, long_enough, blocks, files)

    sent = texts.groupBy("block").applyInArrow(
        lambda k, t: send_anchors(t, k[0].as_py(), length, buckets), _ddl(ANCHORS)
    )
    shared = stored(sent.groupBy("bucket").applyInArrow(find_shared, _ddl(SHARED)), "shared-anchors")

    def pieces(k, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([], both)
        block = left["block"][0].as_py()
        found, cuts = send_pieces(left, right, block, length, buckets)
        return _table([(*x, None) for x in found] + [(None, b, None, r, s, None, None, None, e) for b, r, s, e in cuts], both)

    both = PIECES.append(pa.field("ends", pa.binary()))
    mixed = stored(texts.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(pieces, _ddl(both)), "text-pieces")
    found = mixed.where("bucket is not null").drop("ends").groupBy("bucket").applyInArrow(
        lambda t: find_repeats(t, length), _ddl(CUTS)
    )
    cuts = stored(found.union(mixed.where("bucket is null").select("block", "rows", "starts", "ends")), "text-cuts")
    results = texts.groupBy("block").cogroup(cuts.groupBy("block")).applyInArrow(
        lambda left, right: apply_cuts(left, right, length), _ddl(RESULTS)
    )
    known = stored(owners.select("digest", "first").join(results, "digest", "left"), "text-results")
    copy = (F.col("key") > F.col("first")) & (F.col("n_bytes") >= length)
    out = counted.join(known, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest"))))
        .alias("kept_sha256"),
    )
