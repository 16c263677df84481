"""Packing token sequences by minimum bin slack.

Documents become token pieces of at most `capacity` ids. How many pieces there are of
each length is all the planner needs, at most `capacity` numbers whatever the size of
the corpus. It takes the longest length left, finds by subset-sum dynamic programming
over a bitset which other lengths fill the rest of the sequence best, and removes that
combination as often as the counts allow. The plan gives, for every length, ranges of
ranks and the sequence and place they go to.

A piece's rank among those of its length is its number in its task plus the counts of
the tasks before, so no length, however common, meets in one task. The pieces with their
task and number are written first; a lost executor cannot change them. On the way to fewer
files the pieces of a task stay together, so they all come from one run of it.

Defined results: a null or empty text is a piece of one end id; repeated rows and equal or
null ids are packed row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, in_files

CAPACITY = 2048
END_ID = 0
# Texts of these characters alone are split alike by both tokenizer libraries, whatever
# their Unicode versions; texts with others take the slower library.
SETTLED = re.compile("[^\x00-ӿ‐-‧€ぁ-ゖァ-ヺ一-龥가-힣]")


@lru_cache(maxsize=4)
def text_encoder(json_path: str, ranks_path: str | None, pattern: str | None) -> Callable[[str], list[int]]:
    """Ids as the tokenizer file gives them. With the same vocabulary as ranks, a faster library encodes what it surely encodes alike."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if not ranks_path:
        return slow
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(text: str) -> list[int]:
        if SETTLED.search(text) or any(s in text for s in special):
            return slow(text)
        return fast(text)

    return encode


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `total` ids; only the first may be shorter than `capacity`."""
    first = total % capacity or min(total, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def token_pieces(docs: DataFrame, encoder: tuple, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, number): `number` counts the pieces of a length in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(*encoder)
        task = TaskContext.get().partitionId()
        count = [0] * (capacity + 1)
        for batch in batches:
            rows, piece, start, length, crc, number = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py())
                ids.append(end_id)
                octets = memoryview(np.array(ids, dtype="<u4").tobytes())
                for k, (at, n) in enumerate(cut(len(ids), capacity)):
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(octets[4 * at : 4 * (at + n)]))
                    number.append(count[n])
                    count[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    pa.array([task] * len(rows), pa.int32()),
                    pa.array(number, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, task int, number long"
    )


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, times) with the largest sum of at most `room`, no length more often than it is left."""
    sums, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, power = min(counts[length], room // length), 1
        while left:
            times = min(power, left)
            steps.append((length, times, sums))
            sums |= (sums << (length * times)) & mask
            left -= times
            power *= 2
        if sums >> room & 1:
            break
    best, chosen = sums.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] = chosen.get(length, 0) + times
            best -= length * times
    return list(chosen.items())


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, first rank, first sequence, offset): ranks from there on go to sequences from there on, at that offset."""
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    out, sequence = [], 0
    while left:
        longest = max(left)
        others = {n: c - (n == longest) for n, c in left.items()}
        chosen = {longest: 1}
        for n, times in fullest({n: c for n, c in others.items() if c}, capacity - longest):
            chosen[n] = chosen.get(n, 0) + times
        again = min(left[n] // times for n, times in chosen.items())
        offset = 0
        for n, times in sorted(chosen.items(), reverse=True):
            for _ in range(times):
                out.append((n, used[n], sequence, offset))
                used[n] += again
                offset += n
            left[n] -= times * again
            if not left[n]:
                del left[n]
        sequence += again
    return out


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored rows of `token_pieces`."""
    counts = in_files(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), pieces.count(), "length-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = np.array(sorted(plan(histogram, capacity)) or np.empty((0, 4)), dtype=np.int64).reshape(-1, 4)
    keys = (steps[:, 0] << 44) + steps[:, 1]
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    ranked = pieces.join(ahead, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("ahead") + F.col("number")).alias("rank")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            sequence = steps[at, 2] + rank - steps[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), pa.array(sequence), pa.array(steps[at, 3])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    id_type = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack(
    docs: DataFrame,
    encoder: tuple,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece of every row of `docs`: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    `encoder` names the tokenizer files, which every executor must have: (file for `tokenizers`, ranks or None, pattern).
    """
    pieces = token_pieces(id_and_text(docs, doc_id, text), encoder, capacity, end_id).repartition("task")
    return place(in_files(pieces, docs.count(), "token-pieces"), capacity)
