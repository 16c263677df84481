"""Byte-level BPE encoding and decoding with a two-tier lookup.

Texts are split by the vocabulary's pattern. The distinct pre-tokens of a batch are first
looked up whole in a minimal perfect hash over the vocabulary (one displacement per bucket,
as many slots as tokens, the token compared); those it does not hold are merged by a heap of
pair ranks over a linked list of their bytes. A bounded memo spares repeating that.

The vocabulary is a file of fixed size; its hash is built once on the driver and broadcast.

Defined results: a null text is empty and has no ids; texts of any length are encoded whole;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm.common import id_and_text

MEMO_ENTRIES = 400_000
# Letters, digits and white space among these are the same in every Unicode version in use.
SETTLED = re.compile("[^\x00-ӿ‐-‧€ぁ-ゖァ-ヺ一-龥가-힣]")


def spot(hashes: np.ndarray, shift: np.ndarray, size: int) -> np.ndarray:
    """The slot a hash goes to under a displacement."""
    x = (hashes ^ (shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


@dataclass
class Vocabulary:
    """Tokens in slot order of their minimal perfect hash."""

    pattern: str
    tokens: list[bytes]
    ids: np.ndarray
    shift: np.ndarray

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        shift = self.shift[(hashes % np.uint64(len(self.shift))).astype(np.int64)]
        return np.where(shift < 0, -shift - 1, spot(hashes, np.maximum(shift, 0), len(self.tokens)))

    def find(self, words: list[bytes]) -> list[int]:
        """Ids of whole words, -1 where the vocabulary lacks the word."""
        if not words or not self.tokens:
            return [-1] * len(words)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
        at = self.slots(hashes)
        ids = self.ids[at].tolist()
        return [i if self.tokens[s] == w else -1 for w, s, i in zip(words, at.tolist(), ids)]


def perfect_hash(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
    """Place every token in a slot of its own: large buckets first, buckets of one straight into free slots."""
    tokens = list(ranks)
    size, buckets = len(tokens), max(1, len(tokens) // 4)
    hashes = np.array([xxhash.xxh64_intdigest(t) for t in tokens], dtype=np.uint64)
    if len(np.unique(hashes)) < size:
        raise ValueError("two tokens share a hash")
    groups: list[list[int]] = [[] for _ in range(buckets)]
    for k, b in enumerate((hashes % np.uint64(buckets)).tolist()):
        groups[b].append(k)
    free, shift = np.ones(size, dtype=bool), np.zeros(buckets, dtype=np.int64)
    slot_of = np.zeros(size, dtype=np.int64)
    block = np.arange(64, dtype=np.int64)
    singles = []
    for b in sorted(range(buckets), key=lambda b: -len(groups[b])):
        own = groups[b]
        if len(own) < 2:
            singles += [(b, k) for k in own]
            continue
        base = 0
        while True:
            tries = spot(hashes[own][:, None], (base + block)[None, :], size)
            fits = free[tries].all(axis=0)
            for j in np.flatnonzero(fits):
                if len(np.unique(tries[:, j])) == len(own):
                    break
            else:
                base += len(block)
                continue
            shift[b] = base + j
            slot_of[own] = tries[:, j]
            free[tries[:, j]] = False
            break
    for (b, k), slot in zip(singles, np.flatnonzero(free).tolist()):
        shift[b], slot_of[k] = -slot - 1, slot
    placed = [b""] * size
    ids = np.zeros(size, dtype=np.int64)
    for k, token in enumerate(tokens):
        placed[slot_of[k]] = token
        ids[slot_of[k]] = ranks[token]
    return Vocabulary(pattern, placed, ids, shift)


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """A rank file: a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return perfect_hash({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word by repeated merging of the lowest-ranked, leftmost pair; a heap over linked parts."""
    size = len(word)
    end = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * size
    while heap:
        _, at, to = heapq.heappop(heap)
        # A part starts where it always did; an entry is stale when a part in it has grown or gone.
        if not alive[at] or end[at] >= to or end[end[at]] != to:
            continue
        gone = end[at]
        alive[gone] = False
        end[at] = to
        if to < size:
            before[to] = at
            if (r := ranks.get(word[at : end[to]])) is not None:
                heapq.heappush(heap, (r, at, end[to]))
        left = before[at]
        if left >= 0 and (r := ranks.get(word[left:to])) is not None:
            heapq.heappush(heap, (r, left, to))
    out, at = [], 0
    while at < size:
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


def _class(text: str) -> str:
    """A character class of the characters of `text`, as ranges."""
    codes = np.unique(np.array([ord(c) for c in text], dtype=np.int64))
    first = codes[np.concatenate([[True], np.diff(codes) > 1])]
    last = codes[np.concatenate([np.diff(codes) > 1, [True]])]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first.tolist(), last.tolist()))


def library_pattern(pattern: str) -> str:
    """`pattern` with the letters, digits and white space of the tokenizer library's own Unicode version."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    octets = {bytes([b]): b for b in range(256)}

    def members(kind: str) -> str:
        probe = tiktoken.Encoding("probe", pat_str=kind + "+", mergeable_ranks=octets, special_tokens={})
        return _class(bytes(probe.encode_ordinary(every)).decode())

    letters, digits, blank = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    for inside, outside, ranges in ((r"\p{L}", None, letters), (r"\p{N}", None, digits)):
        pattern = pattern.replace(f" ?{inside}+", f" ?[{ranges}]+").replace(inside, ranges)
    return pattern.replace(r"[^\s", "[^" + blank).replace(r"\S", f"[^{blank}]").replace(r"\s", f"[{blank}]")


class Codec:
    """Encodes and decodes with one vocabulary; keeps a bounded memo."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ranks = dict(zip(vocabulary.tokens, vocabulary.ids.tolist()))
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.split = regex.compile(vocabulary.pattern).findall
        self.split_rare = None
        self.memo: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        if not text.isascii() and SETTLED.search(text):
            if self.split_rare is None:
                self.split_rare = regex.compile(library_pattern(self.vocabulary.pattern)).findall
            return self.split_rare(text)
        return self.split(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers."""
        split = [self.words(t) for t in texts]
        memo = self.memo
        new = list({w for words in split for w in words if w not in memo})
        raw = [w.encode() for w in new]
        for word, octets, found in zip(new, raw, self.vocabulary.find(raw)):
            ids = [found] if found >= 0 else merge(octets, self.ranks)
            memo[word] = np.array(ids, dtype="<u4").tobytes()
        out = [b"".join(map(memo.__getitem__, words)) for words in split]
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    if shared.value is not None and id(shared.value) not in _codecs:
        _codecs.clear()
        _codecs[id(shared.value)] = Codec(shared.value)
    return _codecs[id(shared.value)]


def groups(texts: list[str], size: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about `size` characters together; bounds what one step holds."""
    run, total = [], 0
    for text in texts:
        run.append(text)
        total += len(text)
        if total >= size:
            yield run
            run, total = [], 0
    if run:
        yield run


def encode(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ids as an int array, decoded as the bytes the ids stand for."""
    return _map(docs, vocabulary, doc_id, text, "ids array<int>, decoded binary", _whole)


def encode_digests(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), without moving the ids out of the task."""
    return _map(docs, vocabulary, doc_id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def _whole(ids: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
    return [
        pa.array([np.frombuffer(x, dtype="<i4") for x in ids], pa.list_(pa.int32())),
        pa.array(decoded, pa.binary()),
    ]


def _digests(ids: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
    return [
        pa.array([len(x) // 4 for x in ids], pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
        pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
    ]


def _map(docs: DataFrame, vocabulary: Vocabulary, doc_id: str, text: str, schema: str, columns) -> DataFrame:
    rows = id_and_text(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["doc_id"] + [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            at = 0
            for texts in groups(batch.column(1).to_pylist()):
                ids = codec.encode(texts)
                decoded = [codec.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *columns(ids, decoded)], names)
                at += len(texts)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {schema}")
