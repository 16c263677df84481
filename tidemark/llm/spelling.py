"""Spelling variants by a trie over letter-group counts.

A word becomes the vector of how many letters of each group it has. One inserted, deleted or replaced letter changes
that vector by at most one surplus and one deficit. The words stand in a trie whose levels are the length and then the
counts of one group after another; a search goes down depth first, follows children whose count is one more only while
its surplus is unspent, and one less only while its deficit is. All words looked up in a node go down together. Below a node with
few pairs left the remaining levels are compared at once, and the words of a leaf are verified letter by letter.

The groups are fitted on all words: frequent letters have a group of their own, rare ones share, the most frequent come
first. Spark holds the top levels of the trie: a word is stored under its length and the counts of its first groups, and looked
up under all such keys the budget reaches. Of the two words of a pair only one looks up the other: the shorter one, or of two
equally long ones the one whose first different count is smaller, or the one that is first in order under the same key, so
every pair is found once. How many levels are keys grows with the vocabulary. A key with many words is cut into chunks on
both sides, so a task holds a bounded part of each; tasks return sums per word and not pairs.

Defined results: a null text has no words and a null id is empty in the hashed name of a run; repeated rows count each; words
have at least `least_length` letters and `least_count` occurrences; of near words with equal counts the first in code-point order is
the form; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.operators.reduce import broadcast_if_small

LETTERS = "A-Za-zÀ-ÿ"
DAMAGED = 97  # one of so many runs loses a letter
LEAST_LENGTH, LEAST_COUNT = 5, 3
GROUPS = 14
HELD_WORDS = 200_000  # distinct words a counting task holds before it passes them on
CHUNK_LETTERS = 1 << 18  # letters of the words on one side of a task
KEY_WORDS = 4000  # words of a key, roughly, from which the next level becomes part of it
DENSE = 1 << 15  # pairs compared at once
VERIFY = 1 << 16
FILE_ROWS = 50_000  # rows of a scratch file, about


def _in_files(df: DataFrame, rows: int, purpose: str) -> DataFrame:
    """`df` of some `rows` rows, stored in files of FILE_ROWS: a shuffle's many partitions would each make one of a few hundred rows.

    Executors start a process for every file they create where Hadoop has no native library, which for that moment counts with all their memory.
    """
    return stored(df.coalesce(-(-max(rows, 1) // FILE_ROWS)), purpose)


# -- words ---------------------------------------------------------------------------


def damaged_word(head: int, run: str, every: int = DAMAGED) -> str:
    """The run itself, or without one letter if the hash says so; `head` is the CRC of `doc_id:`."""
    h = zlib.crc32(run.encode(), head)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) over all rows of (doc_id, text)."""
    # Shorter runs cannot give a word that is long enough.
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                head = zlib.crc32(f"{name}:".encode())
                # Of bytes, lower() changes A-Z alone.
                for found, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    word = damaged_word(head, found)
                    if len(word) >= least_length:
                        total[word] += n
            if len(total) > HELD_WORDS:
                yield _counted(total)
                total.clear()
        if total:
            yield _counted(total)

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counts = named.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counts.where(F.col("n") >= least_count), "words")


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


# -- the trie ------------------------------------------------------------------------


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """The group of every code point below 256, by how often it stands in the words; at most that many rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, dtype=np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                text = "".join(batch.column(0).slice(k, 1000).to_pylist())
                total += np.bincount(np.frombuffer(text.encode("latin-1"), dtype=np.uint8), minlength=256)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["letter", "n"])

    found = words.select("word").mapInArrow(run, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    load, out = np.zeros(groups, dtype=np.int64), np.zeros(256, dtype=np.int64)
    for r in sorted(found, key=lambda r: (-r["n"], r["letter"])):
        out[r["letter"]] = load.argmin()
        load[out[r["letter"]]] += r["n"]
    # Letters without a group of their own weigh on the last ones; the heaviest group is the first level.
    return np.argsort(np.argsort(-load, kind="stable"), kind="stable")[out]


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of each word in a row of a matrix, zero after its end, and the lengths."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    out = np.zeros((len(words), int(length.max(initial=0)) + 1), dtype=np.uint8)
    out[np.arange(out.shape[1]) < length[:, None]] = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    return out, length


def count_vectors(letters: np.ndarray, length: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    inside = np.arange(letters.shape[1]) < length[:, None]
    row = np.repeat(np.arange(len(letters)), length)
    flat = np.bincount(row * groups + group[letters[inside]], minlength=len(letters) * groups)
    return flat.reshape(-1, groups)


def descend(points: np.ndarray, asked: np.ndarray, meet: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """Call `meet` with the places of pairs (asked, point) whose vectors differ by one surplus and one deficit at most.

    `points` are sorted; a node of the trie is a range of them.
    """
    levels = points.shape[1]

    def node(level: int, low: int, high: int, ask: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        while level < levels and points[low, level] == points[high - 1, level] and len(ask):
            step = points[low, level] - asked[ask, level]
            alive = (step == 0) | ((step == 1) & surplus) | ((step == -1) & deficit)
            ask, surplus, deficit = ask[alive], surplus[alive] & (step[alive] != 1), deficit[alive] & (step[alive] != -1)
            level += 1
        if not len(ask):
            return
        if level == levels or (high - low) * len(ask) <= DENSE:
            width = max(1, DENSE // (high - low))
            for at in range(0, len(ask), width):
                some = ask[at : at + width]
                step = points[low:high, None, level:] - asked[None, some, level:]
                more, less = np.maximum(step, 0).sum(axis=2), np.maximum(-step, 0).sum(axis=2)
                point, one = np.nonzero((more <= surplus[at : at + width]) & (less <= deficit[at : at + width]))
                if len(one):
                    meet(some[one], low + point)
            return
        column = points[low:high, level]
        begins = low + np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1])
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), high]):
            node(level, begin, end, ask, surplus, deficit)

    if len(points) and len(asked):
        yes = np.ones(len(asked), dtype=bool)
        node(0, 0, len(points), np.arange(len(asked)), yes, yes)


def one_edit(short: np.ndarray, n: np.ndarray, long: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether row by row one inserted or replaced letter turns the first word into the second, which is as long or longer by one."""
    width = max(short.shape[1], long.shape[1])
    short, long = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (short, long))
    place = np.arange(width)
    differ = (short != long) & (place < n[:, None])
    replaced = (m == n) & (differ.sum(axis=1) == 1)
    # Up to the first difference the words are alike; from there on the longer one is one letter ahead.
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), n)
    behind = (short[:, :-1] != long[:, 1:]) & (place[:-1] >= first[:, None]) & (place[:-1] < n[:, None])
    return replaced | ((m == n + 1) & ~behind.any(axis=1))


def near_in_task(words: list[str], n: np.ndarray, asks: np.ndarray, group: np.ndarray, groups: int, levels: int) -> pa.Table:
    """(word, n_near, most, form): sums over the pairs of a stored word and one that looks it up (`asks`)."""
    names = sorted(set(words))
    place = {w: k for k, w in enumerate(names)}
    of = np.fromiter((place[w] for w in words), dtype=np.int64, count=len(words))
    times = np.zeros(len(names), dtype=np.int64)
    times[of] = n
    letters, length = letters_of(names)
    vectors = count_vectors(letters, length, group, groups).astype(np.int16)
    points, asked = np.unique(of[~asks]), np.unique(of[asks])
    points = points[np.lexsort(vectors[points].T[::-1])]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    pairs: list[np.ndarray] = []

    def verify() -> None:
        a, b = (np.concatenate(x) for x in zip(*held))
        held.clear()
        for at in range(0, len(a), VERIFY):
            x, y = a[at : at + VERIFY], b[at : at + VERIFY]
            good = one_edit(letters[x], length[x], letters[y], length[y])
            x, y = x[good], y[good]
            # The side from which a pair is found: the shorter word, then the smaller counts in the key, then the first word.
            step = vectors[y, :levels] - vectors[x, :levels]
            first = np.take_along_axis(step, (step != 0).argmax(axis=1)[:, None], axis=1)[:, 0]
            ours = (length[y] > length[x]) | (first > 0) | ((first == 0) & (x < y))
            pairs.append(np.stack([x[ours], y[ours]], axis=1))

    def meet(ask: np.ndarray, point: np.ndarray) -> None:
        a, b = asked[ask], points[point]
        good = (length[b] == length[a]) | (length[b] == length[a] + 1)
        held.append((a[good], b[good]))
        if sum(len(x) for x, _ in held) > VERIFY:
            verify()

    descend(vectors[points], vectors[asked], meet)
    if held:
        verify()
    both = np.concatenate(pairs) if pairs else np.empty((0, 2), dtype=np.int64)
    left, right = both.T.ravel(), both[:, ::-1].T.ravel()
    best = np.lexsort((right, -times[right], left))
    left, right = left[best], right[best]
    some, first, count = np.unique(left, return_index=True, return_counts=True)
    return pa.table(
        {
            "word": pa.array([names[k] for k in some], pa.string()), "n_near": pa.array(count, pa.int64()),
            "most": pa.array(times[right[first]], pa.int64()), "form": pa.array([names[k] for k in right[first]], pa.string()),
        }
    )


# -- the table -----------------------------------------------------------------------


def _reach(levels: int) -> list[list[int]]:
    """Steps of the length and of the first groups to the keys where a word looks."""
    none = [0] * (levels + 1)
    out = [none, [1, *none[1:]]]
    for i in range(1, levels + 1):
        for longer in (0, 1):
            step = list(none)
            step[0], step[i] = longer, 1
            out.append(step)
        for j in range(i + 1, levels + 1):
            step = list(none)
            step[i], step[j] = 1, -1
            out.append(step)
    return out


def key_levels(words: int, groups: int = GROUPS) -> int:
    """So many groups are part of the key that it has some KEY_WORDS words on average; a level divides them by about four."""
    return int(np.clip(np.ceil(np.log(max(words, 1) / KEY_WORDS / 4) / np.log(4)), 1, min(groups, 8)))


def keyed(words: DataFrame, group: np.ndarray, groups: int, levels: int) -> DataFrame:
    """(key, asks, word, n): a row where a word is stored and, with `asks`, one for every key where it looks.

    The key is a sum of the length and the counts, each times its own odd number; should two nodes have the same one,
    words of both are compared and no pair is lost or counted twice.
    """
    factor = np.random.default_rng(11).integers(1, 2**62, levels + 1, dtype=np.int64) * 2 + 1
    reach = _reach(levels)
    asks = np.arange(len(reach) + 1) > 0
    steps = np.array([[0] * (levels + 1), *reach], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            far = (steps * factor).sum(axis=1)
            for batch in batches:
                for at in range(0, batch.num_rows, 2000):
                    part = batch.slice(at, 2000)
                    # Words of very different lengths would make a wide matrix: each length on its own.
                    lengths = pc.utf8_length(part.column(0)).to_numpy()
                    for n in np.unique(lengths):
                        own = part.filter(pa.array(lengths == n))
                        letters, length = letters_of(own.column(0).to_pylist())
                        counts = count_vectors(letters, length, group, groups)[:, :levels]
                        base = (np.concatenate([length[:, None], counts], axis=1) * factor).sum(axis=1)
                        row = pa.array(np.repeat(np.arange(own.num_rows), len(far)))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array((base[:, None] + far).ravel()), pa.array(np.tile(asks, own.num_rows)), own.column(0).take(row), own.column(1).take(row)],
                            ["key", "asks", "word", "n"],
                        )

    return words.select("word", "n").mapInArrow(run, "key long, asks boolean, word string, n long")


def near_words(words: DataFrame, groups: int = GROUPS, chunk_letters: int = CHUNK_LETTERS, levels: int | None = None) -> DataFrame:
    """(word, n_near, most, form) of the words of stored (word, n) that have near ones: how many, the largest n among them, and its word."""
    group = letter_groups(words, groups)
    total = words.count()
    levels = key_levels(total, groups) if levels is None else levels
    rows = keyed(words, group, groups, levels)
    asked = F.col("asks")
    size = F.length("word") + 16
    sizes = rows.groupBy("key").agg(F.sum(F.when(asked, 0).otherwise(size)).alias("held"), F.sum(F.when(asked, size).otherwise(0)).alias("asking"))
    # Only keys that store a word are of use; most of those looked up do not.
    sizes = sizes.where("held > 0 and asking > 0").select(
        "key", F.ceil(F.col("held") / chunk_letters).cast("int").alias("held_cuts"), F.ceil(F.col("asking") / chunk_letters).cast("int").alias("asking_cuts")
    )
    # Each has a word of its own, so there are no more than words.
    sizes = _in_files(sizes, total, "trie-keys")
    dealt = rows.join(broadcast_if_small(sizes, sizes.count()), "key")
    own = F.pmod(F.hash("word"), F.when(asked, F.col("asking_cuts")).otherwise(F.col("held_cuts")))
    others = F.sequence(F.lit(0), F.when(asked, F.col("held_cuts")).otherwise(F.col("asking_cuts")) - 1)
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(others))
    place = F.when(asked, F.struct("other", "own")).otherwise(F.struct(F.col("own").alias("other"), F.col("other").alias("own")))
    dealt = dealt.select("key", place.alias("place"), "asks", "word", "n")

    def run(table: pa.Table) -> pa.Table:
        return near_in_task(table["word"].to_pylist(), table["n"].to_numpy(), table["asks"].to_numpy(), group, groups, levels)

    found = dealt.groupBy("key", "place").applyInArrow(run, "word string, n_near long, most long, form string")
    best = F.min(F.struct((-F.col("most")).alias("less"), "form")).alias("best")
    sums = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return _in_files(sums.select("word", "n_near", (-F.col("best.less")).alias("most"), "best.form"), total, "near-words")


def with_roots(forms: DataFrame) -> DataFrame:
    """`forms` (word, form, ...) with root, the last word reached from form to form; pointers double in every round.

    Only words that have a form take part in the rounds; the others are their own root.
    """
    now = forms.where("form is not null").select("word", F.col("form").alias("root"))
    rows = now.count()
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = _in_files(step, rows, "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return forms.join(now, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_forms(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, **options
) -> DataFrame:
    """One row per word of `docs`: word, form, root, n, n_near, form_n."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    words = count_words(rows, least_length, least_count)
    near = near_words(words, **options)
    common = F.col("most") >= 2 * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word", F.when(common, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(common, F.col("most")).alias("form_n")
    )
    return with_roots(_in_files(forms, words.count(), "forms")).select("word", "form", "root", "n", "n_near", "form_n")
