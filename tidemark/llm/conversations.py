"""Repair of damaged conversations by a shortest path with one big integer as weight.

The rows of a conversation are edited so that the initials of the roles read `(s?(ua)+)?`. The edits form an acyclic
graph: a node is a place between rows and the state of that pattern, an edge keeps, reroles or deletes the next row or
inserts one. A path's weight is one integer: its cost in the high digits, and below them its letters as digits of fixed
width, the first letter highest, the places after the last letter zero. The minimum of these integers is the cheapest
path and, among the cheapest, the one whose letters are least in ASCII; nothing else is compared.

From a node no two edges have the same letter, so paths of equal cost already differ in their first letter, and what
is cut off below cannot decide. Rows therefore go in blocks of BLOCK: the low digits hold the letters of one block, and
only the costs of its first nodes are carried to the block before. Work and memory grow with the rows of a conversation.

All that leaves a row for this is one letter: its role's initial and its fault. Rows are numbered by a range
partitioning over conversation, turn, role and text, written before use, so a conversation that holds a third of all
rows is cut over many partitions; the letters of one conversation meet in one row, as the audit it is returned with does. The edits go back to
the rows by number; the repaired text is hashed as it streams by, in order, and never held.

Defined results: null texts, roles and (in the hashed name of a row) ids and turns are one space; rows of equal turn are ordered by
role and text, which keeps a repeated row beside its original; a null conversation id is a conversation; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, stored

BLANK = r"^[\x20\x09-\x0D]*$"
ENDED = r"[.!?][\x20\x09-\x0D]*$"
# Faults in the order of their codes, and the initials the pattern knows; a row's letter is 'a' + 4 * initial + fault.
FAULTS = ("sound", "blank", "duplicate", "truncated")
INITIALS = ("s", "u", "a")
LAWFUL = {"su", "ua", "au"}
BLOCK = 256
WIDTH = 3  # bits of a digit
LETTERS = " DIKR"  # digits 0 to 4, ASCII order

# States of the pattern: nothing yet, after s, after u, after a. STEP[state][initial] is the next one.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ACCEPTED = (START, ASSISTANT)
NEVER = 1 << 62


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def _row_edges(code: int, state: int, costs: Costs) -> list[tuple[int, str, int]]:
    """(cost, letter, next state) of the edits of one row."""
    initial, fault = divmod(code, 4)
    edges = [(costs.delete, "D", state)]
    if FAULTS[fault] in ("blank", "duplicate"):
        return edges
    more = costs.truncated if FAULTS[fault] == "truncated" else 0
    own = INITIALS[initial] if initial < len(INITIALS) else ""
    if own in STEP[state]:
        edges.append((costs.keep + more, "K", STEP[state][own]))
    wanted = [x for x in STEP[state] if x in "ua"]
    # Keeping a role costs less than setting it again, so a row is reroled only to another one.
    edges += [(costs.rerole + more, "R", STEP[state][x]) for x in wanted if x != own]
    return edges


def _inserted(state: int) -> int:
    """The state after an insert; from every state one initial is possible."""
    return next(STEP[state][x] for x in STEP[state] if x in "ua")


def _before_row(rows: list[int], digits: int, costs: Costs) -> list[int]:
    """Weights of the four states with inserts allowed first, from the weights without."""
    out = list(rows)
    # An insert costs something, so no cheapest path comes back to a state by inserts: three in a row are enough.
    for _ in range(3):
        out = [
            min(out[s], _ahead(out[_inserted(s)], costs.insert, "I", digits)) for s in range(4)
        ]
    return out


def _ahead(weight: int, cost: int, letter: str, digits: int) -> int:
    """The weight of a path with one more edge in front: its letter takes the highest place, the others move down one."""
    low = WIDTH * digits
    letters = weight & ((1 << low) - 1)
    return ((weight >> low) + cost << low) + (LETTERS.index(letter) << low - WIDTH) + (letters >> WIDTH)


def solve_block(codes: bytes, after: list[int], last: bool, costs: Costs = Costs()) -> list[int]:
    """Weights of the four states before the first row of a block, given the costs after its last row.

    A block of n rows holds up to 4 * (n + 1) letters: one of a row and three inserts before each row and after the last.
    """
    digits = 4 * (len(codes) + 1)
    low = WIDTH * digits
    now = [cost << low for cost in after]
    if last:
        now = _before_row(now, digits, costs)
    for code in reversed(codes):
        now = [
            min(_ahead(now[to], cost, letter, digits) for cost, letter, to in _row_edges(code, state, costs))
            for state in range(4)
        ]
        now = _before_row(now, digits, costs)
    return now


def repair(codes: bytes, costs: Costs = Costs(), block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit letters of the best repair of rows with these codes."""
    after = [0 if s in ACCEPTED else NEVER for s in range(4)]
    solved = []
    begins = list(range(0, len(codes), block)) or [0]
    for begin in reversed(begins):
        part = codes[begin : begin + block]
        weights = solve_block(part, after, begin == begins[-1], costs)
        digits = 4 * (len(part) + 1)
        solved.append((part, weights, digits))
        after = [w >> WIDTH * digits for w in weights]
    total, state, audit = after[START], START, []
    for part, weights, digits in reversed(solved):
        letters = weights[state] & ((1 << WIDTH * digits) - 1)
        word = "".join(LETTERS[int(d)] for d in f"{letters:0{digits}o}").rstrip(" ")
        audit.append(word)
        state = run_through(part, word, state, costs)[1]
    return total, "".join(audit)


def run_through(codes: bytes, word: str, state: int, costs: Costs = Costs()) -> tuple[list[str], int]:
    """What becomes of each row, and the state at the end.

    A row's action is K, D, or the initial it is reroled to; initials inserted before it stand in front in upper case, those
    after the last row behind it, after a full stop.
    """
    actions, ahead, k = [], "", 0
    for letter in word:
        if letter == "I":
            state = _inserted(state)
            ahead += "UA"[state == ASSISTANT]
            continue
        before, state = state, next(to for _, x, to in _row_edges(codes[k], state, costs) if x == letter)
        action = letter if letter in "DK" else next(x for x, to in STEP[before].items() if to == state and x in "ua")
        actions.append(ahead + action)
        ahead, k = "", k + 1
    if ahead and actions:
        actions[-1] += "." + ahead
    return actions, state


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) after the damage that the hash of `conv:turn` names; see the module for nulls."""
    space = F.lit(" ")
    named = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(named.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    hurt = rows.select("conv", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    lost = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    set_role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return hurt.select("conv", "turn", set_role.alias("role"), lost.alias("text"), F.explode(times)).drop("col")


def numbered(rows: DataFrame) -> DataFrame:
    """Stored rows with pos, which grows in the order of conversation, turn, role and text; rows of a part follow each other."""
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return stored(
        dealt.select(
            F.monotonically_increasing_id().alias("pos"), F.spark_partition_id().alias("part"), "conv", "turn", "role", "text",
            F.unhex(digest).alias("digest"),
        ),
        "numbered-turns",
    )


def coded(rows: DataFrame) -> DataFrame:
    """(conv, part, pos, code) of numbered rows: one letter for the role's initial and the row's first fault."""
    first = rows.groupBy("conv", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv").alias("__conv"), F.col("digest").alias("__digest"), "first")
    initial = F.substring("role", 1, 1)
    known = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    own = F.when(F.col("text").rlike(BLANK), 1).when(F.col("text").rlike(ENDED), 0).otherwise(3)
    small = rows.select("conv", "part", "pos", "digest", initial.alias("initial"), known.alias("known"), own.alias("own"))
    same = F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("digest") == F.col("__digest"))
    met = small.join(first, same, "left")
    fault = F.when(F.col("own") == 1, 1).when(F.col("first") < F.col("pos"), 2).otherwise(F.col("own"))
    return met.select("conv", "part", "pos", F.chr(97 + 4 * F.col("known") + fault).alias("code"))


FOUND = ("blank", "duplicate", "truncated", "illegal", "cost", "audit", "parts")
KINDS = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("actions", pa.list_(pa.string()))]))]
FOUND_TYPES = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, parts array<struct<start:long,actions:array<string>>>"


def solved(codes: DataFrame, costs: Costs = Costs(), block: int = BLOCK) -> DataFrame:
    """(conv, the counts, cost, audit, parts) per conversation; parts have each row's action in the order of the rows."""
    parts = codes.groupBy("conv", "part").agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    parts = parts.select("conv", F.struct(F.col("rows")[0]["pos"].alias("start"), F.array_join(F.col("rows")["code"], "").alias("codes")).alias("own"))
    # Little data but much work: dealt out by a fixed number, as adaptive execution would merge it into one task.
    dealt = parts.repartition(partitions(codes.sparkSession), "conv")
    whole = dealt.groupBy("conv").agg(F.array_sort(F.collect_list("own")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for own in batch.column(1).to_pylist():
                rows = bytes(ord(x) - 97 for part in own for x in part["codes"])
                cost, audit = repair(rows, costs, block)
                actions = run_through(rows, audit, START, costs)[0]
                names = ["".join(INITIALS[c // 4] if c // 4 < 3 else "-" for c in rows[k : k + 2]) for k in range(len(rows) - 1)]
                count = [sum(c % 4 == k for c in rows) for k in range(4)]
                cut, at = [], 0
                for part in own:
                    cut.append({"start": part["start"], "actions": actions[at : at + len(part["codes"])]})
                    at += len(part["codes"])
                illegal = sum(x not in LAWFUL for x in names)
                found.append([*count[1:], illegal, cost, audit, cut])
            columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(KINDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["conv", *FOUND])

    schema = f"conv {codes.schema['conv'].dataType.simpleString()}, {FOUND_TYPES}"
    return stored(whole.mapInArrow(run, schema), "repairs")


def _spoken(inserted: Column) -> Column:
    """The lines of inserted initials, as an array."""
    each = F.filter(F.split(inserted, ""), lambda x: x != "")
    return F.transform(each, lambda x: F.when(x == "U", F.lit("user:")).otherwise(F.lit("assistant:")))


def repaired_lines(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv, pos, lines): the lines of the repaired conversation that each numbered row stands for, none if it is deleted."""
    each = repairs.select(F.explode("parts").alias("p")).select("p.start", F.posexplode("p.actions").alias("k", "action"))
    each = each.select((F.col("start") + F.col("k")).alias("pos"), "action")
    after = F.when(F.contains("action", F.lit(".")), F.substring_index("action", ".", -1)).otherwise(F.lit(""))
    body = F.substring_index("action", ".", 1)
    front, kind = F.regexp_extract(body, "^[UA]*", 0), F.regexp_extract(body, "[DKua]$", 0)
    role = F.when(kind == "u", F.lit("user")).when(kind == "a", F.lit("assistant")).otherwise(F.col("role"))
    line = F.when(kind == "D", F.array().cast("array<string>")).otherwise(F.array(F.concat(role, F.lit(":"), "text")))
    joined = rows.select("conv", "pos", "role", "text").join(each, "pos")
    return joined.select("conv", "pos", F.concat(_spoken(front), line, _spoken(after)).alias("lines"))


def text_digests(lines: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of the newline-joined lines per conversation; lines stream by in order."""
    dealt = lines.where(F.size("lines") > 0).repartition(partitions(lines.sparkSession), "conv").sortWithinPartitions("conv", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, names, found = None, None, [], []
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for conv, spoken in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest is None or conv != held:
                    if digest is not None:
                        names.append(held)
                        found.append(digest.hexdigest())
                    held, digest = conv, hashlib.sha256("\n".join(spoken).encode())
                else:
                    digest.update(("\n" + "\n".join(spoken)).encode())
            if len(names) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array(found)], ["conv", "repaired_sha256"])
                names, found = [], []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([*names, held], kind), pa.array([*found, digest.hexdigest()])], ["conv", "repaired_sha256"])

    schema = f"conv {lines.schema['conv'].dataType.simpleString()}, repaired_sha256 string"
    return dealt.select("conv", "lines").mapInArrow(run, schema)


def repair_rows(rows: DataFrame, costs: Costs = Costs(), block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The numbered rows of (conv, turn, role, text) without nulls in role and text, and the repair of every conversation."""
    turns = numbered(rows)
    return turns, solved(coded(turns), costs, block)


def repair_damaged(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    costs: Costs = Costs(), block: int = BLOCK,
) -> DataFrame:
    """One row per conversation of `df`: what the damage did to it, the cheapest repair, and the digest of the repaired text."""
    rows = df.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    turns, repairs = repair_rows(damaged(rows), costs, block)
    by_turn = turns.where("turn is not null").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    spans = by_turn.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    digests = text_digests(repaired_lines(turns, repairs))
    out = rows.select(F.col("conv").alias("conv_id")).distinct()
    for part in (spans, repairs.drop("parts"), digests):
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "conv_id", *(F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )
