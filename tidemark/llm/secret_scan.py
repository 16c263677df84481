"""Secret scan: fixed patterns, and a small character convolutional network over every candidate.

Three base patterns always count. Other candidates are the rest of the runs of token characters: of at
least SHORT characters with letters and digits or with mixed case, or of LONG ones. The network sees pieces of INSIDE
characters all along the run, with what stands around them, and the largest calibrated probability decides. It is
trained on tokens of base findings of at most `rows` rows (smallest hashes first, of at most `longest` bytes; this is
the only sampling) as positives, words and runs of those rows that are plain by rule (PLAIN) as negatives, and made
ones so that both kinds exist in any corpus. Other candidates of the rows have no label and are not learned from. The
threshold is the highest that keeps the wanted recall on made secrets of kinds that are left out of training.

Defined results: a null text is empty; a text without findings has counts of zero and empty span
lists; spans are code points, end exclusive; repeated rows are scanned alike; an empty table
gives an empty result; columns with the names of the result are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import id_and_text, sampled

# The base patterns.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of at least 16, as the leftmost longest runs of [0-9a-f]+ are
KINDS = ("assign", "access", "hex", "model")
WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "api_key", "apikey")

SHORT, LONG = 12, 24
RUN = re.compile(r"[A-Za-z0-9+/_=.@:%-]{12,}")
MIXED = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]")
# Words, numbers as in dates, and both as in addresses, paths and versions.
PLAIN = re.compile(r"[^A-Za-z0-9]*(?:(?:[A-Z]?[a-z]{1,20}[0-9]{0,3}|[A-Z]{1,20}[0-9]{0,3}|[0-9]{1,8}[A-Za-z]?|[0-9]{1,2}T[0-9]{1,2})(?:[^A-Za-z0-9]+|$))+")
WORD = re.compile(r"[A-Za-z]{6,}")
BEFORE, INSIDE, AFTER = 24, 40, 8
WINDOW = BEFORE + INSIDE + AFTER
FILTERS, REACH, WIDTH = 16, 5, 8
LABELLED_ROWS, LONGEST, RECALL = 3000, 20_000, 0.98
REPLACEMENT = "[secret]"

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The base findings by start, then kind."""
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in WORDS_OF_ASSIGN):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def covered(base: list[Span]) -> list[tuple[int, int]]:
    """The stretches the findings cover, overlapping ones as one, by start."""
    out: list[tuple[int, int]] = []
    for _, a, z in sorted(base, key=lambda s: s[1]):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Runs that may be tokens, or what base findings leave of them; one walk over runs and findings together."""
    out, taken, k = [], covered(base), 0
    for m in RUN.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        at, pieces = m.start(), []
        while k < len(taken) and taken[k][0] < m.end():
            pieces.append((at, taken[k][0]))
            at = taken[k][1]
            if at > m.end():  # it may reach into the next run
                break
            k += 1
        for a, z in [*pieces, (at, m.end())]:
            run = text[a:z] if a < z else ""
            if len(run) >= LONG or len(run) >= SHORT and (any(c.isdigit() for c in run) and any(c.isalpha() for c in run) or MIXED.search(run)):
                out.append((a, z))
    return out


def window(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the characters before, in (the first INSIDE) and after a span; 0 where there are none, 127 for others."""
    inside = text[start : min(end, start + INSIDE)]
    whole = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0") + inside.ljust(INSIDE, "\0") + text[end : end + AFTER].ljust(AFTER, "\0")
    return np.array([min(ord(c), 127) for c in whole], dtype=np.uint8)


def windows(text: str, start: int, end: int) -> list[tuple[int, np.ndarray]]:
    """(start, window) of overlapping pieces that cover the whole span; the last one ends with it."""
    last = max(start, end - INSIDE)
    if last == start:
        return [(start, window(text, start, end))]
    shown = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0") + text[start : end + AFTER].ljust(end - start + AFTER, "\0")
    codes = np.minimum(np.frombuffer(shown.encode("utf-32-le"), dtype="<u4"), 127).astype(np.uint8)
    at = [*range(start, last, INSIDE // 2), last]
    return list(zip(at, np.lib.stride_tricks.sliding_window_view(codes, WINDOW)[np.array(at) - start]))


@dataclass
class Network:
    """Embedding, one convolution with maxima over the three parts of the window, one logistic unit."""

    embed: np.ndarray  # 128 x WIDTH
    kernel: np.ndarray  # (REACH * WIDTH) x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5

    PARTS = ((0, BEFORE), (BEFORE - REACH + 1, BEFORE + INSIDE - REACH + 1), (BEFORE + INSIDE - REACH + 1, WINDOW - REACH + 1))

    def forward(self, codes: np.ndarray):
        vectors = self.embed[codes]
        strips = np.concatenate([vectors[:, k : WINDOW - REACH + 1 + k] for k in range(REACH)], axis=2)
        raised = np.maximum(strips @ self.kernel + self.bias, 0)
        where = [raised[:, a:z].argmax(axis=1) + a for a, z in self.PARTS]
        pooled = np.concatenate([np.take_along_axis(raised, w[:, None, :], axis=1)[:, 0] for w in where], axis=1)
        return strips, where, pooled, pooled @ self.out + self.out_bias

    def probability(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.empty(0)
        a, b = self.scale
        score = np.concatenate([self.forward(codes[k : k + 512])[3] for k in range(0, len(codes), 512)])
        return 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))


def train_network(
    codes: np.ndarray, labels: np.ndarray, recall: float = RECALL, rounds: int = 12, seed: int = 7, unseen: list[np.ndarray] | None = None
) -> Network:
    """Adam steps on four fifths; scaling on the rest, threshold on the windows of `unseen` secrets or else on the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(codes))
    held, used = order[: max(2, len(order) // 5)], order[max(2, len(order) // 5) :]
    net = Network(
        rng.normal(0, 0.3, (128, WIDTH)), rng.normal(0, 0.2, (REACH * WIDTH, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.2, 3 * FILTERS), 0.0
    )
    names = ("embed", "kernel", "bias", "out")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    positive = max(labels[used].mean(), 1e-6)
    step = 0
    for _ in range(rounds):
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // 64)):
            step += 1
            strips, where, pooled, score = net.forward(codes[batch])
            y = labels[batch]
            weight = np.where(y > 0, 0.5 / positive, 0.5 / max(1 - positive, 1e-6))
            slope = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) / len(batch)
            grads = {"out": pooled.T @ slope, "bias": np.zeros(FILTERS), "kernel": np.zeros_like(net.kernel), "embed": np.zeros_like(net.embed)}
            for part, w in enumerate(where):
                own = slice(part * FILTERS, (part + 1) * FILTERS)
                back = slope[:, None] * net.out[own] * (pooled[:, own] > 0)
                grads["bias"] += back.sum(axis=0)
                picked = np.take_along_axis(strips, w[:, :, None], axis=1)  # batch x filters x strip
                grads["kernel"] += np.einsum("bfs,bf->sf", picked, back)
                into = back[:, :, None] * net.kernel.T[None]
                for k in range(REACH):
                    symbols = np.take_along_axis(codes[batch], w + k, axis=1)
                    np.add.at(grads["embed"], symbols, into[:, :, k * WIDTH : (k + 1) * WIDTH])
            net.out_bias -= 0.01 * float(slope.sum())
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                corrected = (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                getattr(net, n)[...] -= 0.01 * corrected
    score = net.forward(codes[held])[3]
    y = labels[held]
    a, b = 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))  # keeps the fit finite on separable data
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        a, b = a - 0.1 * float(((p - target) * score).mean()), b - 0.1 * float((p - target).mean())
    net.scale = (a, b)
    kept = np.sort(net.probability(codes[held][y > 0]) if unseen is None else [net.probability(w).max() for w in unseen])
    net.threshold = float(kept[int((1 - recall) * len(kept))]) if len(kept) else 0.5
    return net


def made_examples(seed: int = 11) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) by rule: random tokens after telling words, and things that only look like tokens."""
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    tokens = ("sk-", "ghp_", "xoxb-", "", "AKIA", "key-")
    cues = ("key: ", "Authorization: Bearer ", "secret=", "credential ", "pwd = ", "access key ")
    words = "the report on local water was read by all members in spring and autumn with great care".split()
    out = []
    for k in range(160):
        before = " ".join(rng.choice(words, 4)) + " " + cues[k % len(cues)]
        token = tokens[k % len(tokens)] + "".join(rng.choice(list(letters), int(rng.integers(20, 44))))
        out.append((f"{before}{token} {rng.choice(words)}", len(before), len(before) + len(token), 1))
        before = " ".join(rng.choice(words, 5)) + " "
        n = int(rng.integers(1, 99))
        plain = (
            f"{rng.choice(words)}.{n}@mail{n}.example.com", f"www.{rng.choice(words)}{n}.example.org/{rng.choice(words)}", f"2024-03-{n % 28 + 1:02d}T10:{n % 60:02d}:00",
            f"{'-'.join(rng.choice(words, 4))}-{n}", f"version-{n}.{n % 7}.{n % 5}-final", f"{rng.choice(words)}_{rng.choice(words)}_{rng.choice(words)}_{n}",
        )[k % 6]
        out.append((f"{before}{plain} {rng.choice(words)}", len(before), len(before) + len(plain), 0))
    return out


def made_secrets(kinds: tuple[str, ...], seed: int, rows: int = 240) -> list[tuple[str, int, int, int, int]]:
    """(text, start, end, secret start, secret end): secrets of the kinds in runs of their own or inside longer ones.

    In a kind, * stands for a random token and & for one without digits.
    """
    rng = np.random.default_rng(seed)
    letters = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    words = "the report on local water was read by all members in spring and autumn with great care".split()
    cues = ("", "use ", "key: ", "bearer ", "login with ", "it is \"", "at ")
    out = []
    for k in range(rows):
        kind = kinds[k % len(kinds)]
        token = "".join(rng.choice(letters if "*" in kind else letters[:52], int(rng.integers(20, 44))))
        front, rest = re.split(r"[*&]", kind)
        before = " ".join(rng.choice(words, 4)) + " " + cues[k // len(kinds) % len(cues)]
        a = len(before) + len(front)
        out.append((f"{before}{front}{token}{rest} {rng.choice(words)}", len(before), a + len(token) + len(rest), a, a + len(token)))
    return out


LEARNED = (
    "sk-*", "ghp_*", "xoxb-*", "*", "&", "key-&", "eyJhbGciOiJIUzI1NiJ9.*", "https://hooks.example.com/services/T01AB2CD3/B04EF5GH6/*",
    "postgres://admin:*@db.example.com:5432/app", "/srv/data/releases/current/config/keys/*", "https://example.org/api/v2/items/7/*",
)
LEFT_OUT = (
    "glpat-*", "npm_*", "hf_&", "SG.*", "AIza*", "whsec_*", "amqp://service:*@queue.example.net/main", "https://chat.example.net/webhooks/1029384756/*",
    "/home/build/project/settings/production/*", "eyJ0eXAiOiJKV1QiLCJhbGciOiJSUzI1NiJ9.*",
)


def secret_windows(text: str, start: int, end: int, a: int, z: int) -> list[np.ndarray]:
    """The windows of a run that show a good part of its secret."""
    return [w for at, w in windows(text, start, end) if min(z, at + INSIDE) - max(a, at) >= min(16, z - a)]


def made_long(seed: int = 13, rows: int = 160) -> list[tuple[str, int, int]]:
    """(text, start, end) of long addresses and paths without a secret."""
    rng = np.random.default_rng(seed)
    words = "report local water members spring autumn care index news archive images public static people places".split()
    out = []
    for k in range(rows):
        path = "/".join("-".join(rng.choice(words, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(2, 6))))
        n = int(rng.integers(1, 2030))
        plain = (
            f"https://www.{rng.choice(words)}.example.com/{path}/{n}.html", f"/usr/share/{path}/{rng.choice(words)}_{n}.txt",
            f"https://{rng.choice(words)}.example.org/{n}/{n % 12 + 1:02d}/{path}", f"{rng.choice(words).title()}{rng.choice(words).title()}{rng.choice(words).title()}",
            f"{'-'.join(rng.choice(words, 6))}", f"{rng.choice(words)}.{rng.choice(words)}@{rng.choice(words)}.example.net", "=" * 30, "-" * 40,
        )[k % 8]
        out.append((f"see {plain} {rng.choice(words)}", 4, 4 + len(plain)))
    return out


def examples(text: str) -> list[tuple[np.ndarray, int]]:
    """Labelled windows of a text: tokens of base findings, runs that are plain by rule, and a few words."""
    base = base_spans(text)
    tokens = [(ASSIGN.match(text, a, z).start(2) if kind == "assign" else a, z) for kind, a, z in base]
    out = [(w, 1) for a, z in tokens for _, w in windows(text, a, z)[:4]]
    others = candidates(text, base)
    plain = [(a, z) for a, z in others if z - a <= 400 and PLAIN.fullmatch(text, a, z)]
    out += [(w, 0) for a, z in plain for _, w in windows(text, a, z)]
    taken = [(a, z) for _, a, z in base] + others  # letters inside a candidate are no word
    words = [m.span() for m in WORD.finditer(text) if not any(a < m.end() and m.start() < z for a, z in taken)]
    out += [(window(text, a, z), 0) for a, z in words[:: max(1, len(words) // 3 + 1)]]
    return out


def made_windows() -> list[tuple[np.ndarray, int]]:
    found = [(window(t, a, z), y) for seed in range(11, 15) for t, a, z, y in made_examples(seed)]
    found += [(w, 1) for row in made_secrets(LEARNED, 17, 600) for w in secret_windows(*row)]
    return found + [(w, 0) for t, a, z in made_long(13, 480) for _, w in windows(t, a, z)]


def train(docs: DataFrame, text: str = "text", rows: int = LABELLED_ROWS, longest: int = LONGEST, recall: float = RECALL) -> Network:
    short = docs.select(F.col(f"`{text}`").alias("t")).where(F.octet_length("t") <= longest)
    found = made_windows()
    for row in sampled(short, {"t": F.col("t")}, ["t"], rows):
        found += examples(row["t"])
    unseen = [np.stack([w for _, w in windows(*row[:3])]) for row in made_secrets(LEFT_OUT, 19)]
    return train_network(np.stack([w for w, _ in found]), np.array([y for _, y in found], dtype=np.float64), recall, unseen=unseen)


def all_spans(texts: list[str], net: Network) -> list[tuple[list[Span], list[Span]]]:
    """(base, base and model) spans of every text; the candidates of all texts are scored together."""
    base = [base_spans(t) for t in texts]
    where, codes = [], []
    for k, text in enumerate(texts):
        for a, z in candidates(text, base[k]):
            for _, codes_at in windows(text, a, z):
                where.append((k, a, z))
                codes.append(codes_at)
    whole = [list(b) for b in base]
    if codes:
        likely = net.probability(np.stack(codes)) >= net.threshold
        for k, a, z in dict.fromkeys(w for w, hit in zip(where, likely) if hit):
            whole[k].append(("model", a, z))
    order = {kind: n for n, kind in enumerate(KINDS)}
    return [(b, sorted(w, key=lambda s: (s[1], order[s[0]]))) for b, w in zip(base, whole)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{z}" for kind, a, z in spans)


def scan(docs: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model."""
    rows = id_and_text(docs, doc_id, text)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_spans(batch.column(1).to_pylist(), net)
            counts = [[sum(s[0] == kind for s in whole) for _, whole in found] for kind in KINDS]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            spans = [joined(whole) for _, whole in found]
            longs = [pa.array(c, pa.int64()) for c in counts]
            columns = [batch.column(0), *longs[:3], pa.array(digests, pa.string()), pa.array(spans, pa.string()), longs[3]]
            yield pa.RecordBatch.from_arrays(columns, names)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{n} long" for n in names[1:4])
    return rows.mapInArrow(run, f"doc_id {id_type}, {longs}, base_sha256 string, spans string, n_model long")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every stretch that spans cover replaced."""
    out, at = [], 0
    for _, a, z in sorted(spans, key=lambda s: s[1]):
        if a >= at:
            out += [text[at:a], REPLACEMENT]
        at = max(at, z)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, net: Network, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """`docs` with all findings masked in the text, and the character count brought up to date if there is one."""
    names = docs.columns
    at = names.index(text)
    count = names.index(n_chars) if n_chars in names else None
    count_type = None
    if count is not None:
        count_type = {"int": pa.int32()}.get(docs.schema[n_chars].dataType.simpleString(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = all_spans([t or "" for t in texts], net)
            new = [masked(t, whole) if whole else t for t, (_, whole) in zip(texts, found)]
            columns = list(batch.columns)
            columns[at] = pa.array(new, pa.string())
            if count is not None:
                old = columns[count].to_pylist()
                columns[count] = pa.array([len(n) if n is not t else o for n, t, o in zip(new, texts, old)], count_type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
