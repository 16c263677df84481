"""Language identification by fusing evidence with Bayes' rule.

Evidence of a row: its text (byte trigrams under a multinomial model per language, and a uniform
one for text in none of them), the language its markup declares, and where it comes from. The
prior of a host is smoothed in levels: its own counts, backed by those of its address suffix,
backed by those of all rows. Counts are sums of text-only posteriors, grouped over all rows.

The text model is fitted on every labelled code: the codes of all rows are counted, and `rows` is shared out among
them, FEWEST rows a code at least (smallest hashes first, texts of at most `longest` bytes, or the beginnings of
longer ones for a code without such; this is the only sampling). Host priors are joined, and broadcast only if they
were counted and are small. Declared codes have two or three letters, so at most 18,252 exist.

Defined results: a row is `und` if the uniform model wins or no language reaches half the
posterior; a null or empty text leaves the other evidence; unknown or null hosts, suffixes and declared codes carry
no evidence of their own; without labelled rows the language is null and nothing is rejected;
columns named language or confidence are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import in_files
from tidemark.operators.reduce import broadcast_if_small

LABELLED_ROWS = 2000
FEWEST, MOST = 20, 20_000  # rows of a code, unless that makes more rows than MOST in all
LONGEST = 20_000
BUCKETS = 1 << 15
EVIDENCE = 200  # trigrams a text counts for at most: neighbouring ones are not independent
NEITHER = 1e-6  # prior of text in no known language
FOREIGN = 0.1  # share of trigrams of no language in any text
SMOOTHING = 10.0
PIECE = 1 << 20
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, dtype=np.uint32)
_FOLD[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = [*range(0x61, 0x7B), *range(0x80, 0x100)]
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_TAGS = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of the trigrams that hold a letter, block by block."""
    for at in range(0, max(len(text) - 2, 0), PIECE):
        x = _FOLD[np.frombuffer(text[at : at + PIECE + 2], dtype=np.uint8)]
        packed = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        packed = packed[packed != 0x202020]
        yield ((packed * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64)


def without_markup(html: bytes) -> bytes:
    return _TAGS.sub(" ", html.decode("utf-8", "replace")).encode()


@dataclass
class TextModel:
    languages: list[str]
    table: np.ndarray  # log probability of a bucket, per bucket and language; the last column is the uniform model

    def evidence(self, text: bytes) -> np.ndarray:
        """Log likelihood of the text per language and for none of them, as of at most EVIDENCE trigrams."""
        total, count = np.zeros(self.table.shape[1]), 0
        for found in trigrams(text):
            total += self.table[found].sum(axis=0, dtype=np.float64)
            count += len(found)
        return total * min(1.0, EVIDENCE / count) if count else total


def fit(rows: list[tuple[bytes, str]]) -> TextModel:
    """The table is made one language at a time, so beside it only one column of counts is held."""
    texts: dict[str, list[bytes]] = {}
    for text, lang in rows:
        texts.setdefault(lang, []).append(text)
    languages = sorted(texts)
    table = np.full((BUCKETS, len(languages) + 1), -np.log(BUCKETS), dtype=np.float32)
    for k, lang in enumerate(languages):
        smooth = np.full(BUCKETS, 0.05)
        for text in texts[lang]:
            for found in trigrams(text):
                smooth += np.bincount(found, minlength=BUCKETS)
        # A language also holds some text of no language (keys, numbers, names): one odd stretch does not outweigh the rest.
        table[:, k] = np.log((1 - FOREIGN) * (smooth / smooth.sum()) + FOREIGN / BUCKETS)
    return TextModel(languages, table)


def code(column: Column) -> Column:
    """The primary language code of a declared language, null if it has none."""
    found = F.regexp_extract(F.lower(column), r"^\s*([a-z]{2,3})([-_].*)?\s*$", 1)
    return F.when(found != "", found)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = LABELLED_ROWS, longest: int = LONGEST) -> TextModel:
    known = labelled.select(F.col(f"`{text}`").alias("text"), code(F.col(f"`{lang}`")).alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.withColumn("cut", F.octet_length("text") > longest).withColumn("hash", F.xxhash64("text", "lang"))
    hashes = in_files(known.select("lang", "cut", "hash").distinct(), labelled.count(), "label-hashes")
    found: dict[str, tuple[bool, int]] = {}
    for r in sorted(hashes.groupBy("lang", "cut").count().collect()):
        found.setdefault(r["lang"], (r["cut"], r["count"]))  # texts that need no cut come first
    if not found:
        return fit([])
    share = max(rows // len(found), min(FEWEST, MOST // len(found)), 1)
    # Hashes are spread evenly, so a bound with room to spare holds the wanted ones; exact ranks are taken of those.
    room = share + 8 * share**0.5 + 16
    bounds = [(c, cut, -(2**63) + int(2**64 * room / n) if n > room else 2**63 - 1) for c, (cut, n) in found.items()]

    def within(df: DataFrame, limits: list[tuple[str, bool, int]]) -> DataFrame:
        limited = df.sparkSession.createDataFrame(limits, "lang string, cut boolean, bound long")
        return df.join(F.broadcast(limited), ["lang", "cut"]).where("hash <= bound")

    least: dict[str, list[int]] = {}
    for r in within(hashes, bounds).select("lang", "hash").collect():
        least.setdefault(r["lang"], []).append(r["hash"])
    last = [(c, found[c][0], sorted(h)[:share][-1]) for c, h in least.items()]
    text_of = F.substring("text", 1, longest)
    chosen = within(known, last).groupBy("lang", "hash").agg(F.min(text_of).alias("text")).collect()
    return fit([(r["text"].encode(), r["lang"]) for r in sorted(chosen, key=lambda r: r["hash"])])


def softmax(logs: np.ndarray) -> np.ndarray:
    e = np.exp(logs - logs.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def identify(
    df: DataFrame, model: TextModel, text: str, declared: Column, host: Column, suffix: Column, markup: bool = False
) -> DataFrame:
    """`df` with language and confidence, the posterior of that language."""
    languages = model.languages
    kept = [c for c in df.columns if c not in ("language", "confidence")]
    rows = df.select(
        *(f"`{c}`" for c in kept),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"),
        code(declared).alias("__declared"),
        host.alias("__host"),
        F.coalesce(suffix, F.lit("")).alias("__suffix"),
    )
    if not languages:
        return rows.select(*kept, F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"))
    size = len(languages)

    def likelihood(column: pa.Array) -> np.ndarray:
        texts = (x.as_py() for x in column.cast(pa.binary()))
        return np.array([model.evidence(without_markup(t) if markup else t) for t in texts]).reshape(-1, size + 1)

    def soft(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.log([*[(1 - NEITHER) / size] * size, NEITHER])
        for batch in batches:
            belief = softmax(likelihood(batch.column(0)) + start)
            columns = [batch.column(k) for k in (1, 2, 3)] + [pa.array(belief[:, k]) for k in range(size)]
            yield pa.RecordBatch.from_arrays(columns, ["declared", "host", "suffix", *names])

    names = [f"p{k}" for k in range(size)]
    doubles = ", ".join(f"{n} double" for n in names)
    beliefs = rows.select("__text", "__declared", "__host", "__suffix").mapInArrow(
        soft, f"declared string, host string, suffix string, {doubles}"
    )
    # One pass over the texts; what is grouped below is small rows.
    beliefs = beliefs.groupBy("declared", "host", "suffix").agg(*(F.sum(n).alias(n) for n in names))
    beliefs = in_files(beliefs, df.count(), "beliefs")
    groups = beliefs.count()
    sums = [F.sum(n).alias(n) for n in names]
    overall = np.array([x or 0.0 for x in beliefs.agg(*sums).first()]) + 1.0
    overall = (overall / overall.sum()).tolist()
    said = {r["declared"]: np.array(r[1:]) for r in beliefs.where("declared is not null").groupBy("declared").agg(*sums).collect()}
    all_said = sum(said.values(), np.zeros(size))
    # P(declared | language), each code smoothed by its share of all declarations.
    claims = {
        c: np.log((n + SMOOTHING * (n.sum() + 1) / (all_said.sum() + 1)) / (all_said + SMOOTHING)) for c, n in said.items()
    }

    def smoothed(level: DataFrame, key: str, parent: list[Column]) -> DataFrame:
        total = sum(F.col(n) for n in names)
        shares = [((F.col(n) + SMOOTHING * p) / (total + SMOOTHING)).alias(f"q{k}") for k, (n, p) in enumerate(zip(names, parent))]
        return level.select(key, *[c for c in level.columns if c == "suffix" and key != "suffix"], *shares)

    by_suffix = smoothed(beliefs.groupBy("suffix").agg(*sums), "suffix", [F.lit(x) for x in overall])
    by_suffix = in_files(by_suffix.toDF("suffix", *(f"s{k}" for k in range(size))), groups, "suffix-priors")
    hosts = beliefs.groupBy("host", "suffix").agg(*sums).join(by_suffix, "suffix")
    priors = smoothed(hosts, "host", [F.col(f"s{k}") for k in range(size)])
    priors = priors.select(
        F.col("host").alias("__h"), F.col("suffix").alias("__s"), F.array(*(f"q{k}" for k in range(size))).alias("__prior")
    )
    priors = in_files(priors, groups, "host-priors")
    priors = broadcast_if_small(priors, priors.count() * (1 + size // 8))
    joined = rows.join(priors, F.col("__host").eqNullSafe(F.col("__h")) & (F.col("__suffix") == F.col("__s")), "left")
    joined = joined.select(*(f"`{c}`" for c in kept), "__text", "__declared", "__prior")
    width = len(kept)
    out_names = [*kept, "language", "confidence"]

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(size)
        for batch in batches:
            logs = likelihood(batch.column(width))
            prior = np.array([p or overall for p in batch.column(width + 2).to_pylist()]).reshape(-1, size)
            claim = np.array([claims.get(c, nothing) for c in batch.column(width + 1).to_pylist()]).reshape(-1, size)
            logs[:, :size] += np.log(prior * (1 - NEITHER)) + claim
            # What is declared says nothing about text in no language: its mean over the languages.
            logs[:, size] += np.log(NEITHER) + claim.mean(axis=1)
            belief = softmax(logs)
            best = belief.argmax(axis=1)
            sure = belief[np.arange(len(best)), best]
            answer = [UNKNOWN if b == size or s < 0.5 else languages[b] for b, s in zip(best.tolist(), sure.tolist())]
            columns = [batch.column(k) for k in range(width)] + [pa.array(answer, pa.string()), pa.array(sure, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, out_names)

    fields = [T.StructField(c, rows.schema[c].dataType) for c in kept]
    schema = T.StructType([*fields, T.StructField("language", T.StringType()), T.StructField("confidence", T.DoubleType())])
    return joined.mapInArrow(fuse, schema)


def page_languages(pages: DataFrame, model: TextModel, html: str = "html", url: str = "url") -> DataFrame:
    """`pages` with language and confidence: text, <html lang>, address suffix, host."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    declared = F.regexp_extract(F.col(f"`{html}`"), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1)
    return identify(pages, model, html, declared, host, F.regexp_extract(host, r"([^.]*)$", 1), markup=True)


def document_languages(docs: DataFrame, model: TextModel) -> DataFrame:
    """`docs` with language and confidence: text, declared lang, and source as the host."""
    return identify(docs, model, "text", F.col("lang"), F.col("source"), F.lit(""))
