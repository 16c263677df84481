"""Small helpers the text operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_shipped: set[str] = set()
FILE_ROWS = 50_000  # rows of a scratch file, about
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context: SparkContext = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = os.path.join(tempfile.mkdtemp(), "tidemark_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted((root / "tidemark").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python in batches of some BATCH_BYTES, unless the session says otherwise.

    Every task has several of a batch in memory at once, in the JVM outside its heap and as objects in its worker; Spark's own 64 MB
    of texts cost an executor hundreds of MB.
    """
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, as (doc_id, text); a null text is empty."""
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )


def ascii_lower(column):
    """Lower-case A-Z and nothing else; `lower` does it for pure ASCII and is many times faster."""
    ascii_only = F.length(column) == F.octet_length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, UPPER, UPPER.lower()))


def sampled(df: DataFrame, columns: dict, by: list, rows: int) -> list:
    """At most `rows` rows of `columns` (name to expression), those with the smallest hashes of `by`, one per hash.

    The hashes are ranked first, so a task sends no row that is not wanted, however many tasks there are.
    """
    keyed = df.select(F.xxhash64(*by).alias("__hash"), *(c.alias(n) for n, c in columns.items()))
    ranked = keyed.select("__hash").distinct().orderBy("__hash").limit(rows)
    largest = ranked.agg(F.max("__hash")).first()[0]
    if largest is None:
        return []
    chosen = keyed.where(F.col("__hash") <= largest).groupBy("__hash").agg(F.min(F.struct(*columns)).alias("row"))
    return [r["row"] for r in sorted(chosen.collect(), key=lambda r: r["__hash"])]


def files_of(rows: int, file_rows: int = FILE_ROWS) -> int:
    return -(-max(rows, 1) // file_rows)


def in_files(df: DataFrame, rows: int, purpose: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """`df` of about `rows` rows, stored in files of `file_rows`: a shuffle's many partitions would each make a small one.

    Executors start a process for every file they create where Hadoop has no native library, which for that moment counts
    with all their memory. A file is also the work of one task, so rows that take long or hold much get a smaller `file_rows`.
    """
    return stored(df.coalesce(files_of(rows, file_rows)), purpose)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about `size` bytes, one long row at least."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            rows = batch.num_rows - start
            while rows > 1 and batch.slice(start, rows).get_total_buffer_size() and batch.slice(start, rows).nbytes > size:
                rows = (rows + 1) // 2
            yield batch.slice(start, rows)
            start += rows


def utf8_list(column: pa.Array) -> list[bytes]:
    """The bytes of a text column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
