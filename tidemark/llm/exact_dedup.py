"""Exact dedup against a persistent digest index.

The index is a Parquet table of digests, bucketed by digest, each bucket one sorted file. A batch is
reduced to one row per digest (combined before the shuffle, so a text that makes up
a third of the rows is no hot key), the digests already in the index are taken out
by a sort-merge anti-join that reads the index without a shuffle or a sort, and the new ones
are appended. Only DataFrame functions are used.

Appending merges old and new digests bucket by bucket into a new generation of files, beside the one that is being
read: the anti-join has read all digests anyway, and a bucket of many files would have to be sorted again in every batch.
The generation counts once its description (`about-N`: folder, bucket count, type of the ids) is written; a batch
that dies before leaves the index as it was. One writer at a time: a second one is refused when it publishes. The last two
generations are kept, so that results which still read the earlier one stay valid through the next batch.

Defined results: a null text counts as empty; texts that differ only in A-Z case are
equal; of equal texts in a batch the row with the largest id stays (null ids are
smallest), and of rows that also share the id exactly one. Between batches the
earlier batch keeps its row. An empty batch gives an empty result. Other columns of
the input are carried or ignored, whatever their names. An index that exists is opened with the bucket count and id type
it was made with; asking for others raises ValueError.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, in_files, partitions, stored
from tidemark.session import shared_folder


def digest_of(text):
    """SHA-256 of the normalised text as 32 bytes."""
    normal = ascii_lower(F.coalesce(text, F.lit("")))
    return F.unhex(F.sha2(F.encode(normal, "UTF-8"), 256))


FILE_TEXTS = 10_000  # whole rows of a scratch file
ABOUT = "generation long, folder string, buckets int, id_type string"


class DigestIndex:
    """Digests seen so far, in `path`. `buckets` and `id_type` are chosen when an index is made and adopted after that."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        # A bucket is one file, so Spark may rely on its order and leave out the sort.
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        found = self.published()
        if not found:
            self.buckets, self.id_type = buckets or partitions(spark), id_type or "bigint"
            self._open(0, "digests-0")
            return
        self.buckets, self.id_type = found[0].buckets, found[0].id_type
        for what, wanted, has in (("buckets", buckets, self.buckets), ("id type", id_type, self.id_type)):
            if wanted is not None and wanted != has:
                raise ValueError(f"the digest index in {path} has {what} {has}, not {wanted}")
        self._open(found[0].generation, found[0].folder)

    @classmethod
    def scratch(cls, spark: SparkSession, buckets: int | None = None, id_type: str = "bigint") -> DigestIndex:
        """A new, empty index below the shared folder."""
        return cls(spark, shared_folder(spark, "digests"), buckets, id_type)

    def published(self) -> list[Row]:
        """The descriptions of the generations there are, latest first."""
        try:
            return self.spark.read.schema(ABOUT).json(f"{self.path}/about-*").orderBy(F.desc("generation")).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    @staticmethod
    def _table(folder: str) -> str:
        return "digest_index_" + hashlib.sha256(folder.encode()).hexdigest()[:24]

    def _open(self, generation: int, folder: str) -> None:
        """Read from `folder`, under a table name made from its whole path."""
        self.generation, self.folder = generation, f"{self.path}/{folder}"
        self.name = self._table(self.folder)
        self.spark.sql(
            f"create table if not exists {self.name} (digest binary, keep_id {self.id_type}, batch string) using parquet "
            f"clustered by (digest) sorted by (digest) into {self.buckets} buckets location '{self.folder}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame, batch: str) -> DataFrame:
        """The rows of `groups` whose digest no other batch has brought."""
        seen = self.rows().where(F.col("batch") != F.lit(batch)).select("digest")
        return groups.join(seen.hint("merge"), "digest", "left_anti")

    def append(self, fresh: DataFrame, batch: str) -> None:
        """Add (digest, keep_id) rows. A digest that is there keeps its row, so a batch run again adds only what its first run did not."""
        old = self.rows().select("digest", F.struct("keep_id", "batch").alias("old"))
        new = fresh.select("digest", F.struct(F.col("keep_id").cast(self.id_type).alias("keep_id"), F.lit(batch).alias("batch")).alias("new"))
        merged = old.join(new.hint("merge"), "digest", "full_outer").select("digest", F.coalesce("old", "new").alias("row")).select("digest", "row.*")
        generation, folder = self.generation + 1, f"digests-{self.generation + 1}-{uuid.uuid4().hex[:12]}"
        path = f"{self.path}/{folder}"
        merged.write.bucketBy(self.buckets, "digest").sortBy("digest").option("path", path).format("parquet").saveAsTable(self._table(path))
        about = self.spark.range(1).select(
            F.lit(generation).alias("generation"), F.lit(folder).alias("folder"), F.lit(self.buckets).alias("buckets"), F.lit(self.id_type).alias("id_type")
        )
        about.coalesce(1).write.mode("error").json(f"{self.path}/about-{generation}")
        self._open(generation, folder)
        self._expire()

    def _expire(self) -> None:
        """Delete the generations before the last two, the description first."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for old in self.published()[2:]:
            for name in (f"about-{old.generation}", old.folder):
                path = hadoop.Path(f"{self.path}/{name}")
                path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
            self.spark.sql(f"drop table if exists {self._table(f'{self.path}/{old.folder}')}")

    def assign(self, docs: DataFrame, batch: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Add the batch and return one row per row of `docs`.

        Columns: doc_id, keep_id, group_size (equal rows in this batch), kept, text_sha256. A row equal to one of an
        earlier batch has kept = false and the keep_id of that batch.
        """
        keyed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), digest_of(F.col(f"`{text}`")).alias("digest"))
        # Rows that share digest and id are one counted row until the end.
        counted = stored(keyed.groupBy("digest", "doc_id").agg(F.count("*").alias("n")), "digest-counts")
        groups = counted.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
        self.append(self.unseen(groups, batch), batch)
        # Read by path, not as a bucketed table: both sides of the join are then shuffled
        # alike, and adaptive execution splits the digests that very many rows share.
        index = self.spark.read.schema(self.rows().schema).parquet(self.folder)
        owner = index.select("digest", F.col("keep_id").alias("owner"), (F.col("batch") == batch).alias("mine"))
        sizes = groups.select("digest", "group_size")
        known = stored(owner.join(sizes, "digest"), "digest-owners")
        copies = counted.join(known, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        return copies.select(
            "doc_id",
            F.col("owner").alias("keep_id"),
            "group_size",
            (F.col("mine") & F.col("doc_id").eqNullSafe(F.col("owner")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def ingest(self, docs: DataFrame, batch: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Add the batch and return its new rows whole: one per digest that no earlier batch has, all columns of `docs`."""
        columns = [f"`{c}`" for c in docs.columns]
        whole = F.struct(F.col(f"`{doc_id}`").alias("id"), F.struct(*columns).alias("row"))
        best = docs.groupBy(digest_of(F.col(f"`{text}`")).alias("digest")).agg(F.max(whole).alias("best"))
        fresh = best.select("digest", F.col("best.id").alias("keep_id"), F.col("best.row").alias("row"))
        kept = in_files(self.unseen(fresh, batch), docs.count(), "digest-batch", FILE_TEXTS)
        self.append(kept, batch)
        return kept.select("row.*")
