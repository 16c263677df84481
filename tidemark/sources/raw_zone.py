"""The landing zone: Parquet files per table, extract date and batch."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import entity

# Fixed value: shape of a landed batch folder.
_FOLDER = re.compile(
    r"^(?P<root>.+)/(?P<table>[^/]+)/extract_date=(?P<extract_date>\d{4}-\d{2}-\d{2})/batch_id=(?P<batch_id>[^/]+)/?$"
)


class RawZone:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def folder(self, table: str, extract_date: str, batch_id: str) -> str:
        return f"{self.root}/{entity(table).name}/extract_date={extract_date}/batch_id={batch_id}"

    def write(self, table: str, df: DataFrame, extract_date: str, batch_id: str) -> str:
        """Land one batch; a rerun of the batch replaces its own folder only.

        Rows are ordered by change time inside each file, which keeps the
        min/max statistics of `updated_at` narrow for later window scans.
        """
        spec = entity(table)
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.zone_schema])
        folder = self.folder(table, extract_date, batch_id)
        ordered = typed.sortWithinPartitions("updated_at", *spec.key)
        ordered.drop("extract_date", "batch_id").write.mode("overwrite").parquet(folder)
        return folder

    def read(self, folder: str) -> DataFrame:
        """One landed batch; table, date and batch id come from the path and are checked."""
        found = _FOLDER.match(folder)
        if not found:
            raise ValueError(f"not a batch folder <table>/extract_date=YYYY-MM-DD/batch_id=<id>: {folder}")
        return self._read(found["table"], [folder], found["root"])

    def read_table(self, table: str) -> DataFrame:
        """All landed batches of a table."""
        return self._read(table, [f"{self.root}/{table}"], self.root)

    def _read(self, table: str, paths: list[str], root: str) -> DataFrame:
        schema = entity(table).zone_schema
        reader = self.spark.read.schema(schema).option("basePath", f"{root}/{table}")
        return reader.parquet(*paths).select(*schema.names)
