"""Where extraction reads from: a database over JDBC, or Parquet copies of its tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import extract_window
from tidemark.schemas import entity


@dataclass(frozen=True)
class SourceFiles:
    """Source tables as Parquet folders `<root>/<table>`."""

    root: str

    def window(self, spark: SparkSession, table: str, lower: datetime, upper: datetime) -> DataFrame:
        schema = entity(table).source_schema
        return extract_window(spark.read.schema(schema).parquet(f"{self.root}/{table}"), "updated_at", lower, upper)


@dataclass(frozen=True)
class SourceDatabase:
    """Source tables behind JDBC; the driver jar must be on the class path.

    The read is cut into `slices` remainders of the key, which are even however
    the change times are spread, so as many executors read at the same time and
    none reads the whole window. The time bounds are part of every slice.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    slices: int = 16
    fetch_rows: int = 10_000  # rows a driver brings over at a time; some would bring all, others one by one

    def predicates(self, table: str, lower: datetime, upper: datetime) -> list[str]:
        if lower >= upper:
            raise ValueError(f"the window start {lower} must be earlier than its end {upper}")
        key = entity(table).key[-1]
        window = f"updated_at > timestamp '{lower}' and updated_at <= timestamp '{upper}'"
        return [f"{window} and abs(mod({key}, {self.slices})) = {i}" for i in range(self.slices)]

    def window(self, spark: SparkSession, table: str, lower: datetime, upper: datetime) -> DataFrame:
        spec = entity(table)
        properties = {"fetchsize": str(self.fetch_rows), **self.properties}
        df = spark.read.jdbc(
            self.url, f'"{spec.name}"', predicates=self.predicates(table, lower, upper), properties=properties
        )
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.source_schema])
