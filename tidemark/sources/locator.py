"""Where the rows of a key lie: a bucketed table of keys and partitions kept beside a stored table.

An upsert has to find the old copies of its keys. Scanning the key columns of the whole table does that at a cost
that grows with the table; the locator answers it from (key, partition) pairs that are bucketed and sorted by key. It
may name partitions a key has left since, which are then opened for nothing, but never misses one: pairs are added
before the table's new version is published. It says which version it covers; after a write that went past it, it is built again from
the key columns. Pairs of many batches are merged into one sorted file per bucket from time to time.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tidemark.sources.store import Snapshot, TableStore

FEW_KEYS = 1000  # so many are put into the scan as values, which prunes buckets and row groups
MOST_BATCHES = 16
_COVERS = "_covers-"


class KeyLocator:
    """The locator of one table for one key. `name` is the table's; keys with a NULL are in no locator, as they equal none."""

    def __init__(self, store: TableStore, name: str, base: Snapshot, keys: Sequence[str]):
        self.store, self.name, self.base, self.keys = store, name, base, list(keys)
        self.parts = [f"__at_{c}" for c in base.layout.partition_by]
        self.home = "_keys-" + "-".join(keys)
        self.folder: str | None = None
        self.buckets = 0

    def _open(self, folder: str) -> None:
        """Use the folder; its name carries the bucket count, so a session with other settings reads it right."""
        self.folder, self.buckets = folder, int(re.match(r"b(\d+)-", folder)[1])
        path = f"{self.store.root}/{self.name}/{self.home}/{folder}"
        self.table = "keys_" + hashlib.md5(path.encode()).hexdigest()
        types = {f.name: f.dataType.simpleString() for f in self.base.schema}
        columns = [f"`{k}` {types[k]}" for k in self.keys] + [f"`{p}` string" for p in self.parts]
        by = ", ".join(f"`{k}`" for k in self.keys)
        self.store.spark.sql(
            f"create table if not exists {self.table} ({', '.join(columns)}) using parquet "
            f"clustered by ({by}) sorted by ({by}) into {self.buckets} buckets location '{path}'"
        )

    def _covered(self, folder: str) -> list[int]:
        return [int(f.removeprefix(_COVERS)) for f in self.store._children(self.name, self.home, folder) if f.startswith(_COVERS)]

    def pairs(self, rows: DataFrame) -> DataFrame:
        """The distinct (key, partition) pairs of rows of the table."""
        at = [F.col(c).cast("string").alias(p) for c, p in zip(self.base.layout.partition_by, self.parts)]
        return rows.dropna(subset=self.keys).select(*self.keys, *at).distinct()

    def build(self, pairs: DataFrame) -> None:
        """A new locator of these pairs. The old ones go, but not while this session may still read them."""
        buckets = int(self.store.spark.conf.get("spark.sql.shuffle.partitions"))
        self._open(f"b{buckets}-{uuid.uuid4().hex[:8]}")
        self.add(pairs)

    def add(self, pairs: DataFrame) -> None:
        """Append pairs, one sorted file for every bucket they fall into."""
        dealt = pairs.repartition(self.buckets, *self.keys).sortWithinPartitions(*self.keys)
        dealt.write.insertInto(self.table)
        self.store.spark.catalog.refreshTable(self.table)

    def ready(self) -> None:
        """Open the locator that covers the base version; without one read the keys of the whole table once."""
        folders = self.store._children(self.name, self.home)
        for folder in folders:
            covered = self._covered(folder)
            if self.base.version in covered:
                self._open(folder)
                if len(covered) >= MOST_BATCHES:
                    whole = self.store.spark.table(self.table).distinct()
                    self.build(whole)
                break
        else:
            self.build(self.pairs(self.store._read_parts(self.name, self.base, self.base.parts)))
        for folder in folders:
            if folder != self.folder:
                path = self.store._path(self.name, self.home, folder)
                self.store._fs(path).delete(path, True)

    def covers(self, version: int) -> None:
        """Note that the pairs are complete for this version of the table."""
        path = self.store._path(self.name, self.home, self.folder, f"{_COVERS}{version:012d}")
        self.store._fs(path).create(path, True).close()

    def find(self, wanted: DataFrame, rows: int) -> set[tuple[str, ...]]:
        """The partitions that may hold one of the `wanted` keys; their number is that of the table's partitions."""
        pairs = self.store.spark.table(self.table)
        if len(self.keys) == 1 and rows <= FEW_KEYS:
            (key,) = self.keys
            met = pairs.where(F.col(key).isin([r[0] for r in wanted.select(key).dropna().collect()]))
        else:
            met = pairs.join(wanted.select(*self.keys).hint("merge"), self.keys, "left_semi")
        from tidemark.sources.store import NULL_PARTITION

        at = [F.coalesce(p, F.lit(NULL_PARTITION)).alias(p) for p in self.parts]
        return {tuple(r) for r in met.select(*at).distinct().collect()}
