"""Parquet tables with atomic replacement of whole partitions.

Plain Parquet tables have no MERGE or DELETE. Every write here puts its files in
a new folder and then publishes a small JSON list that says which folder holds
which partition. A reader resolves that list once; a failed write leaves the
table as it was; and a write touches only the partitions it changes.

    <root>/<table>/_log/000000000003.json
    <root>/<table>/_v=3-1f0c9a/order_date=2025-01-02/part-*.parquet
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.reduce import broadcast_if_small
from tidemark.sources.locator import KeyLocator

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Layout:
    """Partition columns, the columns files are sorted by inside a partition, and
    optionally a timestamp whose greatest value per partition is kept in the list."""

    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    track: str | None = None


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: T.StructType
    layout: Layout
    parts: tuple[tuple[tuple[str, ...], str], ...]  # (partition values as text, relative path)
    tops: Mapping[str, str] = field(default_factory=dict)  # greatest tracked value by relative path


class ConcurrentWrite(RuntimeError):
    pass


class RepeatedKey(ValueError):
    pass


def refuse_repeats(name: str, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice; a key with a NULL equals no other. Keys are counted before they are moved."""
    known = source.select(*keys).dropna(subset=list(keys))
    twice = known.groupBy(*keys).count().where("count > 1").select(*keys).first()
    if twice is not None:
        raise RepeatedKey(f"the source of {name} holds key {tuple(twice)} more than once")


class TableStore:
    """Tables below `root`. With `locate`, upserts into partitioned tables find old copies by a `KeyLocator`."""

    def __init__(self, spark: SparkSession, root: str, locate: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.locate = locate

    # -- file system -----------------------------------------------------------

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _children(self, *names: str) -> list[str]:
        path = self._path(*names)
        fs = self._fs(path)
        if not fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(path))

    # -- snapshots -------------------------------------------------------------

    def versions(self, name: str) -> list[int]:
        return [int(f[:-5]) for f in self._children(name, "_log") if f.endswith(".json")]

    def tables(self) -> list[str]:
        return self._children()

    def exists(self, name: str) -> bool:
        return any(self._list(name, version) is not None for version in reversed(self.versions(name)))

    def snapshot(self, name: str, version: int | None = None) -> Snapshot:
        known = self.versions(name) if version is None else [version]
        data = None
        while data is None:
            if not known:
                raise FileNotFoundError(f"table {name} does not exist below {self.root}")
            version = known.pop()
            data = self._list(name, version)
        return Snapshot(
            version,
            T.StructType.fromJson(data["schema"]),
            Layout(tuple(data["partition_by"]), tuple(data["cluster_by"]), data["track"]),
            tuple((tuple(values), rel) for values, rel in data["parts"]),
            data["tops"],
        )

    def _list(self, name: str, version: int) -> dict | None:
        """The content of a list; None if it is cut short."""
        path = self._path(name, "_log", f"{version:012d}.json")
        stream = self._fs(path).open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return None

    def _publish(self, name: str, snapshot: Snapshot) -> None:
        """Put the finished list in its place; of two writers with the same number one fails."""
        text = json.dumps(
            {
                "schema": snapshot.schema.jsonValue(),
                "partition_by": snapshot.layout.partition_by,
                "cluster_by": snapshot.layout.cluster_by,
                "track": snapshot.layout.track,
                "parts": snapshot.parts,
                "tops": dict(snapshot.tops),
            }
        )
        target = self._path(name, "_log", f"{snapshot.version:012d}.json")
        draft = self._path(name, "_log", f"_{snapshot.version:012d}-{uuid.uuid4().hex}")
        out = self._fs(draft).create(draft, False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        no_options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        context = hadoop.FileContext.getFileContext(target.toUri(), self.spark._jsparkSession.sessionState().newHadoopConf())
        try:
            context.rename(draft, target, no_options)  # never over an existing list
        except Py4JJavaError as problem:
            self._fs(draft).delete(draft, False)
            if "FileAlreadyExists" not in str(problem.java_exception):
                raise
            taken = f"version {snapshot.version} of {name} was published by another writer"
            raise ConcurrentWrite(taken) from problem

    # -- reading ---------------------------------------------------------------

    def _read_parts(self, name: str, snap: Snapshot, parts: Sequence[tuple[tuple[str, ...], str]]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], snap.schema)
        base = f"{self.root}/{name}"
        reader = self.spark.read.schema(snap.schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{rel}" for _, rel in parts]).select(*snap.schema.names)

    def read(self, name: str, version: int | None = None, tracked_from: datetime | None = None) -> DataFrame:
        """The table; with `tracked_from` without the partitions whose tracked values all lie before it.

        Rows before it can still be among the others, so the caller filters all the same.
        """
        snap = self.snapshot(name, version)
        parts = snap.parts
        if tracked_from is not None:
            tops = {rel: datetime.fromisoformat(top) for rel, top in snap.tops.items()}
            parts = [(values, rel) for values, rel in parts if rel not in tops or tops[rel] >= tracked_from]
        return self._read_parts(name, snap, parts)

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def high_water(self, name: str) -> datetime | None:
        """Greatest value of the tracked column, from the list: no data is read."""
        if not self.exists(name):
            return None
        snap = self.snapshot(name)
        if snap.layout.track is None:
            raise ValueError(f"table {name} tracks no column")
        tops = [snap.tops[rel] for _, rel in snap.parts if snap.tops.get(rel)]
        return datetime.fromisoformat(max(tops)) if tops else None

    # -- writing ---------------------------------------------------------------

    def _write_files(self, name: str, df: DataFrame, layout: Layout, version: int) -> list[tuple[tuple[str, ...], str]]:
        """Write `df` to a new folder; return its partitions.

        The rebalance hint lets AQE bring the rows of a partition together while
        it splits a large date over several tasks and merges small ones.
        """
        folder = f"_v={version}-{uuid.uuid4().hex[:6]}"
        out = df
        if layout.partition_by:
            out = out.hint("rebalance", *layout.partition_by)
        order = [*layout.partition_by, *layout.cluster_by]
        if order:
            out = out.sortWithinPartitions(*order)
        writer = out.write.mode("errorifexists").option("compression", "zstd")
        if layout.partition_by:
            writer = writer.partitionBy(*layout.partition_by)
        writer.parquet(f"{self.root}/{name}/{folder}")
        if not layout.partition_by:
            return [((), folder)]
        found: list[tuple[tuple[str, ...], str]] = [((), folder)]
        for column in layout.partition_by:
            deeper = []
            for values, rel in found:
                for child in self._children(name, rel):
                    if child.startswith(f"{column}="):
                        deeper.append(((*values, unquote(child.split("=", 1)[1])), f"{rel}/{child}"))
            found = deeper
        return found

    def _commit(
        self,
        name: str,
        df: DataFrame,
        layout: Layout,
        keep: Callable[[Snapshot, set[tuple[str, ...]]], Sequence[tuple[tuple[str, ...], str]]],
        base: Snapshot | None = None,
    ) -> Snapshot:
        """Write `df` and publish it together with the old partitions `keep` chooses."""
        if base is None and self.exists(name):
            base = self.snapshot(name)
        version = base.version + 1 if base else 1
        if base:
            layout = base.layout
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in base.schema])
        schema = base.schema if base else nullable(df.schema)
        written = self._write_files(name, df, layout, version)
        kept = keep(base, {values for values, _ in written}) if base else []
        tops = self._tops(name, schema, layout, written)
        if base:
            tops |= {rel: base.tops[rel] for _, rel in kept if rel in base.tops}
        snap = Snapshot(version, schema, layout, tuple([*kept, *written]), tops)
        self._publish(name, snap)
        return snap

    def _tops(self, name: str, schema: T.StructType, layout: Layout, written) -> dict[str, str]:
        """Greatest tracked value per written partition: a narrow scan of the new files only."""
        if layout.track is None or not written:
            return {}
        new = self._read_parts(name, Snapshot(0, schema, layout, ()), written)
        grouped = new.groupBy(*partition_text(layout)).agg(
            F.date_format(F.max(layout.track), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("__top")
        )
        found = {tuple(row)[:-1]: row["__top"] for row in grouped.collect()}  # one row per partition
        return {rel: found[values] for values, rel in written if found.get(values)}

    def overwrite(self, name: str, df: DataFrame, layout: Layout = Layout()) -> None:
        """Replace the whole table, its schema and its layout."""
        version = self.snapshot(name).version + 1 if self.exists(name) else 1
        written = self._write_files(name, df, layout, version)
        schema = nullable(df.schema)
        tops = self._tops(name, schema, layout, written)
        self._publish(name, Snapshot(version, schema, layout, tuple(written), tops))

    def append(self, name: str, df: DataFrame, layout: Layout = Layout()) -> None:
        self._commit(name, df, layout, lambda base, _: base.parts)

    def overwrite_partitions(
        self, name: str, df: DataFrame, layout: Layout, clear_range: tuple[str, str] | None = None
    ) -> None:
        """Replace exactly the partitions present in `df`.

        With `clear_range` (inclusive, on the first partition column) partitions
        in the range that `df` no longer fills are dropped as well.
        """

        def keep(base, written):
            def stays(values):
                if values in written:
                    return False
                if clear_range is None or values[0] == NULL_PARTITION:
                    return True
                return not clear_range[0] <= values[0] <= clear_range[1]

            return [part for part in base.parts if stays(part[0])]

        self._commit(name, df, layout, keep)

    def replace_batch(self, name: str, df: DataFrame, batch_id: str, layout: Layout) -> None:
        """Drop every partition of the batch, whatever its other values, and add `df`, in one publish."""
        at = layout.partition_by.index("batch_id")
        self._commit(name, df, layout, lambda base, _: [p for p in base.parts if p[0][at] != batch_id])

    def merge(self, name: str, source: DataFrame, keys: Sequence[str], layout: Layout = Layout()) -> None:
        """Keyed upsert that rewrites only the partitions holding old or new copies of a key.

        The source is written first, so it is computed once and its size is
        known. Old copies are looked for in the key locator or, in a store without, by a semi join that
        reads the key columns alone and, for a source small enough to broadcast, moves no row
        of the table. When the partition columns are part of the key, old copies
        can only be in the source's own partitions and the search is left out. Partitions a key has left
        and that become empty disappear from the table. A source that names a key twice is
        refused, as there is no telling which row should stay.
        """
        staged_path = f"{self.root}/{name}/_staged-{uuid.uuid4().hex[:12]}"
        base = self.snapshot(name) if self.exists(name) else None
        try:
            if base is not None:
                source = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in base.schema])
            source.write.parquet(staged_path)
            staged = self.spark.read.schema(nullable(source.schema)).parquet(staged_path)
            refuse_repeats(name, staged, keys)
            if base is None:
                snap = self._commit(name, staged, layout, lambda base, _: ())
                if self._located(snap.layout, keys):
                    locator = KeyLocator(self, name, snap, keys)
                    locator.build(locator.pairs(staged))
                    locator.covers(snap.version)
            else:
                self._merge_staged(name, base, staged, keys)
        finally:
            path = self._path(name, staged_path.rsplit("/", 1)[1])
            self._fs(path).delete(path, True)

    def _located(self, layout: Layout, keys: Sequence[str]) -> bool:
        return self.locate and bool(layout.partition_by) and not set(layout.partition_by) <= set(keys)

    def _merge_staged(self, name: str, base: Snapshot, staged: DataFrame, keys: Sequence[str]) -> None:
        layout = base.layout
        rows = staged.count()  # from file footers
        new_keys = broadcast_if_small(staged.select(*keys), rows)
        if not layout.partition_by:
            old = self._read_parts(name, base, base.parts)
            merged = old.join(new_keys, list(keys), "left_anti").select(*base.schema.names)
            self._commit(name, merged.unionByName(staged), layout, lambda *_: (), base)
            return
        touched = partition_values(staged, layout)
        locator = KeyLocator(self, name, base, keys) if self._located(layout, keys) else None
        if locator:
            locator.ready()
            touched |= locator.find(staged, rows)
            locator.add(locator.pairs(staged))
        elif not set(layout.partition_by) <= set(keys):
            whole = self._read_parts(name, base, base.parts).select(*keys, *layout.partition_by)
            matching = whole.join(new_keys, list(keys), "left_semi")
            touched |= partition_values(matching, layout)
        rewritten = [p for p in base.parts if p[0] in touched]
        untouched = [p for p in base.parts if p[0] not in touched]
        old = self._read_parts(name, base, rewritten)
        merged = old.join(new_keys, list(keys), "left_anti").select(*base.schema.names)
        snap = self._commit(name, merged.unionByName(staged), layout, lambda *_: untouched, base)
        if locator:
            locator.covers(snap.version)

    def expire(self, name: str, keep_versions: int = 2) -> None:
        """Delete lists older than the last `keep_versions` and the folders only they use."""
        known = [v for v in self.versions(name) if self._list(name, v) is not None]
        live = {rel.split("/")[0] for v in known[-keep_versions:] for _, rel in self.snapshot(name, v).parts}
        partly = {rel for v in known[-keep_versions:] for _, rel in self.snapshot(name, v).parts}
        for version in known[:-keep_versions]:
            for _, rel in self.snapshot(name, version).parts:
                gone = rel.split("/")[0] if rel.split("/")[0] not in live else rel
                if gone not in partly:
                    path = self._path(name, gone)
                    self._fs(path).delete(path, True)
            path = self._path(name, "_log", f"{version:012d}.json")
            self._fs(path).delete(path, False)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def partition_text(layout: Layout) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION)).alias(c) for c in layout.partition_by]


def partition_values(df: DataFrame, layout: Layout) -> set[tuple[str, ...]]:
    """Distinct partition values as path text; their number is that of the table's partitions."""
    return {tuple(row) for row in df.select(*partition_text(layout)).distinct().collect()}
