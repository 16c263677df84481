"""As-of lookup: the version of a key that was valid at a given time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.hotkeys import CHUNK, PLACE, in_order, keys_above, lead_within_key, ordered_chunks
from tidemark.operators.reduce import broadcast_if_small
from tidemark.session import durable, stored

HOT_VERSIONS = 10_000
SPAN = 256  # elementary intervals in a segment


def _interval_join(probe, versions, key, probe_ts, payload, how):
    match = (
        (F.col(key) == F.col("__key"))
        & (F.col(probe_ts) >= F.col("__from"))
        & (F.col(probe_ts) < F.col("__to"))
    )
    return probe.join(versions, match, how).select(*probe.columns, *payload)


def _as_in(probe):
    """The columns of the probe in its types; a union with the versions may have widened the key."""
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in probe.schema]


def _kept(df, purpose):
    """`df` from files; Parquet, which is several times smaller than a checkpoint, where it has the types."""
    other = any(t in df.schema.simpleString() for t in ("void", "interval"))
    return durable(df) if other else stored(df, purpose)


def _window_lookup(probe, versions, key, probe_ts, payload, how):
    """Sort-based lookup for keys whose version intervals do not overlap and whose versions and probe rows fit in one chunk.

    Probe rows and versions move once, by key; the last version start at or before a time is its candidate.
    """
    packed = F.struct("__from", "__to", *payload)
    marks = versions.select(F.col("__key").alias(key), F.col("__from").alias("__at"), F.lit(0).alias("__kind"), packed.alias("__version"))
    asked = probe.withColumns({"__at": F.col(probe_ts), "__kind": F.lit(1)})
    inside = Window.partitionBy(key).orderBy("__at", "__kind")
    seen = asked.unionByName(marks, allowMissingColumns=True).withColumn("__hit", F.last("__version", ignorenulls=True).over(inside))
    hit = F.col("__at") < F.col("__hit.__to")
    found = seen.where("__kind = 1")
    if how == "inner":
        found = found.where(hit)
    return found.select(*_as_in(probe), *[F.when(hit, F.col(f"__hit.{name}")).alias(name) for name in payload])


def _micros(time):
    return F.unix_micros(F.col(time).cast("timestamp"))


def _bucket_lookup(probe, versions, key, probe_ts, payload, how):
    """Lookup for keys whose version intervals overlap and whose versions fit in one chunk.

    The time line is cut into equal buckets at levels of doubling width. A version is listed at the level of its own length, in the
    one or two buckets it lies in (a third where the length is rounded); a probe row looks in its bucket of every level its
    key has. At worst a probe row is compared with the versions of its key, of which there are no more than a chunk.
    """
    length = F.greatest(F.col("__until") - F.col("__since"), F.lit(1).cast("long"))
    timed = versions.withColumns({"__since": _micros("__from"), "__until": _micros("__to")})
    leveled = timed.withColumn("__level", F.greatest(F.ceil(F.log2(length)).cast("int"), F.lit(0)))
    buckets = F.expr("sequence(shiftright(__since, __level), shiftright(greatest(__until - 1, __since), __level))")
    listed = leveled.select(F.col("__key").alias("v__key"), "__level", F.explode(buckets).alias("__bucket"), "__from", "__to", *payload)
    levels = leveled.groupBy(F.col("__key").alias("l__key")).agg(F.collect_set("__level").alias("__levels"))
    looked = probe.join(levels, F.col(key) == F.col("l__key")).withColumn("__level", F.explode("__levels"))
    looked = looked.withColumn("__bucket", F.expr(f"shiftright(unix_micros(cast(`{probe_ts}` as timestamp)), __level)"))
    looked = looked.toDF(*(f"p{c}" if c in ("__level", "__bucket") else c for c in looked.columns))
    match = (
        (F.col(key) == F.col("v__key"))
        & (F.col("p__level") == F.col("__level"))
        & (F.col("p__bucket") == F.col("__bucket"))
        & (F.col(probe_ts) >= F.col("__from"))
        & (F.col(probe_ts) < F.col("__to"))
    )
    found = looked.join(listed, match).select(*probe.columns, *payload)
    if how == "inner":
        return found
    # A probe row has no version if the greatest end of those that start at or before it does not lie behind it.
    marks = versions.select(F.col("__key").alias(key), F.col("__from").alias("__at"), F.lit(0).alias("__kind"), "__to")
    asked = probe.withColumns({"__at": F.col(probe_ts), "__kind": F.lit(1)})
    open_until = F.max("__to").over(Window.partitionBy(key).orderBy("__at", "__kind"))
    reached = asked.unionByName(marks, allowMissingColumns=True).withColumn("__reach", open_until)
    missed = reached.where((F.col("__kind") == 1) & ~F.coalesce(F.col("__reach") > F.col("__at"), F.lit(False)))
    return found.unionByName(missed.select(*_as_in(probe)), allowMissingColumns=True)


def _overlapping(versions, chunk_rows):
    """Distinct keys (__key) of which two versions overlap.

    Where the lengths of a key's versions add up to more than the time from its first start to its last end, two must
    overlap; the sums are doubles, so a small excess is left to the other keys' way, the order of the starts.
    """
    length = (_micros("__to") - _micros("__from")).cast("double")
    reach = (F.max(_micros("__to")) - F.min(_micros("__from"))).cast("double")
    sums = durable(versions.groupBy("__key").agg((F.sum(length) > reach * 1.001).alias("__sure")))
    rest = versions.join(sums.where("not __sure"), "__key", "left_semi").select("__key", "__from", "__to")
    stepped = lead_within_key(rest, "__key", ["__from"], "__from", "__next", chunk_rows=chunk_rows)
    found = stepped.where(F.col("__next") < F.col("__to")).select("__key").distinct()
    return found.unionByName(sums.where("__sure").select("__key"))


def _chunked_lookup(probe, versions, key, probe_ts, payload, how, chunk_rows):
    """Sort-based lookup for keys whose version intervals do not overlap.

    Distinct (key, time) pairs and version starts are put in one order and cut
    into chunks; the last version start at or before a time is its candidate.
    """
    packed = F.struct("__from", "__to", *payload)
    marks = versions.select("__key", F.col("__from").alias("__at"), F.lit(0).alias("__kind"), packed.alias("__version"))
    times = probe.select(F.col(key).alias("__key"), F.col(probe_ts).alias("__at")).where("__at is not null").distinct()
    line = marks.unionByName(times.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    # Without the distinct, which would be run for the count alone.
    total = versions.count() + probe.count()
    chunks = ordered_chunks(line, "__key", ["__at", "__kind"], chunk_rows, total)
    across = Window.partitionBy("__key").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        chunks.groupBy("__key", CHUNK)
        .agg(F.max_by("__version", F.when(F.col("__kind") == 0, F.col("__at"))).alias("__tail"))
        .select("__key", CHUNK, F.last("__tail", ignorenulls=True).over(across).alias("__carry"))
    )
    inside = Window.partitionBy("__key", CHUNK).orderBy("__at", "__kind")
    found = (
        chunks.withColumn("__seen", F.last("__version", ignorenulls=True).over(inside))
        .where("__kind = 1")
        .join(carried, ["__key", CHUNK], "left")
        .withColumn("__hit", F.coalesce("__seen", "__carry"))
        .where(F.col("__at") < F.col("__hit.__to"))
        .select("__key", "__at", "__hit")
    )
    match = (F.col(key) == F.col("__key")) & (F.col(probe_ts) == F.col("__at"))
    hits = [F.col(f"__hit.{name}").alias(name) for name in payload]
    return probe.join(found, match, how).select(*probe.columns, *hits)


def _segments(versions, chunk_rows, span):
    """The time line of each key in segments (__key, __from, __to, __segment) of `span` elementary intervals.

    All start and end points of a key's versions cut its time into elementary intervals, in each of which the set of open
    versions is the same. The points are put in one order by range partitioning, so no key meets in one task;
    every `span`-th point of a partition begins a segment, and so does a key. Segments of a key are numbered from 1.
    """
    points = versions.select("__key", F.explode(F.array("__from", "__to")).alias("__at")).where("__at is not null").distinct()
    line = in_order(points, "__key", ["__at"], chunk_rows, 2 * versions.count())
    # The first point of a key, of a partition, and every `span`-th of a partition.
    first = versions.groupBy("__key").agg(F.min("__from").alias("__at"))
    counted = line.where(F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1)) % span == 0).select("__key", "__at")
    starts = counted.unionByName(first).distinct()
    # One row in `span` points, or one per key and chunk, is left.
    along = Window.partitionBy("__key").orderBy("__at")
    numbered = starts.select(
        "__key", F.col("__at").alias("__from"), F.lead("__at").over(along).alias("__next"), F.row_number().over(along).alias("__segment")
    )
    last = numbered.groupBy("__key").agg(F.max("__from").alias("__last"))
    ends = versions.groupBy("__key").agg(F.max("__to").alias("__end")).join(last, "__key")
    return durable(numbered.join(ends, "__key").select("__key", "__from", F.coalesce("__next", "__end").alias("__to"), "__segment").where("__from < __to"))


def _segment_lookup(probe, versions, key, probe_ts, payload, how, chunk_rows, span):
    """Lookup for keys with very many versions whose intervals overlap.

    A version is listed under every segment it is open in, so what is open at the start of a segment is carried over the
    cut; a probe row is compared with the versions of its own segment alone. A long dirty interval costs one row per segment
    and no longer one comparison with every version of the key.
    """
    segments = _segments(versions, chunk_rows, span)
    numbers = {"__key": F.col("__key"), "__from": F.col("__from"), "__to": F.col("__to"), "__segment": F.col("__segment")}
    parts = segments.select(*(c.alias(n) for n, c in numbers.items()))

    def segment_of(rows, own_key, at, name):
        found = _chunked_lookup(rows, parts, own_key, at, ["__segment"], "left", chunk_rows)
        return found.withColumnRenamed("__segment", name)

    open_ = versions.toDF(*(f"v{c}" if c in ("__key", "__from", "__to") else c for c in versions.columns))
    first = segment_of(open_, "v__key", "v__from", "__first")
    both = segment_of(first, "v__key", "v__to", "__last")
    # The end is not part of a version; the end of the key's last version is in no segment.
    starts = parts.select(F.col("__key").alias("s__key"), F.col("__segment").alias("__last"), F.col("__from").alias("s__from"))
    top = parts.groupBy(F.col("__key").alias("t__key")).agg(F.max("__segment").alias("__top"))
    reach = both.join(starts, (F.col("v__key") == F.col("s__key")) & (both["__last"] == starts["__last"]), "left").drop(starts["__last"])
    reach = reach.join(top, F.col("v__key") == F.col("t__key"))
    until = F.when(F.col("__last").isNull(), F.col("__top")).when(F.col("s__from") == F.col("v__to"), F.col("__last") - 1).otherwise(F.col("__last"))
    listed = reach.withColumn("v__segment", F.explode(F.sequence("__first", until)))
    listed = listed.select("v__key", "v__segment", "v__from", "v__to", *payload)
    placed = segment_of(probe, key, probe_ts, "__segment")
    match = (
        (F.col(key) == F.col("v__key"))
        & (F.col("__segment") == F.col("v__segment"))
        & (F.col(probe_ts) >= F.col("v__from"))
        & (F.col(probe_ts) < F.col("v__to"))
    )
    return placed.join(listed, match, how).select(*probe.columns, *payload)


def asof_join(
    probe: DataFrame,
    dim: DataFrame,
    key: str,
    probe_ts: str,
    payload: Mapping[str, str],
    start: str = "effective_from",
    end: str = "effective_to",
    how: str = "left",
    hot_versions: int | None = HOT_VERSIONS,
    chunk_rows: int = 1_000_000,
    span: int = SPAN,
) -> DataFrame:
    """Add dimension columns valid at `probe_ts`: `start <= t < end`, same key.

    `payload` maps dimension columns to the names they get. The common plan is
    one equi join with the interval as residual condition: AQE broadcasts the
    dimension when its measured size allows and splits hot probe keys
    otherwise. A key with more than `hot_versions` versions would compare each
    probe row with all of them, so such keys go through a sort-based lookup
    instead, with one candidate per probe row, where a key's intervals do not overlap, and where they do through
    parts of its time line: buckets by the lengths of the versions, or segments if the versions are more than
    `chunk_rows`. A key whose rows fit in one chunk is not cut. The result is the same on every way.
    """
    if how not in ("left", "inner"):
        raise ValueError("asof_join supports left and inner")
    names = list(payload.values())
    versions = dim.select(
        F.col(key).alias("__key"),
        F.col(start).alias("__from"),
        F.col(end).alias("__to"),
        *[F.col(c).alias(a) for c, a in payload.items()],
    ).where(F.col("__from") < F.col("__to"))
    if hot_versions is None:
        return _interval_join(probe, versions, key, probe_ts, names, how)
    hot = keys_above(versions, "__key", hot_versions).select("__key")
    if hot.isEmpty():
        return _interval_join(probe, versions, key, probe_ts, names, how)

    hot = durable(hot)
    few = broadcast_if_small(hot.withColumnRenamed("__key", "__hot"), hot.count())
    # Each is read several times below, and may be the result of joins.
    versions = _kept(versions.join(few, F.col("__key") == F.col("__hot"), "left").withColumn("__hot", F.col("__hot").isNotNull()), "asof-versions")
    marked = _kept(probe.join(few, probe[key] == few["__hot"], "left").withColumn("__hot", F.col("__hot").isNotNull()), "asof-probes")
    cold, asked = (marked.where(c).drop("__hot") for c in ("not __hot", "__hot"))
    found = _interval_join(cold, versions.where("not __hot").drop("__hot"), key, probe_ts, names, how)

    own = versions.where("__hot").drop("__hot")
    rows = asked.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("__asked"))
    few_rows = own.groupBy("__key").agg((F.count("*") <= chunk_rows).alias("__few"), F.count("*").alias("__rows"))
    overlapping = _overlapping(own, chunk_rows).withColumn("__crossed", F.lit(True))
    # A key without probe rows has nothing to look up.
    both = few_rows.join(rows, "__key").join(overlapping, "__key", "left")
    crossed = F.when(F.col("__few"), "buckets").otherwise("segments")
    plain = F.when(F.col("__rows") + F.col("__asked") <= chunk_rows, "window").otherwise("chunks")
    ways = durable(both.select("__key", F.when(F.col("__crossed"), crossed).otherwise(plain).alias("__way")))
    present = {r["__way"]: r["n"] for r in ways.groupBy("__way").agg(F.count("*").alias("n")).collect()}
    lookups = {
        "window": _window_lookup,
        "buckets": _bucket_lookup,
        "chunks": lambda *args: _chunked_lookup(*args, chunk_rows),
        "segments": lambda *args: _segment_lookup(*args, chunk_rows, span),
    }
    for way, count in present.items():
        mine, dims = asked, own
        if len(present) > 1:
            chosen = broadcast_if_small(ways.where(F.col("__way") == way).select("__key"), count)
            mine = asked.join(chosen, asked[key] == chosen["__key"], "left_semi")
            dims = own.join(chosen, "__key", "left_semi")
        found = found.unionByName(lookups[way](mine, dims, key, probe_ts, names, how))
    return found
