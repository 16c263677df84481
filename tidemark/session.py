"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

# Settings results depend on: timestamps are UTC, and partition values keep the
# type of the declared schema (a numeric-looking batch id stays a string).
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings that only steer the physical plan. Broadcasting is left to the size
# check of AQE; no operator forces it on a table that can grow.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; on a cluster leave `master` unset.

    At large scale set `shuffle_partitions` so that one partition of the widest
    shuffle stays near 128 MB; AQE merges the small ones again.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    tidy = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    conf = {**RESULT_CONF, **PLAN_CONF, **tidy, **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_result_settings(spark: SparkSession) -> None:
    """Apply the settings results depend on to a session somebody else made."""
    for name, value in RESULT_CONF.items():
        spark.conf.set(name, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; with a local master that names none, one folder per application in the warehouse."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    scratch = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{context.applicationId}"
    context.setCheckpointDir(scratch)
    if scratch.startswith(("file:", "/")):
        atexit.register(shutil.rmtree, urlparse(scratch).path, ignore_errors=True)
    return context.getCheckpointDir().rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from the files.

    Used where a value must not change when a lost executor makes Spark compute
    it again, such as a range-partition number.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """Write `df` to the shared folder as Parquet and go on from the files."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
