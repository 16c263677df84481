"""Keyed upsert as a pure DataFrame operation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the source rows inserted, or put in place of rows of equal key.

    A NULL key equals nothing: such target rows stay and such source rows are
    added. A key that the source holds twice raises when the result is computed.
    The target side is the left side of the anti join, so AQE can split it when
    it is skewed, and a small source is broadcast by its measured size.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    copies = F.count("*").over(Window.partitionBy(*keys))
    refused = F.raise_error(F.concat(F.lit("the source holds a key more than once: "), F.to_json(F.struct(*keys))))
    once = source.where(~no_key).withColumn("__copies", copies)
    once = once.where(F.when(F.col("__copies") == 1, True).otherwise(refused.cast("boolean"))).drop("__copies")
    added = once.unionByName(source.where(no_key))
    return kept.select(*target.columns).unionByName(added.select(*target.columns))
