"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, both over tables written to the shared
folder: a lost executor recomputes from files, and adaptive execution can split the
join for a node with very many links. Nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_files


def _join_minimum(pairs: DataFrame, rows: int, purpose: str) -> DataFrame:
    """(a, b) rows with m, the smallest of a and all b of the same a."""
    least = pairs.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("m"))
    return pairs.join(in_files(least, rows, purpose), "a")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (stored; columns a, b of type long); root is the smallest node reachable.

    Loops and repeated links are allowed; an empty table gives an empty result.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    rows = 2 * links.count()  # no table below has more
    now = in_files(ordered, rows, "links")
    before = None
    state = _state(now)
    while state != before:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _join_minimum(both, rows, "large-min").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = in_files(large.distinct(), rows, "large-star")
        small = _join_minimum(large, rows, "small-min")
        pulled = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            small.select("a", F.col("m").alias("b"))
        )
        now = in_files(pulled.where("a <> b").distinct(), rows, "small-star")
        before, state = state, _state(now)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
