"""Connected components of a large graph, by alternating large-star and small-star steps.

Each round points the neighbours of every node to the smallest one nearby, first upward,
then downward, until every component is a star around its smallest node. Rounds grow with
the logarithm of a component's diameter. A node with very many neighbours is only a hot
join key beside a written table of unique keys, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60


def _star(edges: DataFrame, store, name: str) -> DataFrame:
    """One large-star and one small-star step over edges (a, b) with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = store.keep(least.select("a", F.least("a", "m").alias("m")), f"{name}-large")
    large = (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).unionByName(least.where("a <> m").select("a", F.col("m").alias("b")))
    large = store.keep(large.distinct(), f"{name}-up")
    lowest = store.keep(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-small")
    small = (
        large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).unionByName(lowest.select("a", F.col("m").alias("b")))
    return store.keep(small.distinct(), f"{name}-down")


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def components(edges: DataFrame, store) -> DataFrame:
    """``a, root`` for every node of ``edges`` (long a, b) but the roots themselves.

    Loops and repeated edges are ignored; an empty graph gives no rows.
    """
    now = store.keep(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _state(now)
    for at in range(MAX_ROUNDS):
        if not before[0]:
            break
        now = _star(now, store, f"round{at}")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select("a", F.col("b").alias("root"))
