"""Connected components of an edge table, wholly in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, remove

_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, root): the smallest node reachable, for every node on an edge.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): every round replaces each node's neighbours by a
    star around the smallest, so that chains shrink by a constant factor and no node's neighbourhood is ever gathered;
    minima are aggregated before the shuffle. Every round is written to the shared folder. Ends when a round changes
    nothing.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    was = _state(now)
    for _ in range(_ROUNDS):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # minima are written before they are joined: both sides are then plain shuffles, which Spark splits at a hub
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialise(large, "large")
        remove(least)
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        new = materialise(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "small")
        for done in (least, large, now):
            remove(done)
        now, is_now = new, _state(new)
        if is_now == was:
            break
        was = is_now
    else:
        raise RuntimeError("connected components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
