"""Connected components of a link table, wholly in Spark, and of a few links inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborspark.session import land


def local_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions by links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, a, low)
        np.minimum.at(fresh, b, low)
        np.minimum.at(fresh, label[a], low)
        np.minimum.at(fresh, label[b], low)
        fresh = fresh[fresh]
        if np.array_equal(fresh, label):
            return label
        label = fresh


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that a link names.

    ``links`` has columns ``a, b``.  Alternates the large-star and small-star
    steps: every node passes its smallest neighbour on to its larger, then to
    its smaller neighbours, until only stars are left.  Each round is two joins
    on the node; a node with many links is split by the adaptive join.  Rounds
    grow with the logarithm of the longest chain; each is written to the shared
    folder.  Null ends and self-links are ignored.
    """
    edges = land(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = land(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        edges = land(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.col("m").alias("component")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
