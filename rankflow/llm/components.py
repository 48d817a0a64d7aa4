"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.session import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Per linked node: node, root (the least node it can reach; a root itself is not listed).

    Large stars link each node's greater neighbours to the least node around it, small stars
    its lesser ones; both keep components and end in one star a component after a number of
    rounds that grows with the logarithm of its size.  Each round is written to the shared
    folder.  Minima combine before the shuffle; a hub's links are rows that a join can split.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = materialize(edges, "links")
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = edges.join(least, F.col("b") == F.col("u")).select(F.col("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # edges are (greater, lesser): seen from the lesser node, the greater one is the neighbour to relink
        large = materialize(large, "links")
        lowest = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.join(lowest, F.col("a") == F.col("u"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        edges = materialize(small.where("a <> b").distinct(), "links")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
