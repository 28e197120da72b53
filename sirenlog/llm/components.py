"""Connected components of an edge table, in rounds of joins.

Alternates two steps until nothing changes: every node's larger neighbours are
tied to its smallest neighbour, then its smaller neighbours to the smallest of
them.  Every round replaces edges by at most as many, is written to the shared
folder and read back, so lineage stays short and a lost executor costs one
round.  Nothing but one checksum row comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sirenlog.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of an edge (``a``, ``b``; longs, not null)."""
    edges = materialize(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges as (larger, smaller): ties each node's larger neighbours to the least of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a")
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(
        least.select("a", F.col("m").alias("b"))).distinct()
