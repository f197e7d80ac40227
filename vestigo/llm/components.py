"""Connected components of a link table, all in DataFrames.

Alternates large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"), each an aggregation and a join, until
the edges no longer change. Minima are pre-aggregated, and joins on a hub's id
are plain shuffled joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise


def _edges(df: DataFrame) -> DataFrame:
    a, b = F.greatest("a", "b"), F.least("a", "b")
    return df.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select("b", "m").unionAll(least.select("a", "m")).toDF("a", "b")


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a hash of them: equal states mean the edges are the same."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(2**31)))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b) but the smallest ones."""
    edges = materialise(_edges(links), "edges")
    before = _state(edges)
    while before[0]:
        edges = materialise(_edges(_small_star(_edges(_large_star(edges)))), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
