"""Connected components of a graph given as a table of links, by rounds of star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plycask.llm.scratch import Scratch


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).head()
    return row.n, row.x


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) for every node of the links (a, b): the label is the component's smallest node.

    Every round points each node's larger neighbours, then its smaller ones, at the smallest node around
    it; the number of rounds grows with the logarithm of the largest component.  Minima are written as
    tables of their own, so that the joins with them have plain shuffles on both sides and the rows of a
    node with very many links can be split.
    """
    forward = links.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct()
    edges = scratch.save(forward, f"{name}-links")
    before, rounds = _fingerprint(edges), 0
    while before[0]:
        # Larger neighbours v of u get the smallest of u and all of its neighbours.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"{name}-large{rounds}")
        wide = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        wide = scratch.save(wide, f"{name}-wide{rounds}")
        # Smaller neighbours v of u, and u itself, get the smallest of them.
        least = scratch.save(wide.groupBy("u").agg(F.min("v").alias("m")), f"{name}-small{rounds}")
        near = wide.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = scratch.save(near, f"{name}-near{rounds}")
        after = _fingerprint(edges)
        for old in [f"{name}-large{rounds}", f"{name}-wide{rounds}", f"{name}-small{rounds}", f"{name}-near{rounds - 1}" if rounds else f"{name}-links"]:
            scratch.drop(old)
        rounds += 1
        if after == before:
            break
        before = after
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(tops)
