"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014) on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, salted_join, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the smallest of them and itself: the larger ones (large) or the smaller ones."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    kept = salted_join(both, least, ["a"], F.xxhash64("b")) if large else both.join(least, "a")
    if large:
        out = kept.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = kept.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of links(a, b): component is the smallest node that it reaches.

    Loops, repeated and reversed links don't matter; links with a null end are ignored; no links give no rows.
    Nodes need one orderable type. Every round is written to the shared folder; only a checksum reaches the driver.
    """
    spark = links.sparkSession
    edges = written(
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(rounds):
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if not state["n"] or (state["n"], state["x"]) == seen:
            break
        seen = (state["n"], state["x"])
        after = written(_star(_star(edges, True), False), "edges")
        remove(spark, edges)
        edges = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
