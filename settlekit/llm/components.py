"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum (combined on the map side) and a join back, so
a node with millions of edges is a skewed join and never one group in memory.
Each round's edges are written to the shared folder, which cuts the lineage and
survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.session import drop_tables, stage_table


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a > b) to edges (a > b) of one step."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    joined = both.join(low, both["a"] == low["u"])
    if large:   # the larger neighbours of u are tied to u's smallest
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:       # the smaller neighbours of u, and u, are tied to the smallest
        out = (joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.filter("a <> b").distinct()


def components(links: DataFrame, max_rounds: int = 60, parts: int | None = None) -> DataFrame:
    """(node, component) of every node that has a link; the component is its smallest node.

    ``links`` has long columns a and b in any order; loops and repeats don't matter.
    ``parts`` bounds the files (and last tasks) of a round where the caller knows
    how few links there are.
    """
    def few(df):
        return df if parts is None else df.coalesce(parts)

    edges = stage_table(few(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), "cc")
    seen = _summary(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        old, edges = edges, stage_table(few(_star(_star(edges, True), False)), "cc")
        drop_tables(old)
        now = _summary(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
