"""Connected components of a link table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import discard, stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link to another; the component is its smallest node.

    Alternates two star steps until nothing changes: every node's larger neighbours move to its smallest neighbour, then its smaller ones do.
    A node with a third of all links is aggregated before the shuffle and its join is split by adaptive execution. The links of each
    round are stored, so an executor may be lost at any time. An empty table gives an empty one.
    """
    edges = stored(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct(), "links")
    before = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("lo"), F.least("hi", "m").alias("m"))
        large = edges.join(least, "lo").select("hi", F.col("m").alias("lo")).where("hi <> lo").distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(smallest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        new = stored(moved.unionByName(smallest.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        now = _mark(new)
        discard(edges)
        edges = new
        if now == before:
            break
        before = now
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
