"""Connected components by alternating large-star and small-star steps.

Every step is a map-side combined minimum per node, which is written out, and a join back. Beside a
written table adaptive execution splits the edges of a node with very many neighbours; beside the
aggregate itself, whose shuffle it would share, it does not. The edge list is written to the shared
folder after each round; nothing is collected but two numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v) with the least node among u and its neighbours."""
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    return edges.join(least, "u").withColumn("m", F.least("m", "u"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    rows = _with_least(_both_ways(edges)).where("v > u")
    return rows.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger node u to the smaller v."""
    rows = _with_least(edges.where("v < u"))
    pairs = rows.select(
        F.explode(
            F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            )
        ).alias("e")
    )
    return pairs.select("e.u", "e.v").where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node each linked node can reach.

    ``links`` holds undirected pairs in ``a`` and ``b``; nodes without a link are not returned.
    Null ends and loops are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.where(f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL AND `{a}` <> `{b}`")
    edges = staged(edges.distinct(), "links")
    seen = _mark(edges)
    while seen[0]:
        edges = staged(_small_star(_large_star(edges)), "links")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own)
