"""Connected components of a large graph, by rounds of joins (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.llm.common import fresh_key
from logforge.session import staged


def _with_least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``least`` (u, m): the smallest neighbour of u; edges (u, v, m) with that joined on."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    keyed = least.select(fresh_key(F.col("u")).alias("k"), "m")
    return least, edges.join(keyed, edges["u"] == keyed["k"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    _, met = _with_least(both)
    return met.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger to the smaller end."""
    least, met = _with_least(edges)
    return (
        met.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v"))).distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge but the roots; root is the smallest node.

    ``edges`` has the long columns u, v. Each round keeps at most one edge more per node
    than it has and moves minima along keys only, so no neighbourhood is gathered; the
    number of rounds grows with the logarithm of the longest path. Each round is written
    to the shared folder, which also ends its lineage.
    """
    edges = edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    edges, before = staged(edges, "edges"), None
    while True:
        digest = edges.agg(
            F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))
        ).first()
        if digest == before or digest[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = digest
        edges = staged(_small_star(_large_star(edges)), "edges")
