"""Connected components of an edge table, by alternating large and small stars.

Each round lets every node tell its larger neighbours (large star) and then its
smaller ones (small star) about the smallest node it knows, until every node
points at its component's smallest node. The edge count never grows and rounds
grow with the logarithm of the longest path.

Scale: a hub may hold any share of the edges. Its minimum is pre-aggregated in
the map tasks, and the join that hands the minimum back can be split by adaptive
execution, as no row needs the hub's other neighbours. Nothing but a count and a
checksum per round reaches the driver, and each round is written to the shared
folder, so a lost executor never costs more than one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import materialize


def _with_smallest(edges: DataFrame, name: str) -> DataFrame:
    """Edges (u, v) -> (u, v, m): m is the smallest of u and its v. The minima are written before they are joined:
    a join with an aggregate cannot be split where a node is a hub."""
    smallest = materialize(edges.groupBy("u").agg(F.min("v").alias("n")).select(
        F.col("u").alias("u2"), F.least("u", "n").alias("m")), name)
    return edges.join(smallest, F.col("u") == F.col("u2")).select("u", "v", "m")


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both, f"{name}-large").where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    """Expects u > v."""
    seen = _with_smallest(edges, f"{name}-small")
    own = seen.select("u", F.col("m").alias("v"))
    others = seen.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(others).distinct()


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 100) -> DataFrame:
    """Edges (u, v), in any direction -> (node, component): the smallest node reachable, for every node with an edge.

    Self-loops, repeated edges and nulls are ignored: a node without another
    neighbour has no row. Raises if ``max_rounds`` are not enough, rather than
    return an unfinished labelling.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, f"{name}-edges")
    last = None
    for k in range(max_rounds):
        edges = materialize(_large_star(edges, f"{name}-{k}"), f"{name}-{k}-mid")
        edges = materialize(_small_star(edges, f"{name}-{k}"), f"{name}-{k}")
        # A checksum as a decimal: it can't overflow.
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
