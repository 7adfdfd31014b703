"""Connected components of an undirected edge table (G2), by large-star and small-star rounds.

Every round rewrites edges so that each node points at a smaller neighbour: the large star links a node's
larger neighbours to the node's least neighbour, the small star its smaller ones. Rounds are logarithmic in
the component size. Each round's edges are written to the shared folder, so lineage stays one round deep and
a lost executor costs one round. A star's centre is often hot: its least neighbour is combined before the
shuffle, and reaches the centre's edges by a join that spreads hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.operators.skew import HOT_ROWS, join_unique
from lettermill.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return join_unique(ways.filter("b > a"), least, "a", rows).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return join_unique(down, least, "a", rows).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a != b").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """node, component (its least node) for every node with an edge to another one; loops are ignored."""
    pairs = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).filter("a != b").distinct()
    now = materialize(pairs, "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if state == before:
            break
        before = state
        rows = state[0]  # neither star has more than a row for each edge
        stars = _large_star(now, rows)
        now = materialize(_small_star(stars if rows <= HOT_ROWS else materialize(stars, "stars"), rows), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
