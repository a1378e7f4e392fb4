"""Connected components of an edge table: alternating large-star and small-star rounds.

Each round is two joins and two aggregates. A node with very many edges is never gathered: its smallest
neighbour comes from a map-side combined aggregate, and the join on a hot node may be split by Spark.
Every round is written to the shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.operators.layout import remove_scratch, stored

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of an edge the smallest node that it reaches.

    Nodes are long or text. Loops, repeated edges and edges in both directions are allowed; rows with a
    null end are left out. Nodes without an edge to another node do not appear. An empty table gives an
    empty table.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = stored(pairs.filter("u is not null and v is not null and u <> v").distinct(), "edges")
    before = _mark(pairs)
    for _ in range(MAX_ROUNDS):
        after = stored(_small_star(_large_star(pairs)), "edges")
        mark = _mark(after)
        remove_scratch(pairs)
        pairs = after
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"Components did not settle within {MAX_ROUNDS} rounds.")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
