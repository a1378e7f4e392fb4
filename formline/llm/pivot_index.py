"""Near-duplicate vectors: descriptions by nearest pivots, inverted pivot lists, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.components import connected_components
from formline.llm.vectors import matrix, spread_out, unit, valid_rows
from formline.operators.layout import stored

THRESHOLD = 0.9
# Pivots: about PIVOTS_PER_ROOT * sqrt(rows), from a bounded sample by hash, no two of them closer than SPREAD.
PIVOTS_PER_ROOT, LEAST_PIVOTS, MOST_PIVOTS, SAMPLE_PER_PIVOT, SPREAD = 3, 64, 16_384, 4, 0.7
# A vector is described by its nearest pivots in order; a pair is looked at if it shares so many of them.
NEAREST, SHARED = 8, 2
# Rows of a pivot list that one task holds; longer lists are cut, and all pairs of cuts compared.
BLOCK_ROWS = 2_000


def choose_pivots(vectors: DataFrame, rows: int) -> np.ndarray:
    """Reference points that lie apart from each other, from a sample by hash of at most about 65,536 rows."""
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(PIVOTS_PER_ROOT * math.sqrt(rows))))
    share = min(1.0, SAMPLE_PER_PIVOT * wanted / max(1, rows))
    draw = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = vectors.filter(draw < share).orderBy(F.xxhash64(F.lit(4), "id"), "id").select("vector").toArrow()
    return spread_out(unit(matrix(sample.column("vector").combine_chunks())), wanted, SPREAD) if sample.num_rows else np.zeros((0, 0))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """The numbers of the nearest pivots of each row, nearest first."""
    count = min(count, len(pivots))
    near = x @ pivots.T
    some = np.argpartition(-near, count - 1, axis=1)[:, :count]
    order = np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1).astype(np.int32)


def _describe(pivots, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = pivots.value
        for batch in batches:
            for at in range(0, len(batch), 1_000):
                part = batch.slice(at, 1_000)
                near = nearest_pivots(unit(matrix(part.column(2))), points, count)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * near.shape[1], pa.int32()), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], ["id", "copies", "vector", "pivots"])
    return run


def _block(threshold: float, shared: int):
    """Links of one pivot list, or of two cuts of it, as counts and as a few edges that keep them connected."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        pivot, one, other = key
        rows = rows.sort_values(["cut", "id"])
        ids, copies, cut = (rows[c].to_numpy() for c in ("id", "copies", "cut"))
        x, lists = unit(np.stack(rows["vector"].to_numpy())), np.stack(rows["pivots"].to_numpy())
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for at in range(0, len(ids), 256):
            near = x[at : at + 256] @ x.T >= threshold
            a, b = np.nonzero(near)
            a += at
            pick = (a < b) & ((one == other) | (cut[a] != cut[b]))
            a, b = a[pick], b[pick]
            for begin in range(0, len(a), 100_000):
                p, q = a[begin : begin + 100_000], b[begin : begin + 100_000]
                same = lists[p][:, :, None] == lists[q][:, None, :]
                both = same.any(axis=2)
                # A pair that shares several pivots is counted in the list of the smallest of them only.
                smallest = np.where(both, lists[p], np.iinfo(np.int32).max).min(axis=1)
                here = (both.sum(axis=1) >= min(shared, lists.shape[1])) & (smallest == pivot)
                p, q = p[here], q[here]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                root = _united(root, p, q)
        tied = np.flatnonzero(root != np.arange(len(ids)))
        return pd.concat([
            pd.DataFrame({"id": ids[links > 0], "links": links[links > 0], "tied_to": None}),
            pd.DataFrame({"id": ids[tied], "links": 0, "tied_to": ids[root[tied]]})]).astype({"tied_to": "Int64"})
    return run


def _united(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after uniting the pairs: smallest labels spread along the links until nothing moves."""
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = np.minimum(root, root[root])
        while (root != root[root]).any():
            root = root[root]
        if (root == before).all():
            break
    return root


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                           nearest: int = NEAREST, shared: int = SHARED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``df``: id, n_links, component_id (smallest id reachable by links), kept.

    1. Equal vectors are one from here on, with their number of copies.
    2. Each is described by its ``nearest`` nearest pivots in order. The index holds every vector; only the
       pivots come from a bounded sample (see ``choose_pivots``).
    3. Under every pivot stand the vectors that name it. Pairs that share ``shared`` pivots or more are
       candidates; their cosine, in double precision, decides. A list of more than ``block_rows`` is cut by
       hash, and every pair of cuts is a task.
    4. A task returns counts of links and the edges that hold its groups together, not the pairs.

    Pairs whose descriptions have fewer pivots in common are missed; tests hold recall against brute force.
    Vectors that are null, zero, empty or hold null or non-finite components have no links, as have rows
    with a null id. Rows with the same id are taken as one vector's copies if their vectors are equal;
    otherwise each links by itself and the id's row count stays. All vectors have to have one length.
    Other columns are left out. An empty table gives an empty table.
    """
    spark = df.sparkSession
    vectors = valid_rows(df, id_col, vector_col)
    classes = stored(vectors.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")).select("id", "copies", "vector"), "vectors")
    rows = classes.count()
    points = choose_pivots(classes, rows)
    out = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    if not len(points):
        return out.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                          F.col("id").isNotNull().alias("kept"))
    sent = spark.sparkContext.broadcast(points)  # at most MOST_PIVOTS points
    described = stored(classes.mapInArrow(_describe(sent, nearest), "id long, copies long, vector array<double>, pivots array<int>"), "described")

    lists = described.select(F.explode("pivots").alias("pivot")).groupBy("pivot").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    cuts = lists.select("pivot", F.ceil(F.col("size") / block_rows).cast("int").alias("cuts"))
    postings = described.select("id", "copies", "vector", "pivots", F.explode("pivots").alias("pivot")).join(cuts, "pivot")
    postings = postings.withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda c: F.struct(
        F.least(c, F.col("cut")).alias("one"), F.greatest(c, F.col("cut")).alias("other")))
    postings = postings.withColumn("pair", F.explode(pairs)).select("pivot", "pair.one", "pair.other", "cut", "id", "copies", "vector", "pivots")
    found = postings.groupBy("pivot", "one", "other").applyInPandas(_block(threshold, shared), "id long, links long, tied_to long")
    found = stored(found, "vector-links")

    labels = connected_components(found.filter("tied_to is not null").select(F.col("id").alias("a"), F.col("tied_to").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    summary = classes.join(links, "id", "left").join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "vector", F.col("id").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    named = out.join(summary, "vector", "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return named.select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                        own.alias("component_id"), F.coalesce(own == F.col("id"), F.lit(False)).alias("kept"))
