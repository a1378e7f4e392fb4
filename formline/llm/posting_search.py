"""Nearest neighbours: balanced posting lists, centroids found by a graph, lists chosen by distance ratio."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.vectors import matrix, unit, valid_rows
from formline.operators.layout import stored

# Rows per posting list to aim at, and bounds of the number of lists and of the sample that fits them.
LIST_ROWS, MOST_LISTS, SAMPLE_PER_LIST = 200, 8_192, 24
# A vector goes to the lists whose centroids are at most (1 + CLOSE) times as far as its nearest, REPLICAS at most.
CLOSE, REPLICAS = 0.10, 4
# A query reads the lists whose centroids are at most (1 + REACH) times as far as its nearest.
REACH = 0.22
# Neighbours of a centroid in the graph, centroids kept during a search, and how many are opened per step.
DEGREE, BEAM, OPENED = 16, 64, 8
# Rows of one list, and queries of one list, that a task holds; beyond, both are cut and all cuts meet.
BLOCK_ROWS, BLOCK_QUERIES = 4_000, 2_000
# More than rounding can part two equal similarities.
MARGIN = 1e-9


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Unit centroids of ``lists`` clusters of nearly equal size: halves split along their two-means axis."""
    draw, todo, done = np.random.default_rng(seed), [(np.arange(len(x)), lists)], []
    while todo:
        rows, parts = todo.pop()
        if parts <= 1 or len(rows) < 2:
            done.append(x[rows].mean(axis=0))
            continue
        y = x[rows]
        ends = y[draw.choice(len(rows), 2, replace=False)]
        for _ in range(6):
            side = y @ (ends[0] - ends[1])
            order = np.argsort(-side, kind="stable")
            half = len(rows) * (parts // 2) // parts  # the cut that balances, whatever the distances
            ends = np.stack([y[order[:half]].mean(axis=0), y[order[half:]].mean(axis=0)]) if 0 < half < len(rows) else ends
        half = min(max(1, half), len(rows) - 1)
        todo += [(rows[order[:half]], parts // 2), (rows[order[half:]], parts - parts // 2)]
    centres = np.stack(done)
    size = np.linalg.norm(centres, axis=1, keepdims=True)
    return centres / np.where(size > 0, size, 1)


@dataclass
class CentroidGraph:
    """Centroids with links to near ones and a few far ones; searched best first, many queries at once."""

    points: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @staticmethod
    def build(points: np.ndarray, degree: int = DEGREE, seed: int = 6) -> CentroidGraph:
        n, draw = len(points), np.random.default_rng(seed)
        near = min(degree, n)
        links = np.zeros((n, near + 4), np.int64)
        for at in range(0, n, 512):
            sims = points[at : at + 512] @ points.T
            links[at : at + 512, :near] = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        links[:, near:] = draw.integers(0, n, (n, 4))
        return CentroidGraph(points, links, np.unique(draw.integers(0, n, 32)))

    def search(self, queries: np.ndarray, beam: int = BEAM, opened: int = OPENED) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, similarities) of the nearest centroids found for each query, nearest first.

        Each step opens the best centroids not opened yet, and the search ends once the ``beam`` best are all open.
        """
        m, n = len(queries), len(self.points)
        beam = min(beam, n)
        every = np.arange(m)[:, None]
        best = np.broadcast_to(self.entries, (m, len(self.entries))).copy()
        sims = queries @ self.points[self.entries].T
        met = np.zeros((m, n), bool)
        met[:, self.entries] = True
        done = np.zeros((m, n), bool)
        while True:
            order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
            best, sims = best[every, order], sims[every, order]
            fresh = ~done[every, best] & np.isfinite(sims)
            if not fresh.any():
                return best, sims
            rank = np.argsort(~fresh, axis=1, kind="stable")[:, : min(opened, best.shape[1])]
            chosen = np.where(fresh[every, rank], best[every, rank], -1)
            done[every, np.where(chosen >= 0, chosen, best[:, :1])] = True
            new = np.where(chosen[:, :, None] >= 0, self.links[chosen], -1).reshape(m, -1)
            ask = (new >= 0) & ~met[every, new]
            found = np.where(ask, np.einsum("md,mkd->mk", queries, self.points[new]), -np.inf)
            met[every, np.where(ask, new, self.entries[0])] = True
            # The same centroid may come from two neighbours: keep one.
            order = np.argsort(new, axis=1, kind="stable")
            sorted_new = np.take_along_axis(new, order, 1)
            twice = np.zeros_like(ask)
            np.put_along_axis(twice, order[:, 1:], sorted_new[:, 1:] == sorted_new[:, :-1], 1)
            found = np.where(twice, -np.inf, found)
            best, sims = np.concatenate([best, new], 1), np.concatenate([sims, found], 1)


def chosen_lists(graph: CentroidGraph, x: np.ndarray, ratio: float, most: int | None, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) for the centroids at most (1 + ratio) times as far as the nearest found."""
    numbers, sims = graph.search(x, beam)
    far = np.sqrt(np.maximum(0, 2 - 2 * sims))
    take = np.isfinite(sims) & (far <= (1 + ratio) * far[:, :1] + 1e-12)
    if most:
        take[:, most:] = False
    row, place = np.nonzero(take)
    return row, numbers[row, place]


def _to_lists(graph, ratio: float, most: int | None, beam_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = graph.value
        beam = beam_of(len(found.points))
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                x = unit(matrix(part.column(1)))
                row, number = chosen_lists(found, x, ratio, most, beam)
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(row)).columns, pa.array(number, pa.int64())], ["id", "vector", "list"])
    return run


def fit_graph(vectors: DataFrame, rows: int) -> CentroidGraph | None:
    """Centroids from a sample by hash of at most MOST_LISTS * SAMPLE_PER_LIST rows, and their graph."""
    lists = min(MOST_LISTS, max(1, rows // LIST_ROWS))
    share = min(1.0, lists * SAMPLE_PER_LIST / max(1, rows))
    draw = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = vectors.filter(draw < share).orderBy(F.xxhash64(F.lit(9), "id"), "id").select("vector").toArrow()
    if not sample.num_rows:
        sample = vectors.orderBy("id").limit(1).select("vector").toArrow()
    if not sample.num_rows:
        return None
    return CentroidGraph.build(balanced_centroids(unit(matrix(sample.column("vector").combine_chunks())), lists))


def _meet(k: int):
    """The k best rows of a list's block for each of its queries, by the cosine of the original vectors."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "id": [], "score": []}
        if len(queries) and len(rows):
            rows = rows.sort_values("id")
            v, ids = np.stack(rows["vector"].to_numpy()), rows["id"].to_numpy()
            scaled, norms = unit(v), np.sqrt((v * v).sum(axis=1))
            for at in range(0, len(queries), 256):
                part = queries.iloc[at : at + 256]
                q = np.stack(part["vector"].to_numpy())
                near = unit(q) @ scaled.T
                some = len(ids) - min(len(ids), k)
                least = np.partition(near, some, axis=1)[:, some] - MARGIN
                row, place = np.nonzero(near >= least[:, None])  # all that may tie with the k-th best
                score = np.concatenate([np.einsum("nd,nd->n", q[row[j : j + 10_000]], v[place[j : j + 10_000]]) for j in range(0, len(row), 10_000)])
                score /= np.sqrt((q * q).sum(axis=1))[row] * norms[place]
                order = np.lexsort((ids[place], -score, row))
                order = order[np.arange(len(row)) - np.searchsorted(row, row) < k]  # row is in order
                out["query_id"] += part["id"].to_numpy()[row[order]].tolist()
                out["id"] += ids[place[order]].tolist()
                out["score"] += score[order].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "id": "int64", "score": "float64"})
    return run


def nearest_neighbours(df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
                       reach: float = REACH, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, id, score): for each row of ``queries`` its k nearest rows of ``df``, the query's own id excepted.

    1. Equal vectors are searched as one; of each the k + 1 smallest ids are enough to answer any query.
    2. Centroids of balanced clusters of a bounded sample are linked to a graph, which every task holds
       (MOST_LISTS points at most). Every vector is indexed: in the list of its nearest centroid and, near
       a border, in up to REPLICAS lists.
    3. A query's lists are those within (1 + reach) times the distance of its nearest centroid.
    4. Queries meet the rows of their lists, block by block; the best of all blocks are the answer,
       by cosine in double precision on the original vectors, ties to the smaller id.

    Rows without a valid vector (null, zero, empty, a null or non-finite component) or with a null id take no
    part. All vectors have one length. Fewer than k candidates found give fewer rows; an empty table none. Recall depends on
    ``reach``; tests hold it against brute force. Rows with the same id and different vectors are all found.
    """
    spark, schema = df.sparkSession, "query_id long, rank int, id long, score double"
    vectors = valid_rows(df, id_col, vector_col)
    few = Window.partitionBy("vector").orderBy("id")
    members = vectors.withColumn("place", F.row_number().over(few)).filter(F.col("place") <= k + 1)
    classes = stored(members.groupBy("vector").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    rows = classes.count()
    graph = fit_graph(classes, rows)
    asked = stored(valid_rows(queries, id_col, vector_col), "queries")
    if graph is None:
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(graph)

    listed = "id long, vector array<double>, list long"
    postings = stored(classes.select("id", "vector").mapInArrow(_to_lists(sent, CLOSE, REPLICAS, lambda n: BEAM), listed), "postings")
    wanted = stored(asked.select("id", "vector").mapInArrow(_to_lists(sent, reach, None, lambda n: max(BEAM, n // 2)), listed), "wanted")
    sizes = postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("row_cuts"))
    loads = wanted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("query_cuts"))
    cuts = sizes.join(loads, "list")
    key = F.xxhash64("id")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = wanted.join(cuts, "list").select("list", F.pmod(key, F.col("query_cuts")).cast("int").alias("q"), every("row_cuts").alias("r"), "id", "vector")
    right = postings.join(cuts, "list").select("list", F.pmod(key, F.col("row_cuts")).cast("int").alias("r"), every("query_cuts").alias("q"), "id", "vector")
    met = left.groupBy("list", "q", "r").cogroup(right.groupBy("list", "q", "r")).applyInPandas(
        _meet(k + 1), "query_id long, id long, score double")

    best = met.groupBy("query_id", "id").agg(F.max("score").alias("score"))  # a replica may be met twice
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    best = best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    full = best.join(classes.select("id", "ids"), "id").select("query_id", "score", F.explode("ids").alias("id")).filter("id <> query_id")
    return full.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
