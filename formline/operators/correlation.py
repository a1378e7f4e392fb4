"""Pearson correlations over pairs of rows where both columns have values.

The matrix of pairs is cut into tiles of ``TILE`` columns by ``TILE`` columns. A task reduces its rows to the
moments of some tiles by matrix products, and the tiles' moments are summed: one read for the column means, and
one for every ``TASK_TILES`` tiles, of their columns alone. Memory is bounded by that, whatever the columns.
NaN counts as missing. A pair has no correlation (NULL) if one column is constant on the common rows, or
if a common row holds an infinite value; the pairs of other columns are not affected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import names as N

# Columns of a tile's side, and tiles that one task sums up: five sums of TILE * TILE numbers each.
TILE, TASK_TILES = 256, 32
SUMS = 7  # n, sx, sy, sxx, syy, sxy, rows with an infinite value


def correlation_columns(df: DataFrame) -> list[str]:
    return N.numeric_columns(df, fv.CORRELATION_ID_COLUMNS)


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_1, feature_2, correlation) for each pair, the first column before the second."""
    return _correlations(df, columns, None)


def _correlations(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[int, int]] | None) -> DataFrame:
    return named_pairs(by_moments(df.select(*columns), pairs), columns)


def named_pairs(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    name = F.lit(list(columns))
    return long.select(
        F.get(name, F.col("i")).alias("feature_1"), F.get(name, F.col("j")).alias("feature_2"), "correlation"
    )


def _numbered(df: DataFrame) -> DataFrame:
    """The columns as doubles c0, c1, ...; as text, since thousands of column objects take long to make."""
    return df.selectExpr(*[f"cast(`{c}` as double) as c{i}" for i, c in enumerate(df.columns)])


def _tiles(size: int, pairs: Sequence[tuple[int, int]] | None) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray] | None]:
    """The wanted pairs of each tile as places inside it; None for all pairs of different columns, the first before the second."""
    if pairs is None:
        count = -(-size // TILE)
        return {(a, b): None for a in range(count) for b in range(a, count)}
    left, right = (np.array(side, np.int64) for side in zip(*pairs))
    found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray] | None] = {}
    tile = np.stack([left // TILE, right // TILE], 1)
    for a, b in np.unique(tile, axis=0).tolist():
        mine = (tile == (a, b)).all(1)
        found[a, b] = (left[mine] - a * TILE, right[mine] - b * TILE)
    return found


def _moments(tiles: list[tuple[int, int]], blocks: list[int], centres: np.ndarray):
    """Sums of the tiles over a task's rows; ``blocks`` numbers the column blocks, TILE columns each, that the batches hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            values, at = {}, 0
            for block in blocks:
                mine = centres[block * TILE : (block + 1) * TILE]
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[at : at + len(mine)]], 1).astype(float) - mine
                at += len(mine)
                mask, endless = (~np.isnan(x)).astype(float), np.isinf(x).astype(float)
                x[~np.isfinite(x)] = 0.0
                values[block] = (x, mask, endless)
            for a, b in tiles:
                (x, m, e), (y, k, f) = values[a], values[b]
                found = np.stack([m.T @ k, x.T @ k, m.T @ y, (x * x).T @ k, m.T @ (y * y), x.T @ y, e.T @ k + m.T @ f])
                sums[a, b] = sums[a, b] + found if (a, b) in sums else found
        for (a, b), found in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([found.tobytes()], pa.binary())], ["a", "b", "sums"])

    return run


def _finished(wanted: dict[tuple[int, int], tuple[np.ndarray, np.ndarray] | None], size: int):
    """The correlations of a tile from the sums of all tasks."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("correlation", pa.float64())])

    def correlations(a: int, b: int, sums: np.ndarray) -> pa.RecordBatch:
        height, width = min(TILE, size - a * TILE), min(TILE, size - b * TILE)
        i, j = np.triu_indices(height, 1, width) if wanted[a, b] is None and a == b else \
            (g.ravel() for g in np.indices((height, width))) if wanted[a, b] is None else wanted[a, b]
        n, sx, sy, sxx, syy, sxy, infinite = sums.reshape(SUMS, height, width)[:, i, j]
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = np.maximum(sxx - sx * sx / n, 0) * np.maximum(syy - sy * sy / n, 0)
            found = np.where((infinite == 0) & (spread > 0), (sxy - sx * sy / n) / np.sqrt(spread), np.nan)
        columns = [pa.array(i + a * TILE, pa.int32()), pa.array(j + b * TILE, pa.int32()), pa.array(found, pa.float64(), mask=np.isnan(found))]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, total = None, np.zeros(0)
        for batch in batches:  # sorted by tile
            for a, b, sums in zip(*batch.columns):
                found = np.frombuffer(sums.as_buffer())
                if (a.as_py(), b.as_py()) == tile:
                    total = total + found
                else:
                    if tile:
                        yield correlations(*tile, total)
                    tile, total = (a.as_py(), b.as_py()), found
        if tile:
            yield correlations(*tile, total)

    return run


def _means(values: DataFrame) -> np.ndarray:
    """The mean of each column's finite values, 0 without any: without it, a column far from zero loses digits in the sums of squares.

    Arrays are summed, as one aggregate expression per column would outgrow what the engine compiles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(size), np.zeros(size, np.int64)
        for batch in batches:
            for i, column in enumerate(batch.columns):
                x = column.drop_null().to_numpy(zero_copy_only=False)
                x = x[np.isfinite(x)]
                total[i] += x.sum()
                count[i] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total), pa.array(count)], ["i", "total", "count"])

    size, means = len(values.columns), np.zeros(len(values.columns))
    sums = values.mapInArrow(run, "i int, total double, count long").groupBy("i").agg(F.sum("total").alias("total"), F.sum("count").alias("count"))
    for row in sums.collect():  # one row per column
        means[row["i"]] = row["total"] / row["count"] if row["count"] else 0.0
    return means


def by_moments(df: DataFrame, pairs: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """(i, j, correlation) for pairs of column positions; without a list, for all i < j."""
    values = _numbered(df)
    centres = _means(values)
    wanted = _tiles(len(centres), pairs)
    tiles = sorted(wanted)
    parts = []
    for at in range(0, len(tiles), TASK_TILES):
        mine = tiles[at : at + TASK_TILES]
        blocks = sorted({block for tile in mine for block in tile})
        needed = [c for block in blocks for c in values.columns[block * TILE : (block + 1) * TILE]]
        parts.append(values.select(*needed).mapInArrow(_moments(mine, blocks, centres), "a int, b int, sums binary"))
    sums = reduce(DataFrame.unionByName, parts)
    return sums.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(_finished(wanted, len(centres)), "i int, j int, correlation double")


def target_correlations(
    df: DataFrame, targets: Sequence[str] = fv.TARGETS, features: Sequence[str] | None = None
) -> DataFrame:
    """Every feature against every target. Without a list, all numeric columns that are no targets."""
    chosen = [c for c in correlation_columns(df) if c not in targets] if features is None else list(features)
    columns = [*chosen, *targets]
    pairs = [(i, len(chosen) + j) for i in range(len(chosen)) for j in range(len(targets))]
    return (
        _correlations(df, columns, pairs)
        .withColumnsRenamed({"feature_1": "feature", "feature_2": "target"})
        .filter(F.col("correlation").isNotNull())
        .withColumn("abs_correlation", F.abs("correlation"))
    )


def collinear_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, threshold: float = fv.COLLINEAR_THRESHOLD
) -> DataFrame:
    """Feature pairs whose correlation reaches the threshold in size."""
    chosen = [c for c in correlation_columns(df) if c not in [*fv.TARGETS, *fv.BINARY_COLUMNS]]
    chosen = chosen if columns is None else list(columns)
    return (
        correlation_pairs(df, chosen)
        .withColumn("abs_correlation", F.abs("correlation"))
        .filter(F.col("abs_correlation") >= threshold)
    )


def top_pairs(long: DataFrame, n: int = 30) -> DataFrame:
    """The strongest correlations first; names break ties."""
    names = [column for column in long.columns if not column.endswith("correlation")]
    return long.orderBy(F.col("abs_correlation").desc(), *names).limit(n)


def correlation_matrix(df: DataFrame, rows: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A matrix with one row per feature and one column per feature; the diagonal is 1 unless constant."""
    names = list(dict.fromkeys([*rows, *columns]))
    place = {name: i for i, name in enumerate(names)}
    pairs = sorted({tuple(sorted((place[r], place[c]))) for r in rows for c in columns})
    long = _correlations(df, names, pairs)
    mirrored = long.unionByName(long.filter(F.col("feature_1") != F.col("feature_2")).select(
        F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"), "correlation"))
    return (
        mirrored.filter(F.col("feature_1").isin(list(rows)))
        .groupBy(F.col("feature_1").alias("feature"))
        .pivot("feature_2", list(columns))
        .agg(F.max("correlation"))
    )
