"""Exact quantiles with linear interpolation, for columns of any length.

``percentile`` would keep every distinct value of a column in one task. Here the order statistics on
either side of each quantile are found by narrowing: ``percentile_approx`` proposes values on both
sides of the wanted ranks, exact counts confirm where the ranks lie, and this repeats until an
interval holds few enough values (``max_values``) to rank them. All columns share the passes: sketches, counts, and
in the end one ranking of what lies inside. A pass shuffles a few numbers per column and no rows. A poor
proposal costs a pass, never exactness: sketches grow finer until every interval is small enough.

Counts are taken on the columns as arrays, batch by batch: there is never a row per cell, and no expression
per column and bound, which would outgrow what the engine compiles well.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.functions.columns import null_if_nan

MAX_VALUES = 200_000
ACCURACY = 1_000
# For the values at many ranks: sketches this fine leave so small a share of a column around a rank that it is ranked at once.
FINE_ACCURACY = 10_000

Quantiles = dict[str, dict[float, float | None]]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], max_values: int = MAX_VALUES,
    also: Mapping[str, Callable[[Column], Column]] | None = None,
) -> tuple[Quantiles, dict[str, dict]]:
    """``{column: {probability: value}}``, None for a column without values; and per column the aggregates of ``also``.

    The first pass counts all columns, proposes values around every quantile, and computes the aggregates.
    """
    if not columns:
        return {}, {}
    also = dict(also or {})
    values = df.select(*[null_if_nan(F.col(f"`{column}`")).alias(f"c{i}") for i, column in enumerate(columns)])
    places = sorted({min(max(p + side * 2 / ACCURACY, 0.0), 1.0) for p in probabilities for side in (-1, 1)})
    first = values.agg(*[
        F.struct(F.count(c).alias("_size"), F.percentile_approx(c, places, ACCURACY).alias("_near"),
                 *[aggregate(F.col(c)).alias(name) for name, aggregate in also.items()]).alias(c)
        for c in values.columns
    ]).first()
    sizes = {c: first[c]["_size"] for c in values.columns if first[c]["_size"]}
    proposed = {c: sorted(set(first[c]["_near"])) for c in sizes if sizes[c] > max_values}
    found = {c: dict.fromkeys(probabilities) for c in values.columns if c not in sizes}
    found |= _narrowed(values, sizes, probabilities, max_values, proposed)
    named = dict(zip(values.columns, columns))
    return ({name: found[c] for c, name in named.items()},
            {name: {key: first[c][key] for key in also} for c, name in named.items()})


def values_at_ranks(df: DataFrame, columns: Sequence[str], ranks: Callable[[int], Sequence[int]]) -> list[dict[int, float]]:
    """For each column ``{rank: value}``: its values at ``ranks(n)``, counted from 0 in the ascending order of its ``n`` values.

    All rows count. One pass counts the columns, one proposes values on both sides of each rank, one counts around
    those, and what lies between, up to 6 in ``FINE_ACCURACY`` of a column's values for a rank, is shuffled and ranked.
    """
    values = df.select(*[null_if_nan(F.col(f"`{column}`")).alias(f"c{i}") for i, column in enumerate(columns)])
    counted = values.agg(*[F.count(c).alias(c) for c in values.columns]).first()
    searches = [_Search(c, 0.0, counted[c], wanted=[rank]) for c in values.columns if counted[c] for rank in ranks(counted[c])]
    margin, places = 2 / FINE_ACCURACY, {}
    for s in searches:
        rank, size = s.wanted[0], s.size
        places.setdefault(s.column, set()).update((max(rank / size - margin, 0.0), min((rank + 1) / size + margin, 1.0)))
    if places:
        near = values.agg(*[F.percentile_approx(c, sorted(at), FINE_ACCURACY).alias(c) for c, at in places.items()]).first()
        counts = _count_around(values, {c: sorted(set(near[c])) for c in places})
        for s in searches:
            for value, around in counts[s.column].items():
                s.learn(value, *around)
        _rank_inside(values, [s for s in searches if s.open_ranks])
    found = {c: {} for c in values.columns}
    for s in searches:
        found[s.column] |= s.at
    return list(found.values())


@dataclass
class _Search:
    """The ranks on either side of one quantile, or those ``wanted``, and the open interval (lo, hi) that still holds them.

    A bound of None is no bound, so that infinite values take part.
    """

    column: str
    probability: float
    size: int
    lo: float | None = None
    hi: float | None = None
    up_to_lo: int = 0  # number of values <= lo
    below_hi: int = 0  # number of values < hi
    at: dict[int, float] = field(default_factory=dict)
    wanted: Sequence[int] = ()

    def __post_init__(self):
        self.below_hi = self.size
        self.position = (self.size - 1) * self.probability
        self.ranks = sorted(self.wanted or {math.floor(self.position), math.ceil(self.position)})

    @property
    def open_ranks(self) -> list[int]:
        return [rank for rank in self.ranks if rank not in self.at]

    @property
    def inside(self) -> int:
        return self.below_hi - self.up_to_lo

    def holds(self) -> Column:
        value = F.col(self.column)
        above = value.isNotNull() if self.lo is None else value > self.lo
        return above if self.hi is None else above & (value < self.hi)

    def proposals(self, accuracy: int) -> list[float]:
        """Local probabilities a little below the first and above the last open rank."""
        margin = 2 / accuracy
        first, last = self.open_ranks[0], self.open_ranks[-1]
        places = [(first - self.up_to_lo) / self.inside - margin, (last + 1 - self.up_to_lo) / self.inside + margin]
        return [min(max(place, 0.0), 1.0) for place in places]

    def learn(self, value: float, below: int, up_to: int) -> None:
        """``below`` values of the column are smaller than ``value``, ``up_to`` are not larger."""
        for rank in self.open_ranks:
            if below <= rank < up_to:
                self.at[rank] = value
        if not self.open_ranks:
            return
        if up_to <= self.open_ranks[0] and (self.lo is None or value > self.lo):
            self.lo, self.up_to_lo = value, up_to
        if below > self.open_ranks[-1] and (self.hi is None or value < self.hi):
            self.hi, self.below_hi = value, below

    def value(self) -> float:
        low, high = self.at[self.ranks[0]], self.at[self.ranks[-1]]
        lower, higher = self.ranks[0], self.ranks[-1]
        return low if lower == higher else (higher - self.position) * low + (self.position - lower) * high


def _narrowed(
    values: DataFrame, sizes: dict[str, int], probabilities: Sequence[float], max_values: int,
    proposed: dict[str, list[float]],
) -> Quantiles:
    searches = [_Search(column, p, size) for column, size in sizes.items() for p in probabilities]
    if proposed:
        counts = _count_around(values, proposed)
        for s in searches:
            for value in proposed.get(s.column, ()):
                s.learn(value, *counts[s.column][value])
    accuracy = ACCURACY
    while wide := [s for s in searches if s.open_ranks and s.inside > max_values]:
        before = [(s.inside, len(s.open_ranks)) for s in wide]
        _narrow(values, wide, accuracy)
        if any((s.inside, len(s.open_ranks)) == b for s, b in zip(wide, before)):
            accuracy *= 10  # a sketch as fine as its interval is exact, so this ends
    _rank_inside(values, [s for s in searches if s.open_ranks])
    result: Quantiles = {}
    for s in searches:
        result.setdefault(s.column, {})[s.probability] = s.value()
    return result


def _narrow(values: DataFrame, searches: Sequence[_Search], accuracy: int) -> None:
    """One pass to propose values, one to count the values below and up to each of them."""
    # Searches that still share an interval share its sketch.
    intervals: dict[tuple, list[_Search]] = {}
    for s in searches:
        intervals.setdefault((s.column, s.lo, s.hi), []).append(s)
    sketches = values.agg(*[
        F.percentile_approx(
            F.when(group[0].holds(), F.col(group[0].column)), [p for s in group for p in s.proposals(accuracy)], accuracy
        ).alias(f"g{i}")
        for i, group in enumerate(intervals.values())
    ]).first()
    proposed = {
        id(s): sketches[f"g{i}"][2 * j:2 * j + 2]
        for i, group in enumerate(intervals.values()) for j, s in enumerate(group)
    }
    edges: dict[str, list[float]] = {}
    for s in searches:
        edges[s.column] = sorted({*edges.get(s.column, []), *proposed[id(s)]})
    counts = _count_around(values, edges)
    for s in searches:
        for value in sorted(set(proposed[id(s)])):
            s.learn(value, *counts[s.column][value])


def column_partials(values: DataFrame, columns: Sequence[str], summarise: Callable[[str, np.ndarray], list[tuple]], schema: str) -> DataFrame:
    """Rows that ``summarise`` makes of each column's values in a batch: a few numbers, never the values as rows.

    The columns travel side by side, as arrays, however many there are; missing values and NaN are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for column, name in zip(batch.columns, columns):
                x = column.drop_null().to_numpy(zero_copy_only=False)
                rows += summarise(name, x[~np.isnan(x)])
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], kinds)

    names = [part.split()[0] for part in schema.split(", ")]
    kinds = pa.schema([(part.split()[0], ARROW[part.split()[1]]) for part in schema.split(", ")])
    return values.select(*[null_if_nan(F.col(f"`{column}`")) for column in columns]).mapInArrow(run, schema)


ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}


def _count_around(values: DataFrame, edges: dict[str, list[float]]) -> dict[str, dict[float, tuple[int, int]]]:
    """For each edge of each column, how many values are smaller and how many are not larger."""

    def counts(column: str, x: np.ndarray) -> list[tuple]:
        return [(column, i, int(np.count_nonzero(x < edge)), int(np.count_nonzero(x <= edge))) for i, edge in enumerate(edges[column])]

    parts = column_partials(values, list(edges), counts, "column string, edge int, below long, up_to long")
    found: dict[str, dict[float, tuple[int, int]]] = {column: dict.fromkeys(column_edges, (0, 0)) for column, column_edges in edges.items()}
    for row in parts.groupBy("column", "edge").agg(F.sum("below").alias("below"), F.sum("up_to").alias("up_to")).collect():
        found[row["column"]][edges[row["column"]][row["edge"]]] = (row["below"], row["up_to"])
    return found


def _rank_inside(values: DataFrame, searches: Sequence[_Search]) -> None:
    """Rank the distinct values inside each open interval; there are few of them."""
    if not searches:
        return
    mine: dict[str, list[tuple[int, float | None, float | None]]] = {}
    for i, s in enumerate(searches):
        mine.setdefault(s.column, []).append((i, s.lo, s.hi))

    def inside(column: str, x: np.ndarray) -> list[tuple]:
        rows = []
        for search, lo, hi in mine[column]:
            held = x if lo is None else x[x > lo]
            held, times = np.unique(held if hi is None else held[held < hi], return_counts=True)
            rows += zip([search] * len(held), held.tolist(), times.tolist())
        return rows

    counted = column_partials(values, list(mine), inside, "search int, value double, count long") \
        .groupBy("search", "value").agg(F.sum("count").alias("count"))
    ordered = Window.partitionBy("search").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    wanted = values.sparkSession.createDataFrame([(i, rank - s.up_to_lo) for i, s in enumerate(searches) for rank in s.open_ranks], "search int, rank long")
    hits = (
        counted.withColumn("reached", F.sum("count").over(ordered))
        .join(F.broadcast(wanted), "search")  # two rows per search at most
        .filter((F.col("reached") > F.col("rank")) & (F.col("reached") - F.col("count") <= F.col("rank")))
    )
    for row in hits.collect():
        s = searches[row["search"]]
        s.at[row["rank"] + s.up_to_lo] = row["value"]
