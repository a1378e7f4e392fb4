"""Gradient-boosted regression trees on histograms, for all targets at once, with missing values in the trees.

Feature values become bin numbers once. A level of all targets' trees is one job: every task adds up residuals
and counts per (target, node, feature, bin) of the smaller child of each split, a shuffle by groups of features sums
the histograms, subtracts them from the node above for the larger child and finds the best split of each node there,
and the driver gets one row per node and group. Bin numbers and residuals are kept as bytes and the residuals are
renewed once a round. At each split the missing values go to the side where they gain more. Trees are rows of a
table, which Spark and SQL can replay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from formline.functions.columns import null_if_nan
from formline.operators.quantiles import values_at_ranks

# Rows and bytes of a block, rows of a task, and histogram cells (target, node, feature, bin) that one task of the second stage holds.
BLOCK_ROWS, BLOCK_BYTES, TASK_ROWS, SLAB_CELLS = 1 << 14, 1 << 21, 1 << 18, 1 << 17
# Rows that a task counts at once, and cells (node, bin, bin) up to which it counts two features together.
COUNTED_ROWS, PAIR_CELLS = 1 << 17, 1 << 17
# Each round's residuals come from those of the round before; after so many from the start again, so that what an
# executor's loss makes tasks compute again does not grow with the rounds.
KEPT_ROUNDS = 20
# Splits are compared by their gain as a share of the node's squared residuals, in steps of this size:
# sums that differ in their last bits do not change a tree.
STEPS = float(1 << 30)
TREES = ("target string, tree int, node int, feature string, threshold double, missing_left boolean, "
         "rows long, gain double, value double")


@dataclass(frozen=True)
class Boosting:
    """Parameters of a run: trees per target, their depth, the share of a leaf that counts, bins per feature."""

    rounds: int = 100
    depth: int = 5
    rate: float = 0.1
    bins: int = 64
    l2: float = 1.0  # added to a leaf's row count
    least_rows: int = 1  # of either side of a split
    bin_rows: int = 200_000  # of more rows the edges of bins are found by counts, and not in a task per feature


@dataclass
class Tree:
    """One tree with nodes numbered like a heap: the children of n are 2 n + 1 and 2 n + 2."""

    depth: int
    feature: np.ndarray = field(init=False)  # -1: no split
    edge: np.ndarray = field(init=False)  # the last bin that goes left
    missing_left: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)
    sums: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self):
        size = (1 << (self.depth + 1)) - 1
        self.feature, self.edge = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.missing_left = np.zeros(size, bool)
        self.rows, self.sums = np.zeros(size, np.int64), np.zeros(size)
        self.gain, self.value = np.zeros(size), np.zeros(size)

    def root(self, rows: int) -> np.ndarray:
        """The node of every row before the first level; small numbers, where they suffice, make ``descend`` fast."""
        return np.zeros(rows, np.uint8 if len(self.feature) < 256 else np.int64)

    def descend(self, codes: np.ndarray, level: int, nodes: np.ndarray, missing: int) -> np.ndarray:
        """From a level down to the next: ``codes`` holds a row of bin numbers per feature; rows in a leaf stay."""
        if nodes.dtype != np.uint8:
            feature = self.feature[nodes]
            inner = np.flatnonzero(feature >= 0)
            at = nodes[inner]
            code = codes[feature[inner], inner]
            left = np.where(code == missing, self.missing_left[at], code <= self.edge[at])
            nodes = nodes.copy()
            nodes[inner] = 2 * at + 2 - left
            return nodes
        step = np.zeros(len(nodes), np.uint8)
        for at in range((1 << level) - 1, (2 << level) - 1):
            if self.feature[at] >= 0:
                code = codes[self.feature[at]]
                right = code > int(self.edge[at])
                if self.missing_left[at]:
                    right &= code != missing
                step += (nodes == at).view(np.uint8) * (right.view(np.uint8) + np.uint8(at + 1))
        return nodes + step

    def reached(self, codes: np.ndarray, level: int, missing: int) -> np.ndarray:
        """The node of every row at a level, or the leaf above it."""
        nodes = self.root(codes.shape[1])
        for above in range(level):
            nodes = self.descend(codes, above, nodes, missing)
        return nodes

    def smaller(self, level: int) -> np.ndarray:
        """For the nodes above a level: which child has fewer rows, 0 or 1; -1 without a split."""
        above = np.arange((1 << (level - 1)) - 1, (1 << level) - 1)
        return np.where(self.feature[above] < 0, -1, self.rows[2 * above + 2] < self.rows[2 * above + 1])

    def predict(self, codes: np.ndarray, missing: int) -> np.ndarray:
        return self.value.take(self.reached(codes, self.depth, missing))


def bin_edges(train: DataFrame, features: Sequence[str], bins: int, bin_rows: int) -> list[np.ndarray]:
    """Ascending upper edges per feature: the values at ranks ceil(i n / bins), i from 1 to ``bins``, of all rows.

    Up to ``bin_rows`` rows, a window ranks a feature's values in one task; of larger tables the same values are found
    by sketches and counts. Few distinct values make few edges; a feature without values has none.
    """
    if train.count() > bin_rows:
        ranks = lambda n: sorted({-(-i * n // bins) - 1 for i in range(1, bins + 1)})
        return [np.array(sorted(set(found.values()))) for found in values_at_ranks(train, features, ranks)]
    values = [null_if_nan(f"`{name}`") for name in features]
    listed = F.array(*[F.struct(F.lit(i).alias("feature"), value.alias("value")) for i, value in enumerate(values)])
    long = train.select(F.inline(listed)).filter("value is not null")
    part = Window.partitionBy("feature")
    ranked = long.withColumns({"rank": F.row_number().over(part.orderBy("value")), "n": F.count(F.lit(1)).over(part)})
    chosen = ranked.filter(F.expr(f"rank * {bins} div n > (rank - 1) * {bins} div n"))
    found: list[list[float]] = [[] for _ in features]
    for row in chosen.select("feature", "value").distinct().collect():  # at most ``bins`` per feature
        found[row["feature"]].append(row["value"])
    return [np.array(sorted(edges)) for edges in found]


def coded(values: np.ndarray, edges: np.ndarray, missing: int) -> np.ndarray:
    """The number of edges below each value; NaN is missing."""
    codes = np.searchsorted(edges, values, "left")
    codes[np.isnan(values)] = missing
    return codes.astype(np.uint8)


def _floats(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN


def _packed(edges: list[np.ndarray], targets: int, base: np.ndarray, missing: int):
    """Blocks of rows: bin numbers by feature, residuals by target, NaN where it has no value."""

    most = _block_rows(len(edges), targets)

    def packed(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        n = rows.num_rows
        codes = [coded(_floats(rows.column(i)), e, missing) for i, e in enumerate(edges)]
        actual = [_floats(rows.column(len(edges) + t)) for t in range(targets)]
        return np.array(codes, np.uint8).reshape(len(edges), n), np.array(actual).reshape(targets, n) - base[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            a = 0
            while a < batch.num_rows:
                held.append(packed(batch.slice(a, most - n)))
                a, n = a + most - n, n + held[-1][0].shape[1]
                if n == most:
                    yield _batch(*(np.concatenate(parts, 1) for parts in zip(*held)))
                    held, n = [], 0
        if held:
            yield _batch(*(np.concatenate(parts, 1) for parts in zip(*held)))

    return run


def _block_rows(features: int, targets: int) -> int:
    return max(1, min(BLOCK_ROWS, BLOCK_BYTES // (features + 8 * targets)))


def _batch(codes: np.ndarray, residuals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([codes.shape[1]], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (codes, residuals)]], ["n", "codes", "residuals"])


BLOCK = "n int, codes binary, residuals binary"
Block = tuple[int, bytes, bytes]


def _together(blocks: Iterator[Block], targets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bin numbers and residuals of the blocks, about ``COUNTED_ROWS`` rows at a time."""
    held, rows = [], 0
    for n, codes, residuals in blocks:
        held.append((np.frombuffer(codes, np.uint8).reshape(-1, n), np.frombuffer(residuals).reshape(targets, n)))
        rows += n
        if rows >= COUNTED_ROWS:
            yield tuple(np.concatenate(parts, 1) for parts in zip(*held))
            held, rows = [], 0
    if held:
        yield tuple(np.concatenate(parts, 1) for parts in zip(*held))


def _grown(finished: list[list[Tree]], targets: int, missing: int):
    """Blocks without what the trees of the finished rounds explain of their residuals."""

    def run(blocks: Iterator[Block]) -> Iterator[Block]:
        for codes, residuals in _together(blocks, targets):
            for trees in finished:
                for t, tree in enumerate(trees):
                    residuals[t] -= tree.predict(codes, missing)
            size = _block_rows(len(codes), targets)
            for a in range(0, codes.shape[1], size):
                part = codes[:, a : a + size]
                yield part.shape[1], part.tobytes(), residuals[:, a : a + size].tobytes()

    return run


def _joint(codes: np.ndarray, features: range, width: int) -> np.ndarray:
    """The bins of one or two features as one number."""
    first = codes[features[0]].astype(np.int64)
    return first if len(features) == 1 else first * width + codes[features[1]]


def _histograms(growing: list[Tree], level: int, slabs: list[tuple[int, int]], missing: int):
    """Per group of features the sums of residuals and the rows per (target, node, feature, bin), and squares per node.

    Below the root only the smaller child of each split is counted: ``_totals`` gets the other one from the node above.
    """

    def run(part: int, blocks: Iterator[Block]) -> Iterator[Payload]:
        targets, width, first, size = len(growing), missing + 1, (1 << level) - 1, 1 << level
        features, counted = slabs[-1][1], max(1, size // 2)
        # One count for two features, added up by either, takes half the time, as long as its cells stay in the cache.
        together = 2 if counted * width * width <= PAIR_CELLS else 1
        groups = [range(f, min(f + together, features)) for f in range(0, features, together)]
        nodes = len(growing[0].feature)
        place = np.full(nodes, size)  # a node's number in its level; rows elsewhere come last
        place[first : first + size] = np.arange(size)
        chosen = np.full((targets, nodes), counted)  # the same for the nodes that are counted
        for t, tree in enumerate(growing):
            sides = tree.smaller(level) if level else np.zeros(1, int)
            split = np.flatnonzero(sides >= 0)
            chosen[t, first + 2 * split + sides[split]] = split
        sums = counts = squares = None
        for codes, residuals in _together(blocks, targets):
            if sums is None:
                sums, counts = (np.zeros((features, targets, counted, width)) for _ in range(2))
                squares = np.zeros((targets, size))
            taken = {}
            for t, tree in enumerate(growing):
                if (chosen[t] == counted).all():
                    continue
                at, unknown, residual = tree.reached(codes, level, missing), np.isnan(residuals[t]), residuals[t]
                if not level and not unknown.any():  # all rows are in the one node
                    squares[t] += np.dot(residual, residual)
                    taken[t] = None, None, residual
                    continue
                here = place.take(at)
                here[unknown] = size
                squares[t] += np.bincount(here, residual * residual, minlength=size + 1)[:size]
                rows = np.flatnonzero((chosen[t] < counted).take(at) & ~unknown)
                taken[t] = rows, chosen[t].take(at.take(rows)), residual.take(rows)
            for group in groups:
                joint, cells = _joint(codes, group, width), width ** len(group)
                shape, every = (counted, *[width] * len(group)), None
                for t, (rows, begin, residual) in taken.items():
                    at = joint if rows is None else begin * cells + joint.take(rows)
                    total = np.bincount(at, residual, minlength=counted * cells).reshape(shape)
                    if rows is not None or every is None:
                        number = np.bincount(at, minlength=counted * cells).reshape(shape)
                        every = number if rows is None else every
                    else:
                        number = every
                    for f, other in zip(group, (2, 1)):
                        sums[f, t] += total.sum(other) if len(group) > 1 else total
                        counts[f, t] += number.sum(other) if len(group) > 1 else number
        if sums is not None:
            for slab, (a, b) in enumerate(slabs):
                yield (slab, part), _bytes(squares, sums[a:b], counts[a:b])

    return run


Payload = tuple[tuple[int, int], bytes]  # (group of features, number of the task), numbers


def _bytes(*arrays: np.ndarray) -> bytes:
    return np.concatenate([array.ravel() for array in arrays]).tobytes()


def _totals(growing: list[Tree], level: int, slabs: list[tuple[int, int]], missing: int):
    """Per group of features the histograms of all tasks in their order; below the root, with those of the larger children.

    The level above comes first, as part -1: a larger child has what its smaller sibling leaves of the node above.
    """

    def run(payloads: Iterator[Payload]) -> Iterator[Payload]:
        found: dict[int, np.ndarray] = {}
        above: dict[int, np.ndarray] = {}
        for (slab, part), payload in payloads:
            content = np.frombuffer(payload)
            if part < 0:
                above[slab] = content
            else:
                found[slab] = found[slab] + content if slab in found else content
        targets, size = len(growing), 1 << level
        for slab, content in found.items():
            squares, cells = content[: targets * size], content[targets * size :]
            if level:
                (a, b), counted = slabs[slab], size // 2
                small = cells.reshape(2, b - a, targets, counted, missing + 1)
                node = above[slab][targets * counted :].reshape(small.shape)
                cells = np.zeros((2, b - a, targets, counted, 2, missing + 1))
                for t, tree in enumerate(growing):
                    for p, side in enumerate(tree.smaller(level)):
                        if side >= 0:
                            cells[:, :, t, p, side] = small[:, :, t, p]
                            cells[:, :, t, p, 1 - side] = node[:, :, t, p] - small[:, :, t, p]
                cells[0][cells[1] == 0] = 0  # no rows, no rest of a difference
            yield (slab, -1), _bytes(squares, cells)

    return run


def _best_splits(params: Boosting, slabs: list[tuple[int, int]], edges: list[int], targets: int, level: int, missing: int):
    """The best split of every node among the features of a group."""

    def run(found: Payload) -> list[dict]:
        (slab, _), payload = found
        total, (a, b) = np.frombuffer(payload), slabs[slab]
        nodes, width = 1 << level, missing + 1
        squares = total[: targets * nodes].reshape(targets, nodes)
        sums, counts = total[targets * nodes :].reshape(2, b - a, targets, nodes, width).transpose(0, 2, 3, 1, 4)
        return _slab_splits(params, squares, sums, counts, edges[a:b], a)

    return run


def _slab_splits(params: Boosting, squares, sums, counts, edges: list[int], first: int) -> list[dict]:
    """``sums`` and ``counts``: (target, node, feature, bin), the last bin for missing values."""
    node_sum, node_rows = sums[:, :, :1].sum(-1, keepdims=True), counts[:, :, :1].sum(-1, keepdims=True)
    left_sum, left_rows = np.cumsum(sums[..., :-1], -1), np.cumsum(counts[..., :-1], -1)
    # Missing values go left in the first of the last axis, right in the second.
    left_sum = np.stack([left_sum + sums[..., -1:], left_sum], -1)
    left_rows = np.stack([left_rows + counts[..., -1:], left_rows], -1)
    right_sum, right_rows = node_sum[..., None] - left_sum, node_rows[..., None] - left_rows
    gain = left_sum**2 / (left_rows + params.l2) + right_sum**2 / (right_rows + params.l2) - (node_sum**2 / (node_rows + params.l2))[..., None]
    possible = (left_rows >= params.least_rows) & (right_rows >= params.least_rows)
    possible &= np.arange(left_sum.shape[3])[:, None] < np.array(edges, np.int64)[:, None, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(possible & (squares[:, :, None, None, None] > 0), np.floor(gain / squares[:, :, None, None, None] * STEPS + 0.5), -np.inf)
    flat = score.reshape(*score.shape[:2], -1)
    best = flat.argmax(-1)  # the first of equal ones: by feature, edge, missing values to the left
    rows = []
    for t, node in zip(*np.nonzero(node_rows[:, :, 0, 0] > 0)):
        place = np.unravel_index(best[t, node], score.shape[2:])
        at = (t, node, *place)
        rows.append({"target": int(t), "node": int(node), "score": float(score[at]), "feature": first + int(place[0]), "edge": int(place[1]),
                     "missing_left": place[2] == 0, "gain": float(gain[at]), "left_rows": int(left_rows[at]), "left_sum": float(left_sum[at]),
                     "rows": int(node_rows[t, node, 0, 0]), "sum": float(node_sum[t, node, 0, 0])})
    return rows


def _slabs(features: int, cells: int) -> list[tuple[int, int]]:
    size = max(1, min(SLAB_CELLS // cells, -(-features // 8)))
    return [(a, min(features, a + size)) for a in range(0, features, size)]


def boost(train: DataFrame, features: Sequence[str], targets: Sequence[str], params: Boosting) -> list[dict]:
    """The fitted trees of all targets as rows of ``TREES``, from ``params.rounds`` * ``params.depth`` jobs.

    Tree -1 of a target is its start, the mean of its train rows. A row without a value of a target takes no
    part for that target; NaN counts as missing; features without values are never split on. Pass a
    written table: it is read for the row count, the edges, the means and the blocks. On the driver: the trees, and
    per level a row per target, node and group of features.
    """
    spark, missing = train.sparkSession, params.bins + 1  # bin ``bins`` is for values above the last edge
    if not 1 < params.bins < 255:
        raise ValueError(f"A feature has 2 to 254 bins, not {params.bins}.")
    edges = bin_edges(train, features, params.bins, params.bin_rows)
    means = train.agg(F.count(F.lit(1)), *[F.avg(null_if_nan(f"`{name}`")) for name in targets]).first()
    base = np.array([np.nan if m is None else m for m in means[1:]], float)
    values = train.select(*[null_if_nan(f"`{name}`").alias(f"c{i}") for i, name in enumerate([*features, *targets])])
    parallel = spark.sparkContext.defaultParallelism
    dealt = values.repartition(parallel * max(1, -(-means[0] // (parallel * TASK_ROWS))))
    start = blocks = dealt.mapInArrow(_packed(edges, len(targets), base, missing), BLOCK).rdd.map(tuple).persist(StorageLevel.DISK_ONLY)
    finished: list[list[Tree]] = []
    for number in range(params.rounds):
        before = blocks
        if number:  # filled by the job of the first level
            source, trees = (start, finished) if number % KEPT_ROUNDS == 0 else (blocks, finished[-1:])
            blocks = source.mapPartitions(_grown(trees, len(targets), missing)).persist(StorageLevel.MEMORY_AND_DISK)
        growing, totals = [Tree(params.depth) for _ in targets], None
        for level in range(params.depth):
            above = totals
            totals, more = _grow_level(blocks, above, growing, level, params, [len(e) for e in edges], missing)
            if above is not None:
                above.unpersist()
            if level == 0 and before is not blocks and before is not start:
                before.unpersist()
            if not more:
                break
        totals.unpersist()
        finished.append(growing)
    blocks.unpersist()
    start.unpersist()
    nothing = dict.fromkeys(part.split()[0] for part in TREES.split(", "))
    rows = [{**nothing, "target": name, "tree": -1, "node": 0, "value": None if np.isnan(b) else float(b)} for name, b in zip(targets, base)]
    for number, trees in enumerate(finished):
        for name, tree in zip(targets, trees):
            for node in np.flatnonzero(tree.rows):
                f = int(tree.feature[node])
                split = {} if f < 0 else {"feature": features[f], "threshold": float(edges[f][tree.edge[node]]), "missing_left": bool(tree.missing_left[node]),
                                          "gain": float(tree.gain[node])}
                rows.append({**nothing, "target": name, "tree": number, "node": int(node), "rows": int(tree.rows[node]), **split,
                             **({"value": float(tree.value[node])} if f < 0 else {})})
    return rows


def _grow_level(blocks: RDD, above: RDD | None, growing: list[Tree], level: int, params: Boosting, edges: list[int],
                missing: int) -> tuple[RDD, bool]:
    """Splits the nodes of one level: its histograms, from those ``above``, and whether any node was split."""
    slabs = _slabs(len(edges), len(growing) * (missing + 1) << max(params.depth - 1, 0))
    found = blocks.mapPartitionsWithIndex(_histograms(growing, level, slabs, missing))
    gathered = (found if above is None else found.union(above)).repartitionAndSortWithinPartitions(len(slabs), lambda key: key[0])
    totals = gathered.mapPartitions(_totals(growing, level, slabs, missing)).persist(StorageLevel.MEMORY_AND_DISK)
    best = totals.flatMap(_best_splits(params, slabs, edges, len(growing), level, missing)).collect()
    nodes: dict[tuple[int, int], object] = {}
    for row in best:
        key, known = (row["target"], row["node"]), nodes.get((row["target"], row["node"]))
        if known is None or (-row["score"], row["feature"]) < (-known["score"], known["feature"]):
            nodes[key] = row
    split = False
    for (t, node), row in nodes.items():
        tree, at = growing[t], (1 << level) - 1 + node
        tree.rows[at], tree.sums[at] = row["rows"], row["sum"]
        tree.value[at] = params.rate * row["sum"] / (row["rows"] + params.l2)
        if row["score"] >= 1:
            split = True
            tree.feature[at], tree.edge[at], tree.missing_left[at], tree.gain[at] = row["feature"], row["edge"], row["missing_left"], row["gain"]
            for child, rows, total in ((2 * at + 1, row["left_rows"], row["left_sum"]), (2 * at + 2, row["rows"] - row["left_rows"], row["sum"] - row["left_sum"])):
                tree.rows[child], tree.sums[child] = rows, total
                tree.value[child] = params.rate * total / (rows + params.l2)
    return totals, split


@dataclass
class Scorer:
    """Trees of one target laid out for evaluation: for each tree arrays over its nodes."""

    start: float
    trees: list[dict]

    @classmethod
    def of(cls, rows: Sequence[dict], features: Sequence[str]) -> Scorer:
        place = {name: i for i, name in enumerate(features)}
        start, trees = np.nan, {}
        for row in rows:
            if row["tree"] < 0:
                start = np.nan if row["value"] is None else row["value"]
            else:
                trees.setdefault(row["tree"], []).append(row)
        laid = []
        for _, nodes in sorted(trees.items()):
            size = max(row["node"] for row in nodes) + 1
            tree = {"feature": np.full(size, -1), "threshold": np.zeros(size), "missing_left": np.zeros(size, bool), "value": np.zeros(size)}
            for row in nodes:
                at = row["node"]
                if row["feature"] is None:
                    tree["value"][at] = row["value"]
                else:
                    tree["feature"][at], tree["threshold"][at], tree["missing_left"][at] = place[row["feature"]], row["threshold"], row["missing_left"]
            laid.append(tree)
        return cls(start, laid)

    def predict(self, values: np.ndarray) -> np.ndarray:
        """``values``: features by rows, NaN where missing."""
        total = np.full(values.shape[1], self.start)
        for tree in self.trees:
            nodes = np.zeros(values.shape[1], np.int64)
            while True:
                feature = tree["feature"][nodes]
                inner = np.flatnonzero(feature >= 0)
                if not len(inner):
                    break
                at, value = nodes[inner], values[feature[inner], inner]
                left = np.where(np.isnan(value), tree["missing_left"][at], value <= tree["threshold"][at])
                nodes[inner] = 2 * at + 2 - left
            total += tree["value"][nodes]
        return total


def prediction(rows: Sequence[dict], target: str, features: Sequence[str]) -> Column:
    """The prediction of one target as a column; the trees travel with it, and their number bounds their size."""
    mine = [row for row in rows if row["target"] == target]
    used = sorted({row["feature"] for row in mine if row.get("feature") is not None}, key=list(features).index)

    def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        scorer = Scorer.of(mine, used)
        for columns in batches:
            values = np.array([_floats(c) for c in columns[: len(used)]]).reshape(len(used), len(columns[-1]))
            yield pa.array(scorer.predict(values))

    # Two columns more give the number of rows where no feature is used.
    return F.arrow_udf(score, "double")(*[null_if_nan(f"`{name}`") for name in used], F.lit(0), F.lit(0))


def leaf_intervals(trees: DataFrame) -> DataFrame:
    """(target, tree, leaf, value, feature, above, up_to, missing): what a row must fulfil to reach a leaf.

    One row per leaf and feature on its path: the value lies above ``above`` and at most at ``up_to`` (null: no
    bound), or it is missing where ``missing`` allows. A leaf that is the root has one row without a feature.
    A row reaches the one leaf of a tree whose rows all hold, so joins and SQL can predict.
    """
    nodes = trees.filter("tree >= 0")
    inner = nodes.filter("feature is not null").select("target", "tree", F.col("node").alias("parent"), "feature", "threshold", "missing_left")
    paths = nodes.filter("feature is null").select("target", "tree", F.col("node").alias("leaf"), "value", F.expr(
        "filter(transform(sequence(0, 31), d -> named_struct('parent', cast(floor((node + 1) / pow(2, d + 1)) as int) - 1, "
        "'left', cast(floor((node + 1) / pow(2, d)) as int) % 2 = 0)), s -> s.parent >= 0)").alias("path"))
    steps = paths.select("target", "tree", "leaf", "value", F.explode_outer("path").alias("step")).select("*", "step.*")
    met = steps.join(inner, ["target", "tree", "parent"], "left")
    bound = lambda left: F.when(F.col("left") == left, F.col("threshold"))
    return met.groupBy("target", "tree", "leaf", "value", "feature").agg(
        F.max(bound(False)).alias("above"), F.min(bound(True)).alias("up_to"),
        F.min(F.col("missing_left") == F.col("left")).alias("missing"))
