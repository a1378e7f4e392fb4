"""Boosted trees against a plain trainer, and their tables against SQL."""

import math
import random

import duckdb
import numpy as np
import pytest

from formline.operators import boosting as B
from formline.operators import training
from formline.operators.boosting import Boosting

FEATURES, TARGETS = ["a", "b", "c", "none"], ["y", "z"]
SCHEMA = "id long, a double, b int, c double, none double, y double, z double"


def rows(n=400, seed=3):
    rng = random.Random(seed)
    found = []
    for i in range(n):
        a, b = rng.choice([None, round(rng.random(), 2), round(rng.random(), 2)]), rng.randrange(5)
        c = rng.choice([math.nan, None, rng.gauss(0, 1)])
        y = (5 * a if a is not None else -3.0) + b + rng.random()
        found.append((i, a, b, c, None, y if rng.random() > 0.1 else rng.choice([None, math.nan]), float(b % 2) - (0 if c else 1)))
    return found


def plain_trees(data, p):
    """The same rules, one row at a time."""
    gone = lambda v: v is None or (isinstance(v, float) and math.isnan(v))
    columns = {name: [None if gone(r[1 + i]) else float(r[1 + i]) for r in data] for i, name in enumerate(FEATURES)}
    edges = {}
    for name, values in columns.items():
        known = sorted(v for v in values if v is not None)
        edges[name] = sorted({known[math.ceil(i * len(known) / p.bins) - 1] for i in range(1, p.bins + 1)}) if known else []
    trees = []
    for t, target in enumerate(TARGETS):
        actual = [r[5 + t] for r in data]
        used = [i for i, v in enumerate(actual) if not gone(v)]
        start = sum(actual[i] for i in used) / len(used)
        trees.append((target, -1, 0, None, None, None, None, start))
        residual = {i: actual[i] - start for i in used}
        for number in range(p.rounds):
            level = {0: used}
            for node in range(2 ** (p.depth + 1) - 1):
                here = level.get(node)
                if not here:
                    continue
                s, q, best = sum(residual[i] for i in here), sum(residual[i] ** 2 for i in here), None
                value = p.rate * s / (len(here) + p.l2)
                if node < 2**p.depth - 1 and q > 0:
                    for f, name in enumerate(FEATURES):
                        for e, edge in enumerate(edges[name]):
                            for missing_left in (True, False):
                                left = [i for i in here if (missing_left if columns[name][i] is None else columns[name][i] <= edge)]
                                right = len(here) - len(left)
                                if len(left) < p.least_rows or right < p.least_rows:
                                    continue
                                sl = sum(residual[i] for i in left)
                                gain = sl**2 / (len(left) + p.l2) + (s - sl) ** 2 / (right + p.l2) - s**2 / (len(here) + p.l2)
                                key = (-math.floor(gain / q * B.STEPS + 0.5), f, e, not missing_left)
                                if key[0] <= -1 and (best is None or key < best[0]):
                                    best = (key, name, edge, missing_left, gain, left)
                if best is None:
                    trees.append((target, number, node, None, None, None, len(here), value))
                    for i in here:
                        residual[i] -= value
                else:
                    _, name, edge, missing_left, gain, left = best
                    trees.append((target, number, node, name, edge, missing_left, len(here), gain))
                    level[2 * node + 1], level[2 * node + 2] = left, [i for i in here if i not in set(left)]
    return trees


def fitted(spark, data, p, parts=3):
    return B.boost(spark.createDataFrame(data, SCHEMA).repartition(parts), FEATURES, TARGETS, p)


def shown(trees):
    return sorted((r["target"], r["tree"], r["node"], r.get("feature"), r.get("threshold"), r.get("missing_left"), r.get("rows"),
                   round(r["value"] if r.get("feature") is None else r["gain"], 9)) for r in trees)


@pytest.mark.parametrize("p", [Boosting(rounds=3, depth=3, rate=0.5, bins=6, least_rows=4), Boosting(rounds=2, depth=2, rate=1.0, bins=200, l2=0.0)])
def test_trees_equal_a_plain_trainer(spark, p):
    data = rows()
    assert shown(fitted(spark, data, p)) == sorted((*r[:7], round(r[7], 9)) for r in plain_trees(data, p))


def test_partitions_blocks_and_written_rounds_do_not_change_a_tree(spark, monkeypatch):
    data, p = rows(), Boosting(rounds=5, depth=3, rate=0.3, bins=16)
    want = shown(fitted(spark, data, p, parts=1))
    monkeypatch.setattr(B, "BLOCK_ROWS", 7)
    monkeypatch.setattr(B, "KEPT_ROUNDS", 2)
    monkeypatch.setattr(B, "SLAB_CELLS", 1)
    assert shown(fitted(spark, data, p, parts=7)) == want


def test_deep_trees_equal_a_plain_trainer(spark):
    data, p = rows(150), Boosting(rounds=1, depth=8, rate=0.5, bins=5)
    assert shown(fitted(spark, data, p)) == sorted((*r[:7], round(r[7], 9)) for r in plain_trees(data, p))


def test_tasks_follow_the_rows_and_features_alone_or_in_pairs_make_the_same_trees(spark, monkeypatch):
    data, p, made = rows(), Boosting(rounds=3, depth=3, rate=0.3, bins=16), []
    want = shown(fitted(spark, data, p))
    grow = B._grow_level
    monkeypatch.setattr(B, "_grow_level", lambda blocks, *rest: made.append(blocks.getNumPartitions()) or grow(blocks, *rest))
    monkeypatch.setattr(B, "TASK_ROWS", 20)
    monkeypatch.setattr(B, "COUNTED_ROWS", 3)
    monkeypatch.setattr(B, "PAIR_CELLS", 1)
    assert shown(fitted(spark, data, p)) == want
    assert set(made) == {24}  # 8 cores, 3 times 20 rows or fewer


def test_below_the_root_only_smaller_children_are_counted():
    rng = np.random.default_rng(4)
    codes, residuals, missing = rng.integers(0, 6, (3, 500)).astype(np.uint8), rng.normal(size=(2, 500)), 5
    residuals[1, ::7] = np.nan
    blocks = [(n, codes[:, a : a + n].tobytes(), residuals[:, a : a + n].tobytes()) for a, n in ((0, 200), (200, 300))]
    trees, slabs, above = [B.Tree(2), B.Tree(2)], [(0, 2), (2, 3)], []
    for level in (0, 1):
        counted = [payload for part in (0, 1) for payload in B._histograms(trees, level, slabs, missing)(part, iter(blocks[part : part + 1]))]
        above = list(B._totals(trees, level, slabs, missing)(iter(sorted(above + counted))))
        if level == 0:
            for t, tree in enumerate(trees):
                tree.feature[0], tree.edge[0], tree.missing_left[0] = t, 1 + 2 * t, t == 1
                nodes = tree.reached(codes, 1, missing)
                tree.rows[:3] = [(~np.isnan(residuals[t])).sum(), *[((nodes == n) & ~np.isnan(residuals[t])).sum() for n in (1, 2)]]
    small = [np.frombuffer(payload)[4:].reshape(2, -1, 2, 1, 6) for _, payload in counted]
    assert sum(x[1, 0, t].sum() for x in small[::2] for t in (0, 1)) == sum(min(tree.rows[1:3]) for tree in trees)
    for (slab, _), payload in above:
        a, b = slabs[slab]
        sums, counts = np.frombuffer(payload)[4:].reshape(2, b - a, 2, 2, 6)
        for f, t, node, code in np.ndindex(b - a, 2, 2, 6):
            here = (trees[t].reached(codes, 1, missing) == node + 1) & (codes[a + f] == code) & ~np.isnan(residuals[t])
            assert counts[f, t, node, code] == here.sum() and sums[f, t, node, code] == pytest.approx(residuals[t, here].sum())


def test_constant_missing_and_absent_targets(spark):
    data = [(i, float(i), 1, None, None, 2.0, None) for i in range(10)]
    found = fitted(spark, data, Boosting(rounds=2, depth=2))
    assert shown([r for r in found if r["target"] == "y"]) == [("y", -1, 0, None, None, None, None, 2.0)] + [("y", t, 0, None, None, None, 10, 0.0) for t in (0, 1)]
    assert [r["value"] for r in found if r["target"] == "z"] == [None]
    with pytest.raises(ValueError, match="2 to 254 bins"):
        fitted(spark, data, Boosting(bins=255))


def test_a_share_of_rows_with_many_columns_is_planned(spark):
    frame = spark.range(3_000).selectExpr(*[f"cast(id % {i + 2} as double) as f{i}" for i in range(32)])
    edges = B.bin_edges(frame, frame.columns, 4, 1_000)  # the optimizer ran out of memory over 2^32 conditions
    assert [len(e) for e in edges[:3]] == [2, 3, 4] and all(0 < len(e) <= 4 for e in edges)


def test_bins_of_large_tables_come_from_a_share_of_the_rows(spark):
    frame = spark.range(20_000).selectExpr("cast(id as double) as a")
    few, all_rows = (B.bin_edges(frame, ["a"], 10, n)[0] for n in (2_000, 10**6))
    assert len(few) == len(all_rows) == 10 and np.abs(few - all_rows).max() < 1_500
    assert (few == B.bin_edges(frame.repartition(5), ["a"], 10, 2_000)[0]).all()
    # Values above the last edge of a share are not missing ones.
    assert B.coded(np.array([np.nan, 1e9]), few, 11).tolist() == [11, 10]


def test_bins_of_large_tables_come_from_all_rows(spark):
    rng = random.Random(5)
    draw = lambda: rng.choice([None, math.nan, math.inf, -math.inf, -0.5, 7.0, *[rng.gauss(0, 1) for _ in range(9)]])
    data = [(draw(), rng.randrange(3), float(i), None) for i in range(30_000)]
    frame = spark.createDataFrame(data, "a double, b int, c double, none double").repartition(6)
    small, large = (B.bin_edges(frame, frame.columns, 64, n) for n in (10**6, 2_000))
    assert [e.tolist() for e in large] == [e.tolist() for e in small] and len(large[0]) > 40 and not len(large[3])
    known = sorted(a for a, *_ in data if a is not None and not math.isnan(a))
    assert large[0].tolist() == sorted({known[math.ceil(i * len(known) / 64) - 1] for i in range(1, 65)})
    assert large[1].tolist() == [0, 1, 2] and large[2].tolist() == [math.ceil(i * 30_000 / 64) - 1 for i in range(1, 65)]


def test_a_run_on_a_large_table_takes_its_thresholds_from_all_rows(spark):
    data = rows(600)
    small, large = (Boosting(rounds=2, depth=2, rate=0.5, bins=8, bin_rows=n) for n in (10**6, 100))
    want = sorted((*r[:7], round(r[7], 9)) for r in plain_trees(data, small))
    assert shown(fitted(spark, data, large)) == want == shown(fitted(spark, data, small))


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models"))
    parameters = training.ParameterSet("gbt_test", "Test", Boosting(rounds=4, depth=3, rate=0.5, bins=12))
    trained = training.TrainedModels(parameters, FEATURES, TARGETS, fitted(spark, rows(), parameters.boosting))
    trained.save(spark, path)
    loaded = training.load_models(spark, path, parameters, FEATURES, TARGETS)
    new = rows(80, seed=9)
    scored = loaded.predict(spark.createDataFrame(new, SCHEMA)).collect()
    predictions = {(t, r["id"]): r[f"_prediction_{t}"] for r in scored for t in TARGETS}
    connection = duckdb.connect()
    connection.execute("CREATE TABLE long (id BIGINT, feature VARCHAR, x DOUBLE)")
    for r in new:
        values = [None if v is None or math.isnan(v) else float(v) for v in r[1:5]]
        connection.executemany("INSERT INTO long VALUES (?, ?, ?)", [(r[0], name, v) for name, v in zip(FEATURES, values)])
    connection.sql(f"CREATE VIEW trees AS SELECT * FROM read_parquet('{path}/*/*.parquet')")
    return path, trained, predictions, connection


def test_sql_replays_the_saved_trees(saved):
    _, _, predictions, connection = saved
    found = connection.sql("""
        WITH RECURSIVE walk AS (
          SELECT id, target, tree, 0 AS node FROM (SELECT DISTINCT id FROM long) CROSS JOIN (SELECT DISTINCT target, tree FROM trees)
          UNION ALL
          SELECT w.id, w.target, w.tree, CASE WHEN CASE WHEN x IS NULL THEN missing_left ELSE x <= threshold END THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END
          FROM walk w JOIN trees t ON t.target = w.target AND t.tree = w.tree AND t.node = w.node JOIN long ON long.id = w.id AND long.feature = t.feature)
        SELECT w.target, id, sum(value) FROM walk w JOIN trees t ON t.target = w.target AND t.tree = w.tree AND t.node = w.node AND t.feature IS NULL GROUP BY ALL""").fetchall()
    assert {(t, i): v for t, i, v in found} == pytest.approx(predictions)


def test_a_join_with_leaf_intervals_predicts(spark, saved):
    _, trained, predictions, connection = saved
    intervals = B.leaf_intervals(trained.table(spark)).toPandas()  # noqa: F841
    found = connection.sql("""
        WITH needed AS (SELECT target, tree, leaf, value, count(feature) AS n FROM intervals GROUP BY ALL),
        met AS (SELECT id, target, tree, leaf, count(*) AS n FROM intervals i JOIN long ON long.feature = i.feature
          WHERE CASE WHEN x IS NULL THEN missing ELSE (above IS NULL OR x > above) AND (up_to IS NULL OR x <= up_to) END GROUP BY ALL),
        reached AS (SELECT id, m.target, value FROM met m JOIN needed k USING (target, tree, leaf, n)
          UNION ALL SELECT id, target, value FROM (SELECT DISTINCT id FROM long) CROSS JOIN needed WHERE n = 0
          UNION ALL SELECT id, target, value FROM (SELECT DISTINCT id FROM long) CROSS JOIN trees WHERE tree = -1)
        SELECT target, id, sum(value) FROM reached GROUP BY ALL""").fetchall()
    assert {(t, i): v for t, i, v in found} == pytest.approx(predictions)


def test_total_and_average_gain(spark, saved):
    path, trained, _, connection = saved
    table = trained.table(spark)
    for average, how in ((False, "sum"), (True, "avg")):
        want = connection.sql(f"SELECT target, feature, {how}(gain) FROM trees WHERE feature IS NOT NULL GROUP BY ALL").fetchall()
        want = {(t, f): g for t, f, g in want}
        for scores in (training.gain_scores(table, average), training.saved_gain_scores(spark, path, "gbt_test", TARGETS, average)):
            assert {(r["target"], r["feature"]): r["gain"] for r in scores.collect()} == pytest.approx(want)
    assert {f for _, f in want} <= {"a", "b", "c"} and len(want) >= 4
