import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import pivot_index as V
from formline.llm import posting_search as Q

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, pivots string, list string"


def table(spark, x, ids=None, extra=()):
    ids = range(len(x)) if ids is None else ids
    data = [(int(i), [float(c) for c in row], 0, "", "", "", "") for i, row in zip(ids, x)] + list(extra)
    return spark.createDataFrame(data, SCHEMA).repartition(4)


def odd(first):
    """Vectors that take no part."""
    bad = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23]
    return [(first + i, v, None, None, None, None, None) for i, v in enumerate(bad)] + [(None, [1.0] * 24, 1, "", "", "", "")]


def clouds(seed=0, spread=0.12):
    """Unrelated vectors, clusters around the threshold, exact copies, and scaled ones; every length differs."""
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=(500, 24))]
    for size in (2, 5, 60, 250):
        centre = rng.normal(size=24)
        x.append(centre + spread * np.linalg.norm(centre) / 4.9 * rng.normal(size=(size, 24)) * rng.uniform(0.2, 2.2, (size, 1)))
    x = np.concatenate(x)
    return np.concatenate([x, x[:3], x[500:502], x[700:705] * 3]).astype(np.float32).astype(float)


def links(x, threshold=0.9):
    y = x / np.linalg.norm(x, axis=1)[:, None]
    near = y @ y.T >= threshold
    np.fill_diagonal(near, False)
    return near


def components(near):
    label = np.arange(len(near))
    while True:
        low = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1))
        if (low == label).all():
            return label
        label = low


@pytest.mark.parametrize("block", [2_000, 40])
def test_links_and_groups_against_brute_force(spark, block):
    x = clouds()
    near = links(x)
    found = {r["vec_id"]: r for r in V.near_duplicate_vectors(table(spark, x, extra=odd(10_000)), block_rows=block).collect()}
    assert len(found) == len(x) + 7
    got, want = np.array([found[i]["n_links"] for i in range(len(x))]), near.sum(axis=1)
    assert (got <= want).all() and got.sum() >= 0.97 * want.sum()
    label = components(near)
    assert np.mean([found[i]["component_id"] == label[i] for i in range(len(x))]) >= 0.98
    assert all(found[i]["kept"] == (found[i]["component_id"] == i) for i in range(len(x)))
    for i in range(10_000, 10_006):
        assert tuple(found[i]) == (i, 0, i, True)
    assert tuple(found[None]) == (None, 0, None, False)


def test_cuts_of_a_long_list_find_the_same(spark):
    x = clouds(3)
    one, two = (sorted(map(tuple, V.near_duplicate_vectors(table(spark, x), block_rows=b).collect())) for b in (5_000, 25))
    assert one == two


def test_vector_duplicates_of_empty_tables(spark):
    assert V.near_duplicate_vectors(table(spark, [])).count() == 0
    alone = V.near_duplicate_vectors(table(spark, [], extra=odd(0))).collect()
    assert len(alone) == 7 and {r["n_links"] for r in alone} == {0}


def answers(x, ids, asked, k=5):
    y = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for q in asked:
        score = y @ y[ids.index(q)]
        order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-round(score[j], 12), ids[j]))[:k]
        out[q] = [(ids[j], score[j]) for j in order]
    return out


@pytest.mark.parametrize("block", [4_000, 30])
def test_nearest_against_brute_force(spark, block):
    x = np.concatenate([clouds(5), clouds(6)])
    ids = random.Random(1).sample(range(5_000), len(x))
    frame = table(spark, x, ids, odd(9_000))
    asked = [i for i in ids if i % 7 == 0]
    found = Q.nearest_neighbours(frame, frame.filter("vec_id % 7 = 0"), block_rows=block, block_queries=50).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    want = answers(x, ids, asked)
    assert set(got) == set(asked) and all(len(v) == 5 for v in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in asked])
    assert recall >= 0.93
    true = {q: dict(answers(x, ids, [q], len(ids))[q]) for q in asked[:30]}
    for q in asked[:30]:
        assert all(s == pytest.approx(true[q][i], abs=1e-12) for i, s in got[q])
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)


def test_ties_go_to_smaller_ids_and_copies_are_found(spark):
    x = np.tile(np.arange(1.0, 25.0), (40, 1))
    frame = table(spark, np.concatenate([x, np.eye(24)]))
    found = Q.nearest_neighbours(frame, frame.filter("vec_id in (0, 3, 39)")).collect()
    got = {q: [r["id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 3, 39)}
    assert got == {0: [1, 2, 3, 4, 5], 3: [0, 1, 2, 4, 5], 39: [0, 1, 2, 3, 4]}


def test_many_different_vectors_that_tie_go_to_smaller_ids():
    ids, points = list(range(299, -1, -1)), np.tile(np.eye(24)[5], (300, 1)) * 2.0 ** (np.arange(300) % 60 - 30)[:, None]
    rows = Q.pd.DataFrame({"id": ids, "vector": list(points)})
    queries = Q.pd.DataFrame({"id": [1_000, 1_001], "vector": [np.eye(24)[5], np.eye(24)[5] + np.eye(24)[6]]})
    found = Q._meet(6)(queries, rows)
    assert found["query_id"].tolist() == [1_000] * 6 + [1_001] * 6 and found["id"].tolist() == list(range(6)) * 2


def test_few_and_no_candidates(spark):
    frame = table(spark, np.eye(24)[:3], extra=odd(100))
    assert Q.nearest_neighbours(frame, frame).groupBy("query_id").count().select(F.min("count"), F.max("count")).first() == (2, 2)
    assert Q.nearest_neighbours(table(spark, []), table(spark, [])).count() == 0
    assert Q.nearest_neighbours(table(spark, [], extra=odd(0)), frame).count() == 0


def test_graph_finds_the_nearest_centroids():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(6_000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    centres = Q.balanced_centroids(x, 200)
    assert centres.shape == (200, 24)
    nearest = np.bincount((x @ centres.T).argmax(axis=1), minlength=200)
    assert nearest.min() > 0 and nearest.max() < 8 * nearest.mean()
    numbers, sims = Q.CentroidGraph.build(centres).search(x[:300])
    assert np.mean(numbers[:, 0] == (x[:300] @ centres.T).argmax(axis=1)) > 0.97
    assert (np.diff(sims, axis=1) <= 1e-12).all() and all(len(set(n)) == len(n) for n in numbers.tolist())
