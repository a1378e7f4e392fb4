import re
from collections import Counter

import numpy as np
import pytest

from formline.llm import sharding as H

SCHEMA = "doc_id long, text string, slot string, shard string, c int"


@pytest.mark.parametrize("run_rows", [7, 200_000])
def test_all_rows_in_shards_of_equal_size(spark, run_rows):
    data = [(i % 400 if i % 50 else None, f"text {i % 90}" if i % 7 else None, "clash", "clash", i) for i in range(1_003)] + [(1, "same", "", "", 0)] * 300
    frame = spark.createDataFrame(data, SCHEMA).repartition(9)
    found = H.shard_uniformly(frame, 24, seed=3, run_rows=run_rows).collect()
    assert Counter((r["doc_id"], r["text"], r["c"]) for r in found) == Counter((a, b, e) for a, b, _, _, e in data)
    by_shard = Counter(r["shard"] for r in found)
    assert set(by_shard) == set(range(24)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    for shard, n in by_shard.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))


@pytest.mark.parametrize("n", [0, 1, 5, 23, 25])
def test_few_rows(spark, n):
    found = H.shard_uniformly(spark.createDataFrame([(i, None, "", "", 0) for i in range(n)], SCHEMA), 24).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(n)) and max(Counter(r["shard"] for r in found).values(), default=0) <= 2


def test_matrix_margins_and_distribution():
    rows, shards = [4, 3, 5], [4, 4, 4]
    draws = np.array([H.communication_matrix(rows, shards, seed) for seed in range(4_000)])
    assert (draws.sum(axis=2) == rows).all() and (draws.sum(axis=1) == shards).all()
    # Mean and variance of a hypergeometric count: n K / N, and n K/N (1 - K/N) (N - n) / (N - 1).
    for b, n in enumerate(rows):
        assert draws[:, b, 0].mean() == pytest.approx(n / 3, abs=0.06)
        assert draws[:, b, 2].var() == pytest.approx(n * 2 / 9 * (12 - n) / 11, abs=0.06)
    big = H.communication_matrix([3_000_000_000, 5, 900_000_000], [1_500_000_003, 2_400_000_002], 1)
    assert big.sum(axis=1).tolist() == [3_000_000_000, 5, 900_000_000] and big.sum(axis=0).tolist() == [1_500_000_003, 2_400_000_002]


def test_places_are_uniform(spark):
    frame = spark.range(0, 240, 1, 4)
    hits = np.zeros((24, 4))
    for seed in range(12):
        for r in H.shard_uniformly(frame, 24, seed=seed, run_rows=3).collect():
            hits[r["shard"], r["id"] // 60] += 1
    expected = 12 * 240 / 24 / 4
    assert (hits.sum(axis=1) == 120).all()
    assert ((hits - expected) ** 2 / expected).sum() < 120  # 69 degrees of freedom: far beyond chance


def test_partitions_that_share_a_block_reach_all_shards(spark, monkeypatch):
    monkeypatch.setattr(H, "MAX_BLOCKS", 2)
    hits = np.zeros((24, 8))
    for seed in range(8):
        found = H.shard_uniformly(spark.range(0, 480, 1, 8), 24, seed=seed).collect()
        assert sorted(r["id"] for r in found) == list(range(480)) and set(Counter(r["shard"] for r in found).values()) == {20}
        for r in found:
            hits[r["shard"], r["id"] // 60] += 1
    assert ((hits - 20) ** 2 / 20).sum() < 240  # 161 degrees of freedom: far beyond chance


def test_main_path_is_native(spark):
    plan = H.shard_uniformly(spark.range(100), 4)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
