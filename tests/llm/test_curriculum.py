import random
import re

import pytest
from pyspark.sql import functions as F

from formline.llm import curriculum as M

SCHEMA = "doc_id long, source string, size long, target string, copies string"


def rows(n=600, seed=1):
    rng = random.Random(seed)
    pick = lambda: rng.choice(["hot"] * 6 + ["Zeta", "alpha", "éclair", None, "beta", "zz"])
    out = [(i, pick(), rng.choice([0, 1, 5, 40, 200, 1500]), "clash", "clash") for i in range(n)]
    return out + [(7, "alpha", 90, "clash", "clash")] * 5 + [(900, "only zeros", 0, "", ""), (901, "one", 13, "", ""), (None, "beta", None, "", "")]


def targets(sizes, share=1.5, cap=2.0):
    """Water filling by rounds, as the rule is worded."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    stopped, total = set(), share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(cap * sizes[s] for s in stopped)
        want = {s: left * weight[s] / sum(weight[f] for f in free) for s in free} if free else {}
        over = {s for s in free if want[s] > cap * sizes[s] + 1e-9}
        if not over:
            return {s: cap * sizes[s] if s in stopped else want[s] for s in names}
        stopped |= over


@pytest.mark.parametrize("run_rows", [10, 10_000])
def test_targets_and_what_is_taken(spark, run_rows):
    data = rows()
    frame = spark.createDataFrame(data, SCHEMA).repartition(5)
    found = M.curriculum_plan(frame, run_rows=run_rows).collect()
    assert len(found) == len(data)
    sizes = {}
    for _, s, n, _, _ in data:
        sizes[s] = sizes.get(s, 0) + (n or 0)
    want = targets(sizes)
    for s in sizes:
        mine = [r for r in found if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]} and [r["target"] for r in mine] == [pytest.approx(want[s])] * len(mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= max(r["size"] or 0 for r in mine) / 2 + 1e-6
    assert all(r["taken"] == r["copies"] * (r["size"] or 0) <= 2 * (r["size"] or 0) and len(r["positions"]) == r["copies"] for r in found)
    assert all(0 <= p <= 1 for r in found for p in r["positions"])
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_agree_whatever_the_partitions(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    one, two = (sorted(map(str, M.curriculum_plan(f, run_rows=50).collect())) for f in (frame.repartition(3), frame.repartition(7)))
    assert one == two
    assert one != sorted(map(str, M.curriculum_plan(frame, run_rows=50, seed=5).collect()))


def test_positions_invert_the_integrated_schedule(spark):
    for slope in (-0.9, -0.5, 0.0, 0.5, 0.9):
        grid = spark.range(0, 101).select((F.col("id") / 100).alias("t")).withColumn("q", F.col("t") + slope * (F.col("t") ** 2 - F.col("t")))
        found = grid.select("t", M.position_at(F.col("q"), F.lit(slope)).alias("back")).collect()
        assert all(r["back"] == pytest.approx(r["t"], abs=1e-9) for r in found)


def test_consumption_follows_the_curve_of_each_source(spark):
    data = [(i, f"s{i % 3}", 10, "", "") for i in range(3_000)]
    mixed = M.curriculum_rows(M.curriculum_plan(spark.createDataFrame(data, SCHEMA), run_rows=100)).collect()
    positions = [r["position"] for r in mixed]
    assert positions == sorted(positions)
    for source, slope in (("s0", -0.5), ("s1", 0.0), ("s2", 0.5)):
        mine = [r["position"] for r in mixed if r["source"] == source]
        for t in (0.1, 0.3, 0.5, 0.8):
            assert sum(p <= t for p in mine) == pytest.approx(len(mine) * (t + slope * (t * t - t)), abs=2)


def test_word_counts(spark):
    texts = [None, "", "  a\tb\nc\x0bd\x0ce\rf ", "a b c d", "é " * 500, "x"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select(M.word_count(F.col("text")).alias("n"))
    assert [r["n"] for r in frame.collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_empty_table_and_no_sizes(spark):
    assert M.curriculum_plan(spark.createDataFrame([], SCHEMA)).count() == 0
    none = M.curriculum_plan(spark.createDataFrame([(1, None, None, "", ""), (2, "a", 0, "", "")], SCHEMA)).collect()
    assert [(r["copies"], r["taken"], r["target"]) for r in none] == [(0, 0, 0.0)] * 2


def test_main_path_is_native(spark):
    plan = M.curriculum_rows(M.curriculum_plan(spark.createDataFrame(rows(), SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
