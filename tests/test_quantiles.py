import random

import numpy as np
import pytest

from formline.operators.profile import box_stats, describe_columns, histogram, outlier_summary
from formline.operators.quantiles import exact_quantiles


def quantiles_of(*arguments):
    return exact_quantiles(*arguments)[0]


PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def columns(rows=4000):
    rng = random.Random(3)
    return {
        "smooth": [rng.gauss(0, 1) for _ in range(rows)],
        "ties": [float(rng.choice([1, 1, 1, 2, 3, 50])) for _ in range(rows)],
        "half": [0.0] * (rows // 2) + [rng.random() for _ in range(rows - rows // 2)],
        "two": [float(i % 2) for i in range(rows)],
        "same": [7.0] * rows,
        "gaps": [None if i % 3 else float("nan") if i % 9 == 0 else rng.expovariate(1) for i in range(rows)],
        "empty": [None] * rows,
        "endless": [float("inf") if i % 10 == 0 else rng.random() for i in range(rows)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-8, 8) for _ in range(rows)],
    }


def expected(values, p):
    if not values:
        return None
    near = [float(np.quantile(values, p, method=method)) for method in ("lower", "higher")]
    if near[0] == near[1] or np.isinf(near[1]):  # between equal values, or next to infinity
        return near[1]
    return pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("max_values", [10_000, 300, 10])
def test_quantiles_equal_linear_interpolation(spark, max_values):
    data = columns()
    schema = ", ".join(f"{name} double" for name in data)
    df = spark.createDataFrame(list(zip(*data.values())), schema).repartition(4)
    found = quantiles_of(df, list(data), PROBABILITIES, max_values)
    for name, values in data.items():
        kept = [v for v in values if v is not None and v == v]
        for p in PROBABILITIES:
            assert found[name][p] == expected(kept, p), (name, p)


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "x double, y int")
    rows = describe_columns(empty, ["x", "y"]).collect()
    assert [(r["column"], r["count"], r["q50"], r["max"]) for r in rows] == [("x", 0, None, None), ("y", 0, None, None)]
    assert histogram(empty, "x", 5).count() == 0


def test_profile_tables(spark):
    df = spark.createDataFrame(
        [(float(i), 5.0) for i in range(1, 12)] + [(100.0, None), (None, 5.0)], "x double, flat double")
    described = {r["column"]: r for r in describe_columns(df, ["x", "flat"]).collect()}
    assert described["x"]["count"] == 12 and described["x"]["q50"] == 6.5
    assert described["flat"]["std"] == 0
    outliers = {r["column"]: r for r in outlier_summary(df, ["x", "flat"]).collect()}
    assert outliers["x"]["outlier_count"] == 1 and outliers["x"]["outlier_pct"] == pytest.approx(1 / 13)
    assert outliers["flat"]["outlier_count"] == 0
    box = {r["column"]: r for r in box_stats(df, ["x"]).collect()}["x"]
    assert (box["whisker_low"], box["whisker_high"], box["outlier_count"]) == (1, 11, 1)
    bins = {r["bin"]: r["rows"] for r in histogram(df, "x", 9).collect()}
    assert sum(bins.values()) == 12 and bins[8] == 1
    assert [r["rows"] for r in histogram(df, "flat", 9).collect()] == [12]
    shares = histogram(df.withColumn("g", df.x > 5), "x", 9, by=["g"])
    assert shares.selectExpr("sum(density * (bin_end - bin_start)) s").first()["s"] == pytest.approx(2)
