"""Unions, melts and pivots of report tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack by column name; a column that a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def pivot_family(
    summary: DataFrame, row: str = "target", column: str = "feature_family", value: str = "gain_share",
    families: Sequence[str] = fv.FAMILIES,
) -> DataFrame:
    """One row per target, one column per family, 0 where a family is absent."""
    wide = summary.groupBy(row).pivot(column, list(families)).agg(F.sum(value))
    return wide.fillna(0.0, list(families))


def series_long(
    metrics: DataFrame, metric: str, baseline_label: str = "Baseline", model: str = "model", target: str = "target"
) -> DataFrame:
    """(series, target, metric): the baseline once per target, then a series per model."""
    baseline = (
        metrics.select(target, F.col(f"baseline_{metric}").alias(metric)).distinct()
        .withColumn("series", F.lit(baseline_label))
    )
    models = metrics.select(F.col(model).alias("series"), target, F.col(f"model_{metric}").alias(metric))
    return baseline.unionByName(models)


def dataset_shapes(frames: dict[str, DataFrame]) -> DataFrame:
    """(dataset, rows, columns) of each table."""
    return union_all([
        frame.agg(
            F.count(F.lit(1)).alias("rows"),
        ).select(F.lit(name).alias("dataset"), "rows", F.lit(len(frame.columns)).cast("long").alias("columns"))
        for name, frame in frames.items()
    ])
