"""Baseline, regression metrics, and comparisons of models with each other and with the baseline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.operators import reshape

METRICS = ("mae", "rmse", "r2")


def target_means(train: DataFrame, targets: Sequence[str]) -> dict[str, float]:
    row = train.agg(*[F.avg(target).alias(target) for target in targets]).first()
    return {target: row[target] for target in targets}


def baseline_predictions(
    test: DataFrame, means: Mapping[str, float], keys: Sequence[str] = ("PLAYER_ID", "GAME_ID")
) -> DataFrame:
    """Long (keys, target, actual, baseline_prediction): the train mean for every test row."""
    rows = F.array(*[
        F.struct(F.lit(target).alias("target"), F.col(target).cast("double").alias("actual"),
                 F.lit(mean).cast("double").alias("baseline_prediction"))
        for target, mean in means.items()
    ])
    return test.select(*keys, F.inline(rows))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(predicted - actual))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((predicted - actual) * (predicted - actual)))


def r2(actual: Column, predicted: Column) -> Column:
    """1 - residual / total sum of squares, and 0 where the actual values are constant."""
    total = F.var_pop(actual) * F.count(actual)
    residual = F.sum((predicted - actual) * (predicted - actual))
    return F.when(F.min(actual) == F.max(actual), 0.0).otherwise(1 - F.try_divide(residual, total))


def regression_metrics(
    predictions: DataFrame, prediction_columns: Mapping[str, str], by: Sequence[str] = ("target",),
    actual: str = "actual",
) -> DataFrame:
    """One row per group with ``<prefix>_mae``, ``<prefix>_rmse`` and ``<prefix>_r2`` per prediction column."""
    y = F.col(actual)
    return predictions.groupBy(*by).agg(*[
        metric(y, F.col(column)).alias(f"{prefix}_{name}")
        for prefix, column in prediction_columns.items()
        for name, metric in (("mae", mae), ("rmse", rmse), ("r2", r2))
    ])


def prediction_error(
    predictions: DataFrame, prediction: str = "model_prediction", actual: str = "actual"
) -> DataFrame:
    """Signed error (predicted minus actual) and its size."""
    error = F.col(prediction) - F.col(actual)
    return predictions.withColumns({"error": error, "absolute_error": F.abs(error)})


def model_metrics(metrics: DataFrame, prefix: str, label: str) -> DataFrame:
    """Metrics of one model under common names, with the label of the model."""
    return metrics.withColumnsRenamed({f"{prefix}_{m}": f"model_{m}" for m in METRICS}).select(
        F.lit(label).alias("model"), "target",
        *[f"baseline_{m}" for m in METRICS], *[f"model_{m}" for m in METRICS],
    )


def stack_models(metrics: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Metrics of several models side by side (by prefix) as one row per model, under common names."""
    rows = F.array(*[
        F.struct(
            F.lit(label).alias("model"), "target",
            *[F.col(f"baseline_{m}").alias(f"baseline_{m}") for m in METRICS],
            *[F.col(f"{prefix}_{m}").alias(f"model_{m}") for m in METRICS],
        )
        for prefix, label in labels.items()
    ])
    return metrics.select(F.inline(rows))


def metric_comparison(
    per_model: Sequence[DataFrame], targets: Sequence[str] = fv.TARGETS, digits: int | None = 3
) -> DataFrame:
    """Models stacked with the baseline, in display order of the targets."""
    columns = [f"{side}_{m}" for m in METRICS for side in ("baseline", "model")]
    shown = [F.round(c, digits).alias(c) if digits is not None else F.col(c) for c in columns]
    return (
        reshape.union_all(per_model)
        .select("model", "target", *shown, C.order_position("target", targets).cast("int").alias("target_order"))
        .orderBy("target_order", "target", "model")
    )


def evaluation_improvement(metrics: DataFrame) -> DataFrame:
    """How far the model is better than the baseline: lower errors, higher R2."""
    return metrics.withColumns({
        "mae_improvement": F.col("baseline_mae") - F.col("model_mae"),
        "rmse_improvement": F.col("baseline_rmse") - F.col("model_rmse"),
        "r2_improvement": F.col("model_r2") - F.col("baseline_r2"),
    })


def quality_tiers(metrics: DataFrame, column: str = "model_r2") -> DataFrame:
    tier = (
        F.when(F.col(column) >= fv.WELL_PREDICTED_R2, "well")
        .when(F.col(column) >= fv.MODERATELY_PREDICTED_R2, "moderate")
        .otherwise("poor")
    )
    return metrics.withColumn("tier", tier)
