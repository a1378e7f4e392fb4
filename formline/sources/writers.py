"""Writers. Tables are written by the tasks that hold them; report documents are one small row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.operators.split import ModellingData, split_metadata


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, snappy, replacing what is there. Partitioned by season, later reads skip whole seasons.

    Rows are first brought together by partition value, in pieces of even size (a large season is split
    again), so that a season has a few full files and not one per task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; NULL is written as ``NA``."""
    df.write.mode("overwrite").option("header", True).option("nullValue", fv.NULL_SENTINEL).csv(path)


def write_document(row: DataFrame, path: str) -> None:
    """A one-row frame as one JSON object."""
    row.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_records(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """A report table as one JSON array of records.

    The whole table becomes one value of one row: only for tables of a row per model, target or feature.
    """
    ordered = F.sort_array(F.collect_list(F.struct(*order, F.struct(*df.columns).alias("_record"))))
    records = df.agg(F.transform(ordered, lambda item: item["_record"]).alias("records"))
    text = F.to_json("records", {"ignoreNullFields": "false"})
    records.select(text.alias("value")).write.mode("overwrite").text(path)


def write_split(modelling: ModellingData, path: str, test_size: float = fv.TEST_SIZE) -> None:
    """Features and targets with their keys, one folder per part of the split, and the metadata document."""
    write_features(modelling.data, f"{path}/data", ["split"])
    write_document(split_metadata(modelling, test_size), f"{path}/split_metadata.json")


def write_training_outputs(metrics: DataFrame, predictions: DataFrame, path: str) -> None:
    write_features(predictions, f"{path}/model_predictions.parquet")
    write_records(metrics, f"{path}/model_metrics.json", ["target"])


def importance_document(importance: DataFrame, summary: DataFrame, model: str) -> DataFrame:
    """One row holding the top features of the primary target, the family summary and the whole table.

    All three have a row per target and feature at most, so they fit one document.
    """
    features = importance.select(
        F.struct("target", F.col("rank").cast("double").alias("place")).alias("order"),
        F.struct(*importance.columns).alias("feature_row"),
    )
    families = summary.select(
        F.struct("target", (-F.col("gain_share")).alias("place")).alias("order"),
        F.struct(*summary.columns).alias("family_row"),
    )
    entry = F.col("feature_row")
    top = (entry["target"] == fv.PRIMARY_TARGET) & (entry["rank"] <= 20)
    return features.unionByName(families, allowMissingColumns=True).agg(
        F.max(F.lit("gain")).alias("importance_type"),
        F.max(F.lit(model)).alias("model"),
        _listed("feature_row", top).alias("top_20_fantasy_points"),
        _listed("family_row", F.col("family_row").isNotNull()).alias("family_summary"),
        _listed("feature_row", entry.isNotNull()).alias("all_importance"),
    )


def _listed(column: str, condition: Column) -> Column:
    ordered = F.sort_array(F.collect_list(F.when(condition, F.struct("order", column))))
    return F.transform(ordered, lambda item: item[column])


def write_importance(importance: DataFrame, summary: DataFrame, model: str, path: str) -> None:
    write_document(importance_document(importance, summary, model), path)
