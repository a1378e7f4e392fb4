"""From the full feature table to trained models and importance tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from formline import fixed_values as fv
from formline.operators import importance as I
from formline.operators import reshape, split, training
from formline.operators.layout import stored
from formline.operators.split import ModellingData
from formline.operators.training import ParameterSet


def prepare_modelling_data(
    features: DataFrame, test_size: float = fv.TEST_SIZE, targets: Sequence[str] = fv.TARGETS,
    keys: Sequence[str] = split.KEY_COLUMNS, date: str = "GAME_DATE",
) -> tuple[ModellingData, DataFrame]:
    """The labelled feature and target table, and its metadata row."""
    labelled = split.label_split(features, date, test_size)
    modelling = split.feature_target_table(labelled, targets, keys)
    return modelling, split.split_metadata(modelling, test_size, date)


def train_and_evaluate(
    modelling: ModellingData, parameters: ParameterSet, models_path: str | None = None
) -> tuple[DataFrame, DataFrame, training.TrainedModels]:
    return training.train_all_targets(modelling, parameters, models_path)


def importance_analysis(scores: DataFrame, features: Sequence[str], model: str) -> dict[str, DataFrame]:
    """The importance table and the reports made from it. The table is stored, so the scores are read once."""
    table = stored(I.importance_table(scores, features, model), "importance")
    summary = I.family_summary(table)
    pivoted = reshape.pivot_family(summary)
    return {
        "importance": table,
        "family_summary": summary,
        "family_pivot": pivoted,
        "family_extremes": I.family_extremes(pivoted),
        "top_features": I.top_features(table),
    }
