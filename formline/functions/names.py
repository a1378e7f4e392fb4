"""Feature names: how they are formed, and how groups of features are found again in a schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, NumericType

from formline import fixed_values as fv


def rolling_name(target: str, games: int, statistic: str) -> str:
    return f"{target.lower()}_rolling_{games}g_{statistic}"


def history_name(target: str, scope: str, statistic: str) -> str:
    return f"{target.lower()}_{scope}_{statistic}"


def cumulative_name(target: str) -> str:
    return f"{target.lower()}_season_cumulative_total"


def lag_name(target: str) -> str:
    return f"{target.lower()}_lag_1"


def change_name(target: str) -> str:
    return f"{target.lower()}_change_from_previous"


def _group_of(name: str) -> str | None:
    if "_rolling_" in name and name.endswith(("_avg", "_std")):
        return "rolling"
    if ("_season_" in name or "_career_" in name) and name.endswith(("_min", "_max")):
        return "min_max"
    for group, ending in (("cumulative", "_season_cumulative_total"), ("lag", "_lag_1"),
                          ("change", "_change_from_previous")):
        if name.endswith(ending):
            return group
    return None


def feature_groups(columns: Iterable[str]) -> dict[str, list[str]]:
    """The time-series columns of a schema by group, each group in schema order."""
    groups: dict[str, list[str]] = {"rolling": [], "min_max": [], "cumulative": [], "lag": [], "change": []}
    for column in columns:
        group = _group_of(column)
        if group:
            groups[group].append(column)
    return groups


def time_series_columns(df: DataFrame) -> list[str]:
    return [column for group in feature_groups(df.columns).values() for column in group]


def feature_group_counts(df: DataFrame) -> dict[str, int]:
    counts = {group: len(columns) for group, columns in feature_groups(df.columns).items()}
    return counts | {"features": sum(counts.values()), "columns": len(df.columns)}


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric and boolean columns in table order, without the excluded ones."""
    left_out = set(exclude)
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, (NumericType, BooleanType)) and field.name not in left_out
    ]


def model_feature_columns(df: DataFrame, targets: Iterable[str] = fv.TARGETS) -> list[str]:
    """Columns a model may see: no targets, no identifiers, no text sources, nothing of the same game."""
    return numeric_columns(
        df, [*targets, *fv.IDENTIFIER_COLUMNS, *fv.CATEGORICAL_SOURCE_COLUMNS, *fv.SAME_GAME_RESULT_COLUMNS]
    )


def target_file_name(model: str, target: str) -> str:
    return f"{model}_{target.lower()}"
