"""Readers: CSV game logs and lookups, Parquet features, JSON reports."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.operators.evaluate import model_metrics, prediction_error

PLAYER_INFO_TYPES = {"PLAYER_ID": "long", "WEIGHT": "double", "SEASON_EXP": "int", "FROM_YEAR": "int", "TO_YEAR": "int"}
DEFENSE_TYPES = {
    "TEAM_ID": "long", "GP": "int", "W": "int", "L": "int", "W_PCT": "double", "E_DEF_RATING": "double",
    "DEF_RATING": "double", "DEF_RATING_RANK": "int", "PACE": "double", "POSS": "long",
}
SELECTED_TYPES = {
    "PLAYER_ID": "long", "TEAM_ID": "long", "current_games": "long", "current_minutes": "double",
    "previous_games": "long", "previous_minutes": "double", "selection_score": "double", "FROM_YEAR": "double",
    "TO_YEAR": "double",
}


CSV_OPTIONS = {"nullValue": fv.NULL_SENTINEL}


def read_text_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files with headers, all columns as text, ``NA`` as NULL.

    ``path`` is a file, a folder or a list of them. Files may order their columns differently and lack some:
    columns are aligned by name, and what a file lacks is NULL in its rows. Files that share one header
    go through the CSV source as they are. Fields must not contain line ends where headers differ.
    """
    headers = file_headers(spark, path)
    # As many rows as there are different headers, each of the length of a schema.
    kinds = headers.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()
    if len(kinds) < 2:
        # With enforceSchema off, a file whose header differs from the first raises instead of shifting columns.
        return spark.read.options(header=True, enforceSchema=False, **CSV_OPTIONS).csv(path)
    return _aligned(spark, path, headers, [kind["header"] for kind in kinds])


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header): the first line of every file that has one."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value", F.monotonically_increasing_id().alias("at"))
    return lines.filter("begin = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))


def _aligned(spark: SparkSession, path: str | list[str], headers: DataFrame, kinds: list[str]) -> DataFrame:
    """All lines as one frame, each read under the header of its file; a line equal to it is no row."""
    width = max(len(next(csv.reader([kind]))) for kind in kinds)
    names = {kind: next(csv.reader([kind])) for kind in kinds}
    columns = list(dict.fromkeys(name for kind in kinds for name in names[kind]))
    # The place of every column under each header, from 1; no place is NULL.
    places = spark.createDataFrame(
        [(kind, *[names[kind].index(name) + 1 if name in names[kind] else None for name in columns]) for kind in kinds],
        ", ".join(["header string", *[f"p{i} int" for i in range(len(columns))]]))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").filter(F.trim("value") != "")
    placed = lines.join(headers.join(F.broadcast(places), "header"), "file").filter(F.col("value") != F.col("header"))
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)), CSV_OPTIONS)
    parsed = placed.withColumn("fields", fields).withColumn("fields", F.array(*[f"fields.c{i}" for i in range(width)]))
    return parsed.select(*[F.get("fields", F.col(f"p{i}") - 1).alias(name) for i, name in enumerate(columns)])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text to the given types, for those of the columns that exist; malformed values become NULL."""
    whole = ("int", "long")
    return df.withColumns({
        name: C.to_whole_number(name, kind) if kind in whole else F.col(name).try_cast(kind)
        for name, kind in types.items()
        if name in df.columns
    })


def empty_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({
        field.name: F.nullif(F.col(field.name), F.lit(""))
        for field in df.schema.fields
        if isinstance(field.dataType, StringType)
    })


def game_log_types() -> dict[str, str]:
    types = {name: "long" if name in fv.LONG_COLUMNS else "int" for name in fv.GAME_LOG_INT_COLUMNS}
    return types | {name: "double" for name in fv.GAME_LOG_DOUBLE_COLUMNS} | {"GAME_DATE": "date"}


def read_game_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Player-game logs with explicit types; columns that are not listed stay text."""
    return cast_columns(read_text_csv(spark, path), game_log_types())


def read_player_info(spark: SparkSession, path: str) -> DataFrame:
    text = empty_to_null(read_text_csv(spark, path).select(*fv.PLAYER_INFO_COLUMNS))
    return cast_columns(text, PLAYER_INFO_TYPES)


def read_opponent_defense(spark: SparkSession, path: str) -> DataFrame:
    return cast_columns(empty_to_null(read_text_csv(spark, path)), DEFENSE_TYPES)


def read_selected(spark: SparkSession, path: str) -> DataFrame:
    """A saved player selection."""
    return cast_columns(read_text_csv(spark, path), SELECTED_TYPES)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def distinct_seasons(logs: DataFrame, season: str = "SEASON") -> DataFrame:
    """The seasons that occur, by start year. Only this column is read."""
    seasons = logs.select(season).dropna().distinct()
    return seasons.orderBy(C.season_start_year(season))


def scan_distinct_seasons(spark: SparkSession, path: str) -> DataFrame:
    return distinct_seasons(read_text_csv(spark, path))


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_split_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The feature columns of a split, in order: (position, feature)."""
    document = read_json_document(spark, path)
    return document.select(F.posexplode("feature_columns").alias("position", "feature"))


def read_metrics(spark: SparkSession, path: str, model: str, label: str) -> DataFrame:
    """Metrics of one model under common names (the file holds an array of records)."""
    return model_metrics(read_json_document(spark, path), model, label)


def read_importance(spark: SparkSession, path: str, label: str) -> DataFrame:
    rows = read_json_document(spark, path).select(F.inline("all_importance"))
    return rows.withColumn("model", F.lit(label))


def read_predictions(spark: SparkSession, path: str, model: str, label: str) -> DataFrame:
    """Predictions of one model with their errors."""
    predictions = (
        spark.read.parquet(path)
        .withColumn("model", F.lit(label))
        .withColumnRenamed(f"{model}_prediction", "model_prediction")
    )
    return prediction_error(predictions)
