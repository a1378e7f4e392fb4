"""Queries that write files and read them back: logs, lookups, features, split, training outputs, importance."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.operators import evaluate, importance, reshape, split
from formline.operators.layout import scratch_path
from formline.sources import readers, writers
from formline.suite.adapters import CUTOFF_SQL, DEFENSE_SQL, LOGS_SQL, LOGS_WITH_LINES_SQL, PROFILES_SQL, customer_profiles, order_logs, \
    order_logs_with_lines, region_defense
from formline.suite.evaluation import FEATURE_NAMES, IMPORTANCE_CTES, LABELLED_SQL, FAMILY_SQL, METRIC_CTES, MODELS, PREDICTOR_CTES, importance_rows, \
    modelling_features, predictor_table
from formline.suite.registry import Tables, day_text, publish, query, rounded, whole, with_ctes

KEYS = '"PLAYER_ID", "GAME_ID"'


def written_seasons(t: Tables) -> str:
    """A folder of CSV files whose headers differ: a season's columns are in an order of its own, and one kind of file lacks REB."""
    path = scratch_path(t.spark, "seasons")
    logs = order_logs_with_lines(t).withColumnRenamed("PTS", "FANTASY_PTS")
    kinds = [list(logs.columns), list(reversed(logs.columns)), ["AST", "GAME_ID", "SEASON", "PLAYER_ID", "FANTASY_PTS", "GAME_DATE"]]
    for i, columns in enumerate(kinds):
        writers.write_csv(logs.filter(F.pmod(F.year("GAME_DATE"), F.lit(3)) == i).select(*columns), f"{path}/part={i}")
    return path


@query("read_game_logs", with_ctes([LOGS_SQL, LOGS_WITH_LINES_SQL], f"""
SELECT {KEYS}, {day_text('"GAME_DATE"')} AS "GAME_DATE", "SEASON", {rounded('"PTS"', 2)} AS "FANTASY_PTS",
  CASE WHEN year("GAME_DATE") % 3 < 2 THEN CAST("REB" AS BIGINT) END AS "REB", CAST("AST" AS BIGINT) AS "AST" FROM wide_logs"""))
def read_game_logs(t: Tables):
    """Season files with three different headers, read as one table of typed columns."""
    path = written_seasons(t)
    logs = readers.read_game_logs(t.spark, [f"{path}/part={i}" for i in range(3)])
    return publish(logs.select("PLAYER_ID", "GAME_ID", "GAME_DATE", "SEASON", "FANTASY_PTS", "REB", "AST"), 2)


@query("scan_distinct_seasons", with_ctes([LOGS_SQL], 'SELECT DISTINCT "SEASON" FROM logs'))
def scan_distinct_seasons(t: Tables):
    path = written_seasons(t)
    return publish(readers.scan_distinct_seasons(t.spark, [f"{path}/part={i}" for i in range(3)]))


@query("read_player_info", with_ctes([PROFILES_SQL], f"""
SELECT id AS "PLAYER_ID", strftime(birth, '%Y-%m-%d') || 'T00:00:00' AS "BIRTHDATE", CAST(inches // 12 AS VARCHAR) || '-' || inches % 12 AS "HEIGHT",
  position AS "POSITION", {whole('from_year')} AS "FROM_YEAR", pick AS "DRAFT_PICK", {rounded('id % 100 + 150.5', 2)} AS "WEIGHT",
  CASE WHEN id % 3 > 0 THEN 'school ' || id % 3 END AS "SCHOOL" FROM profiles"""))
def read_player_info(t: Tables):
    """Profiles as a CSV file with all columns of the source; missing texts come back as NULL, empty ones too."""
    path = scratch_path(t.spark, "info")
    player = F.col("PLAYER_ID")
    known = customer_profiles(t).withColumns({
        "WEIGHT": player % 100 + F.lit(150.5), "SCHOOL": F.when(player % 3 > 0, F.concat(F.lit("school "), (player % 3).cast("string"))).otherwise("")})
    rest = {name: F.lit(None).cast("string") for name in fv.PLAYER_INFO_COLUMNS if name not in known.columns}
    writers.write_csv(known.withColumns(rest).select(*reversed(fv.PLAYER_INFO_COLUMNS)), path)
    info = readers.read_player_info(t.spark, path)
    return publish(info.select("PLAYER_ID", "BIRTHDATE", "HEIGHT", "POSITION", "FROM_YEAR", "DRAFT_PICK", "WEIGHT", "SCHOOL"), 2)


@query("read_opponent_defense", with_ctes([DEFENSE_SQL], f"""
SELECT d_season AS "SEASON", d_team AS "TEAM_ID", {rounded('w_pct', 8)} AS "W_PCT", {rounded('def_rating')} AS "DEF_RATING" FROM defense"""))
def read_opponent_defense(t: Tables):
    path = scratch_path(t.spark, "defense")
    writers.write_csv(region_defense(t), path)
    return publish(readers.read_opponent_defense(t.spark, path), 4, W_PCT=8)


@query("read_selected", f"""
SELECT c_custkey AS "PLAYER_ID", CAST(c_nationkey AS BIGINT) AS "TEAM_ID", {rounded('c_acctbal', 2)} AS selection_score,
  CASE WHEN c_custkey % 4 > 0 THEN CAST(1990 + c_custkey % 6 AS DOUBLE) END AS "FROM_YEAR" FROM customer WHERE c_mktsegment = 'BUILDING'""")
def read_selected(t: Tables):
    """A saved selection: whole and broken numbers, and years that may be missing."""
    path = scratch_path(t.spark, "selected")
    key = F.col("c_custkey")
    writers.write_csv(t.customer.filter("c_mktsegment = 'BUILDING'").select(
        key.alias("PLAYER_ID"), F.col("c_nationkey").alias("TEAM_ID"), F.col("c_acctbal").alias("selection_score"),
        F.when(key % 4 > 0, F.concat((1990 + key % 6).cast("string"), F.lit(".0"))).alias("FROM_YEAR")), path)
    selected = readers.read_selected(t.spark, path)
    return publish(selected.select("PLAYER_ID", F.col("TEAM_ID"), "selection_score", "FROM_YEAR"), 2)


@query("read_features", with_ctes([LOGS_SQL], f"""
SELECT {KEYS}, "SEASON", {rounded('"PTS"', 2)} AS "PTS" FROM logs WHERE "SEASON" = '1996-97'"""))
def read_features(t: Tables):
    """Features written by season; one season is read, from its own folder."""
    path = scratch_path(t.spark, "features")
    writers.write_features(order_logs(t), path, ["SEASON"])
    season = readers.read_features(t.spark, path).filter(F.col("SEASON") == "1996-97")
    return publish(season.select("PLAYER_ID", "GAME_ID", "SEASON", "PTS"), 2)


@query("write_split", with_ctes([LOGS_SQL, CUTOFF_SQL, LABELLED_SQL], f"""
SELECT split, count(*) AS rows, {rounded('sum("PTS") / 1000', 2)} AS thousand_points, '{','.join(FEATURE_NAMES)}' AS features FROM labelled GROUP BY split"""))
def write_split(t: Tables):
    """The written parts of the split, and the feature list as the metadata document keeps it."""
    path = scratch_path(t.spark, "split")
    data = split.feature_target_table(split.label_split(modelling_features(t)), ["PTS"])
    writers.write_split(data, path)
    listed = readers.read_split_metadata(t.spark, f"{path}/split_metadata.json")
    names = listed.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "feature"))), lambda x: x["feature"]), ",").alias("features"))
    parts = readers.read_features(t.spark, f"{path}/data").groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), (F.sum("PTS") / 1000).alias("thousand_points"))
    return publish(parts.crossJoin(F.broadcast(names)), 2)  # one row


def written_outputs(t: Tables) -> str:
    """Metrics and predictions of the two simple predictors, as training writes them."""
    path = scratch_path(t.spark, "outputs")
    predictions = predictor_table(t)
    metrics = evaluate.regression_metrics(predictions, {"baseline": "baseline_prediction", **{name: f"{name}_prediction" for name in MODELS}})
    writers.write_training_outputs(metrics, predictions, path)
    return path


@query("read_metrics", with_ctes(METRIC_CTES, "SELECT * FROM metrics"))
def read_metrics(t: Tables):
    path = f"{written_outputs(t)}/model_metrics.json"
    rows = [readers.read_metrics(t.spark, path, name, label) for name, label in MODELS.items()]
    return publish(reshape.union_all(rows), 3, baseline_r2=6, model_r2=6)


@query("read_predictions", with_ctes(PREDICTOR_CTES, f"""
SELECT {KEYS}, target, 'Last value' AS model, {rounded('actual', 2)} AS actual, {rounded('last_prediction', 2)} AS model_prediction,
  {rounded('last_prediction - actual', 2)} AS error, {rounded('abs(last_prediction - actual)', 2)} AS absolute_error FROM predictions"""))
def read_predictions(t: Tables):
    rows = readers.read_predictions(t.spark, f"{written_outputs(t)}/model_predictions.parquet", "last", "Last value")
    return publish(rows.select("PLAYER_ID", "GAME_ID", "target", "model", "actual", "model_prediction", "error", "absolute_error"), 2)


@query("read_importance", with_ctes(IMPORTANCE_CTES, f"""
SELECT 'Label' AS model, target, feature, {FAMILY_SQL} AS feature_family, {rounded('gain', 2)} AS gain,
  {rounded('gain_share', 8)} AS gain_share, {whole('rank')} AS rank FROM importance"""))
def read_importance(t: Tables):
    """The importance document written and read back."""
    path = scratch_path(t.spark, "importance")
    table = importance_rows(t)
    writers.write_importance(table, importance.family_summary(table), "gbt", path)
    rows = readers.read_importance(t.spark, path, "Label")
    return publish(rows.select("model", "target", "feature", "feature_family", "gain", "gain_share", "rank"), 8, gain=2)
