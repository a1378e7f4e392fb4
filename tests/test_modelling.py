import random
from datetime import date, timedelta
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import names as N
from formline.operators import correlation, evaluate, importance, reshape, split, training
from formline.operators.boosting import Boosting
from formline.plans import modelling
from formline.plans.eda import eda_profile

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-03", "2024-01-04", "2024-01-05"]


def split_frame(spark):
    rows = []
    for i, day in enumerate(DAYS, start=1):
        row = {name: 1 for name in fv.TARGETS} | {
            "PLAYER_ID": 100 + i, "GAME_ID": i, "GAME_DATE": day, "FGA": 10, "TEAM_ID": 7, "true_shooting_pct": 0.7,
            "pts_rolling_5g_avg": 14.0 + i, "home_game": 1, "opponent_def_rating": 112.0, "is_new": True,
            "pts_change_from_previous": 1.0, "fantasy_pts_change_from_previous": 2.0, "HEIGHT": "6-6"}
        rows.append(row)
    return spark.createDataFrame(rows)


def test_split_never_divides_a_date(spark):
    train, test = split.time_split(split_frame(spark), test_size=0.5)
    assert train.agg(F.max("GAME_DATE")).first()[0] == "2024-01-02"
    assert test.agg(F.min("GAME_DATE")).first()[0] == "2024-01-03"
    split.require_disjoint_dates(train, test)
    with pytest.raises(ValueError, match="but test rows start"):
        split.require_disjoint_dates(test, train)


def test_split_errors(spark):
    frame = split_frame(spark)
    for size in (0, 1, -1, 2):
        with pytest.raises(ValueError, match="test share"):
            split.cutoff_date(frame, test_size=size)
    with pytest.raises(ValueError, match="no rows to split"):
        split.cutoff_date(frame.limit(0))
    with pytest.raises(ValueError, match="both sides"):
        split.cutoff_date(frame.withColumn("GAME_DATE", F.lit("2024-01-01")))
    undated = frame.withColumn("GAME_DATE", F.when(F.col("GAME_ID") < 4, F.col("GAME_DATE")))
    with pytest.raises(ValueError, match="both sides"):
        split.cutoff_date(undated, test_size=0.2)  # the 5th of 6 rows has no date
    assert split.cutoff_date(undated, test_size=0.7) == date(2024, 1, 2)


def test_feature_selection_and_matrices(spark):
    data, metadata = modelling.prepare_modelling_data(split_frame(spark), test_size=0.5)
    assert set(data.features) == {"home_game", "is_new", "opponent_def_rating", "pts_rolling_5g_avg"}
    assert data.targets == fv.TARGETS
    row = metadata.first()
    assert (row["train_rows"], row["test_rows"], row["feature_count"]) == (2, 4, 4)
    assert (row["train_end_date"], row["test_start_date"]) == ("2024-01-02", "2024-01-03")
    assert row["feature_columns"] == data.features
    with pytest.raises(ValueError, match="Missing target"):
        modelling.prepare_modelling_data(split_frame(spark).drop("REB"))
    with pytest.raises(ValueError, match="no numeric column"):
        only = split_frame(spark).drop("home_game", "is_new", "opponent_def_rating", "pts_rolling_5g_avg")
        modelling.prepare_modelling_data(only)


def test_metrics_of_perfect_constant_and_wrong_predictions(spark):
    rows = [("good", 10.0, 10.0), ("good", 20.0, 20.0), ("good", 30.0, 30.0),
            ("flat", 5.0, 4.0), ("flat", 5.0, 6.0), ("off", 0.0, 1.0), ("off", 2.0, 4.0)]
    frame = spark.createDataFrame(rows, "target string, actual double, p double")
    got = {r["target"]: tuple(r)[1:] for r in evaluate.regression_metrics(frame, {"m": "p"}).collect()}
    assert got["good"] == (0, 0, 1)
    assert got["flat"] == (1, 1, 0)
    assert got["off"] == (1.5, pytest.approx(2.5 ** 0.5), pytest.approx(1 - 5 / 2))


def test_baseline_is_the_train_mean(spark):
    train = spark.createDataFrame([(10.0,), (20.0,), (30.0,)], "PTS double")
    test = spark.createDataFrame([(1, i, 0.0) for i in range(4)], "PLAYER_ID int, GAME_ID int, PTS double")
    rows = evaluate.baseline_predictions(test, evaluate.target_means(train, ["PTS"])).collect()
    assert [r["baseline_prediction"] for r in rows] == [20.0] * 4


def test_comparison_tables(spark):
    metrics = spark.createDataFrame(
        [("PTS", 7.0, 9.0, 0.0, 5.0, 6.0, 0.45), ("STL", 0.8, 1.0, 0.0, 0.75, 0.9, 0.1), ("TOV", 1.2, 1.4, 0.0, 1.0, 1.2, 0.25)],
        "target string, baseline_mae double, baseline_rmse double, baseline_r2 double, a_mae double, a_rmse double, a_r2 double")
    one, two = evaluate.model_metrics(metrics, "a", "A"), evaluate.model_metrics(metrics, "a", "B")
    table = evaluate.metric_comparison([one, two]).collect()
    assert [(r["target"], r["model"]) for r in table] == [
        ("PTS", "A"), ("PTS", "B"), ("STL", "A"), ("STL", "B"), ("TOV", "A"), ("TOV", "B")]
    assert evaluate.stack_models(metrics, {"a": "A"}).collect() == one.collect()
    tiers = {r["target"]: r["tier"] for r in evaluate.quality_tiers(one).collect()}
    assert tiers == {"PTS": "well", "STL": "poor", "TOV": "moderate"}
    better = {r["target"]: r["r2_improvement"] for r in evaluate.evaluation_improvement(one).collect()}
    assert better["PTS"] == 0.45
    long = reshape.series_long(reshape.union_all([one, two]), "rmse").collect()
    assert len(long) == 9 and sum(r["series"] == "Baseline" for r in long) == 3


def scores(spark):
    rows = [("PTS", "pts_lag_1", 6.0), ("PTS", "home_game", 2.0), ("PTS", "WEIGHT", 2.0),
            ("REB", "home_game", 3.0), ("REB", "pts_lag_1", 1.0)]
    return spark.createDataFrame(rows, importance.SCORE_SCHEMA)


def test_importance_tables(spark):
    features = ["pts_lag_1", "WEIGHT", "home_game", "unused", "other"]
    tables = modelling.importance_analysis(scores(spark), features, "gbt")
    rows = {(r["target"], r["feature"]): r for r in tables["importance"].collect()}
    assert len(rows) == 10
    assert rows[("PTS", "WEIGHT")]["rank"] == 2 and rows[("PTS", "home_game")]["rank"] == 3  # equal gain: list order
    assert rows[("PTS", "unused")]["gain"] == 0 and rows[("PTS", "unused")]["rank"] == 4
    assert rows[("PTS", "pts_lag_1")]["gain_share"] == pytest.approx(0.6)
    pivot = {r["target"]: r for r in tables["family_pivot"].collect()}
    assert pivot["REB"]["player_specific"] == 0 and pivot["REB"]["contextual"] == pytest.approx(0.75)
    extremes = tables["family_extremes"].first()
    assert extremes["majority_targets"] == 1
    assert (extremes["strongest_target"], extremes["weakest_target"]) == ("PTS", "REB")
    nothing = spark.createDataFrame([("PTS", "a", 0.0)], importance.SCORE_SCHEMA)
    assert importance.importance_table(nothing, ["a"], "gbt").first()["gain_share"] == 0


def test_family_sum(spark):
    rows = [("m", "AST", "other", 0.125), ("m", "AST", "contextual", 0.5), ("m", "AST", "other", 0.25), ("m", "BLK", "other", 1.0)]
    frame = spark.createDataFrame(rows, "model string, target string, feature_family string, gain_share double")
    got = {(r["target"], r["feature_family"]): r["gain_share"] for r in importance.family_summary(frame).collect()}
    assert got == {("AST", "other"): 0.375, ("AST", "contextual"): 0.5, ("BLK", "other"): 1.0}


def test_infinite_values_leave_their_own_pairs_without_correlation(spark):
    rng = np.random.default_rng(4)
    data = pd.DataFrame(rng.normal(size=(300, 8)), columns=list("abcdefgh"))
    data.loc[7, "c"], data.loc[7, "d"] = np.inf, np.nan
    frame = spark.createDataFrame(data)
    names = ["a", "c", "d"]
    few = {(r[0], r[1]): r[2] for r in correlation.correlation_pairs(frame, names).collect()}
    many = {(r[0], r[1]): r[2] for r in correlation.correlation_pairs(frame, list(data.columns)).collect()}
    assert few == {pair: many[pair] if many[pair] is None else pytest.approx(many[pair]) for pair in combinations(names, 2)}
    assert few["a", "c"] is None  # row 7 is common to both
    assert few["c", "d"] == pytest.approx(data.drop(7)[["c", "d"]].corr().iloc[0, 1])  # row 7 is not
    assert few["a", "d"] is not None and len(many) == 28


def test_thousands_of_columns_are_dealt_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 2_000))
    x[:, 1_500] = x[:, 3] * 2 + rng.normal(size=120) * 0.1
    x[rng.random(x.shape) < 0.02] = np.nan
    frame = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").repartition(2)
    names = [f"x{i}" for i in range(2_000)]
    wide = frame.selectExpr(*[f"v[{i}] as {n}" for i, n in enumerate(names)])
    monkeypatch.setattr(correlation, "TASK_TILES", 10)  # four parts of the 36 tiles
    found = correlation.correlation_pairs(wide, names)
    strong = {(r[0], r[1]): r[2] for r in found.filter("abs(correlation) > 0.9").collect()}
    assert list(strong) == [("x3", "x1500")] and found.count() == 1_999_000
    data = pd.DataFrame(x, columns=names)
    some = [("x0", "x1"), ("x255", "x256"), ("x3", "x1500"), ("x700", "x1999"), ("x1998", "x1999")]
    got = {(r[0], r[1]): r[2] for r in found.filter(F.concat("feature_1", F.lit(" "), "feature_2").isin([" ".join(p) for p in some])).collect()}
    assert got == {pair: pytest.approx(data[list(pair)].corr().iloc[0, 1], abs=1e-9) for pair in some}


def test_tiles_do_not_change_a_correlation(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = pd.DataFrame(rng.normal(size=(90, 11)), columns=list("abcdefghijk"))
    data.loc[rng.random(90) < 0.3, "c"] = np.nan
    data["k"] = 1.0
    frame, want = spark.createDataFrame(data).repartition(4), data.corr()
    monkeypatch.setattr(correlation, "TILE", 4)
    monkeypatch.setattr(correlation, "TASK_TILES", 2)
    for found in (correlation.correlation_pairs(frame, list(data.columns)).collect(),
                  correlation.target_correlations(frame, ["a", "k"], ["b", "c", "j"]).select("feature", "target", "correlation").collect()):
        assert len(found) in (55, 3)
        for a, b, value in found:
            assert value == (None if np.isnan(want[a][b]) else pytest.approx(want[a][b], abs=1e-9)), (a, b)


def test_correlations_with_gaps_and_constants(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=400) + 1e6
    data = pd.DataFrame({"x": x, "y": x * 2 + rng.normal(size=400), "flat": 3.0, "z": rng.normal(size=400), "none": np.nan})
    data.loc[rng.random(400) < 0.2, "y"] = np.nan
    data.loc[rng.random(400) < 0.2, "z"] = np.nan
    frame = spark.createDataFrame(data).repartition(5)
    want = data.corr()
    got = correlation.correlation_pairs(frame, list(data.columns)).collect()
    assert {(r["feature_1"], r["feature_2"]) for r in got} == set(combinations(data.columns, 2))
    for row in got:
        value = want.loc[row["feature_1"], row["feature_2"]]
        assert row["correlation"] == (None if np.isnan(value) else pytest.approx(value, abs=1e-9))
    matrix = {r["feature"]: r for r in correlation.correlation_matrix(frame, ["x", "z"], ["y", "x"]).collect()}
    assert matrix["x"]["x"] == pytest.approx(1) and matrix["z"]["y"] == pytest.approx(want.loc["z", "y"])


def learnable(spark, rows=600):
    rng = random.Random(8)
    data = []
    for i in range(rows):
        x, noise = rng.random(), rng.random()
        data.append((i % 20, i, date(2024, 1, 1) + timedelta(days=i // 6), x if rng.random() > 0.1 else None, noise, None,
                     20 * x + noise, 5.0 - 3 * x))
    frame = spark.createDataFrame(
        data, "PLAYER_ID int, GAME_ID int, GAME_DATE date, x double, noise double, empty double, FANTASY_PTS double, PTS double")
    return modelling.prepare_modelling_data(frame, targets=["PTS", "FANTASY_PTS"])[0]


def test_training_beats_the_baseline_and_survives_saving(spark, tmp_path):
    data = learnable(spark)
    parameters = training.ParameterSet("gbt_test", "Test", Boosting(rounds=5, depth=3, rate=0.5))
    metrics, predictions, trained = modelling.train_and_evaluate(data, parameters, str(tmp_path))
    rows = {r["target"]: r for r in metrics.collect()}
    assert trained.targets == ["FANTASY_PTS", "PTS"]
    for target, row in rows.items():
        assert row["gbt_test_mae"] < row["baseline_mae"] and row["gbt_test_r2"] > 0.5
        assert row["model_path"].endswith(f"gbt_test_{target.lower()}")
    assert predictions.count() == 2 * data.test.count()
    scores = training.saved_gain_scores(spark, str(tmp_path), "gbt_test", ["PTS", "FANTASY_PTS"])
    found = {(r["target"], r["feature"]): r["gain"] for r in scores.collect()}
    assert max((g, f) for (t, f), g in found.items() if t == "PTS")[1] == "x"
    table = importance.importance_table(scores, data.features, "gbt_test")
    assert {r["gain"] for r in table.filter("feature = 'empty'").collect()} == {0.0}
    loaded = training.load_models(spark, str(tmp_path), parameters, data.features, ["PTS"])
    want = {(r["PLAYER_ID"], r["GAME_ID"]): r["gbt_test_prediction"] for r in predictions.filter("target = 'PTS'").collect()}
    assert {(r["PLAYER_ID"], r["GAME_ID"]): r["_prediction_PTS"] for r in loaded.predict(data.test).collect()} == want
    with pytest.raises(FileNotFoundError, match="no saved gbt_test model of REB"):
        training.load_models(spark, str(tmp_path), parameters, data.features, ["REB"])
    with pytest.raises(ValueError, match="no parameter set"):
        training.parameter_set("nothing")
    assert training.parameter_set("gbt_deep") is training.DEEP


def test_names(spark):
    assert N.target_file_name("gbt_deep", "FANTASY_PTS") == "gbt_deep_fantasy_pts"
    assert N.rolling_name("3PM", 5, "avg") == "3pm_rolling_5g_avg"


def test_eda_tables(spark):
    rng = random.Random(2)
    rows = [(i % 9, i, date(2024, 1, 1), "2023-24", rng.random(), rng.random(), i * 1.0, i * 2.0) for i in range(60)]
    frame = spark.createDataFrame(
        rows, "PLAYER_ID int, GAME_ID int, GAME_DATE date, SEASON string, PTS double, REB double, age_at_game double, height_inches double")
    tables = eda_profile(frame)
    assert {"summary", "missing", "outliers", "histogram_PTS", "histogram_age_at_game"} <= set(tables)
    pairs = tables["collinear_pairs"].collect()
    assert [(r["feature_1"], r["feature_2"]) for r in pairs] == [("age_at_game", "height_inches")]
    assert tables["summary"].first()["players"] == 9
    assert tables["missing"].count() == 0
    assert {r["target"] for r in tables["target_correlations"].collect()} == {"PTS", "REB"}
