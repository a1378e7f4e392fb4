"""All stages on a small league, from CSV files to the importance document."""

import random
from datetime import date, timedelta

from formline import fixed_values as fv
from formline.functions import names as N
from formline.operators import training
from formline.operators.boosting import Boosting
from formline.operators.series import all_time_series_features
from formline.plans import features, modelling
from formline.plans.eda import eda_profile
from formline.sources import readers, writers
from formline.suite.registry import Tables
from formline.suite.selection import year_logs

TEAMS = {"BOS": 1610612738, "LAL": 1610612747, "MIA": 1610612748, "DEN": 1610612743}


def write_league(folder):
    rng = random.Random(4)
    columns = [*fv.GAME_LOG_INT_COLUMNS, *fv.GAME_LOG_DOUBLE_COLUMNS, "GAME_DATE", "PLAYER_NAME", "TEAM_ABBREVIATION",
               "TEAM_NAME", "MATCHUP", "WL", "SEASON"]
    lines = [",".join(columns)]
    codes = list(TEAMS)
    for day in range(40):
        rng.shuffle(codes)
        season = "2022-23" if day < 20 else "2023-24"
        for pair, (home, away) in enumerate(((codes[0], codes[1]), (codes[2], codes[3]))):
            for code, other, mark in ((home, away, "vs."), (away, home, "@")):
                for player in (1, 2, 3):
                    row = {c: rng.randrange(12) for c in fv.GAME_LOG_INT_COLUMNS}
                    row |= {c: "NA" if rng.random() < 0.1 else round(rng.random(), 3) for c in ["FG_PCT", "FG3_PCT", "FT_PCT"]}
                    row["PTS"] = player * 6 + rng.randrange(4)
                    row |= {
                        "FANTASY_PTS": row["PTS"] * 1.5, "PLAYER_ID": TEAMS[code] % 1000 * 10 + player,
                        "TEAM_ID": TEAMS[code], "GAME_ID": 1000 + day * 2 + pair,
                        "GAME_DATE": (date(2023, 1, 1) + timedelta(days=day * 8)).isoformat(),
                        "PLAYER_NAME": f"{code}{player}", "TEAM_ABBREVIATION": code, "TEAM_NAME": code,
                        "MATCHUP": f"{code} {mark} {other}", "WL": "W" if mark == "vs." else "L", "SEASON": season,
                    }
                    lines.append(",".join(str(row[c]) for c in columns))
    (folder / "logs.csv").write_text("\n".join(lines))
    info = [",".join(fv.PLAYER_INFO_COLUMNS)]
    for code, team in TEAMS.items():
        for player in (1, 2, 3):
            position = ["Guard", "Forward-Center", "NA"][player - 1]
            pick = ["9", "Undrafted", "NA"][player - 1]
            info.append(f"{team % 1000 * 10 + player},x,199{player}-02-03T00:00:00,,USA,6-{player},20{player},3,{position},"
                        f"Active,2019,2024,2019,1,{pick}")
    (folder / "info.csv").write_text("\n".join(info))
    defense = ["SEASON,TEAM_ID,W_PCT,DEF_RATING"]
    defense += [f"{season},{team},0.5,{100 + i}" for season in ("2022-23", "2023-24") for i, team in enumerate(TEAMS.values())]
    (folder / "defense.csv").write_text("\n".join(defense))


def test_from_files_to_importance(spark, tmp_path):
    write_league(tmp_path)
    logs = readers.read_game_logs(spark, str(tmp_path / "logs.csv"))
    writers.write_features(all_time_series_features(logs), str(tmp_path / "windows"), ["SEASON"])
    windows = readers.read_features(spark, str(tmp_path / "windows"))
    enriched = features.enrich_with_player_info(windows, readers.read_player_info(spark, str(tmp_path / "info.csv")))
    full = features.build_full_features(enriched, readers.read_opponent_defense(spark, str(tmp_path / "defense.csv")))
    writers.write_features(full, str(tmp_path / "full"))
    full = readers.read_features(spark, str(tmp_path / "full"))
    report = {r["metric"]: r["value"] for r in features.validate_full_features(enriched, full).collect()}
    assert report["full_rows"] == 480 and report["missing_opponent_def_rating"] == 0
    assert len(full.columns) == 174

    tables = eda_profile(full)
    missing = {r["column"]: r["missing_count"] for r in tables["missing"].collect()}
    assert missing["pts_lag_1"] == 12 and missing["pts_rolling_5g_std"] == 24 and missing["pts_season_min"] == 24
    assert ("away_game", "home_game") not in {(r["feature_1"], r["feature_2"]) for r in tables["collinear_pairs"].collect()}

    data, metadata = modelling.prepare_modelling_data(full)
    assert metadata.first()["feature_count"] == 116
    writers.write_split(data, str(tmp_path / "split"))
    written = readers.read_features(spark, str(tmp_path / "split/data"))
    names = [r["feature"] for r in readers.read_split_metadata(spark, str(tmp_path / "split/split_metadata.json"))
             .orderBy("position").collect()]
    assert names == data.features == N.model_feature_columns(full)
    again = modelling.ModellingData(written, names, ["PTS", "FANTASY_PTS"], data.keys)

    config = training.ParameterSet("gbt_test", "Test", Boosting(rounds=2, depth=2, rate=0.5))
    metrics, predictions, _ = modelling.train_and_evaluate(again, config, str(tmp_path / "models"))
    writers.write_training_outputs(metrics, predictions, str(tmp_path / "out"))
    rows = readers.read_metrics(spark, str(tmp_path / "out/model_metrics.json"), "gbt_test", "Test").collect()
    assert all(r["model_mae"] < r["baseline_mae"] for r in rows) and len(rows) == 2

    scores = training.saved_gain_scores(spark, str(tmp_path / "models"), "gbt_test", again.targets)
    reports = modelling.importance_analysis(scores, names, "gbt_test")
    writers.write_importance(reports["importance"], reports["family_summary"], "gbt_test", str(tmp_path / "importance"))
    assert readers.read_importance(spark, str(tmp_path / "importance"), "Test").count() == 2 * 116
    pivot = {r["target"]: r for r in reports["family_pivot"].collect()}
    assert set(pivot) == {"PTS", "FANTASY_PTS"}
    for row in pivot.values():
        # The league is built so that the height gives the points away.
        assert row["player_specific"] > 0.5 and abs(sum(row[f] for f in fv.FAMILIES) - 1) < 1e-9
    assert reports["family_extremes"].first()["targets"] == 2


def test_year_filter_reaches_the_scan(spark):
    plan = year_logs(Tables(spark, "/root/testdata/sf0.001"), 2000)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
