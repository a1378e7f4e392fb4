from datetime import date

import pytest
from pyspark.sql import functions as F

from formline.operators import importance, split
from formline.plans import modelling
from formline.sources import readers, writers


def write_text(path, text):
    path.write_text(text)
    return str(path)


def test_game_logs_are_typed_and_forgiving(spark, tmp_path):
    path = write_text(tmp_path / "logs.csv", (
        "PLAYER_ID,GAME_ID,GAME_DATE,PTS,MIN,FG_PCT,FANTASY_PTS,MATCHUP,SEASON\n"
        "1,0022300001,2024-01-02,10,34.0,0.5,12.5,LAL vs. BOS,2023-24\n"
        "2,0022300001,never,x,NA,NA,,BOS @ LAL,1999-00\n"))
    logs = readers.read_game_logs(spark, path)
    assert dict(logs.dtypes)["GAME_ID"] == "bigint" and dict(logs.dtypes)["PTS"] == "int"
    first, second = logs.collect()
    assert (first["GAME_ID"], first["GAME_DATE"], first["MIN"], first["FG_PCT"]) == (22300001, date(2024, 1, 2), 34, 0.5)
    assert [second[c] for c in ("GAME_DATE", "PTS", "MIN", "FG_PCT", "FANTASY_PTS")] == [None] * 5
    assert [r[0] for r in readers.scan_distinct_seasons(spark, path).collect()] == ["1999-00", "2023-24"]


def test_csv_round_trip_writes_na(spark, tmp_path):
    frame = spark.createDataFrame([(1, None, 0.5), (2, "a", None)], "PLAYER_ID int, SCHOOL string, FG_PCT double")
    writers.write_csv(frame, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert "1,NA,0.5" in text and "2,a,NA" in text
    back = readers.cast_columns(readers.read_text_csv(spark, str(tmp_path / "out")), {"PLAYER_ID": "int", "FG_PCT": "double"})
    assert sorted(back.collect()) == sorted(frame.collect())


def test_lookups(spark, tmp_path):
    info = write_text(tmp_path / "info.csv", (
        "PLAYER_ID,PLAYER_NAME,PLAYER_SLUG,BIRTHDATE,SCHOOL,COUNTRY,HEIGHT,WEIGHT,SEASON_EXP,POSITION,ROSTERSTATUS,"
        "TEAM_ID,FROM_YEAR,TO_YEAR,DRAFT_YEAR,DRAFT_ROUND,DRAFT_PICK\n"
        '1,A,a,2000-01-01T00:00:00,"",X,6-8,210,3,Guard,Active,7,2020,2024,2020,1,Undrafted\n'))
    row = readers.read_player_info(spark, info).first()
    assert (row["SCHOOL"], row["WEIGHT"], row["FROM_YEAR"], len(row)) == (None, 210.0, 2020, 15)
    defense = write_text(tmp_path / "def.csv", "SEASON,TEAM_ID,W_PCT,DEF_RATING\n2023-24,1610612738,0.75,110.1\n")
    assert readers.read_opponent_defense(spark, defense).first()["TEAM_ID"] == 1610612738
    selected = write_text(tmp_path / "sel.csv", "PLAYER_ID,selection_score,FROM_YEAR\n1,10.5,2020.0\n")
    assert readers.read_selected(spark, selected).first()["FROM_YEAR"] == 2020.0


def test_reports_in_the_published_json_shapes(spark, tmp_path):
    metrics = write_text(tmp_path / "metrics.json", (
        '[\n {"target": "PTS", "baseline_mae": 7.2, "baseline_rmse": 8.9, "baseline_r2": 0.0, "m_mae": 5.0, "m_rmse": 6.4,'
        ' "m_r2": 0.47, "model_path": "x"}\n]'))
    row = readers.read_metrics(spark, metrics, "m", "M").first()
    assert (row["model"], row["model_mae"], "model_path" in row) == ("M", 5.0, False)
    document = write_text(tmp_path / "split.json", '{\n "train_rows": 3,\n "feature_columns": ["b", "a"]\n}')
    assert [r["feature"] for r in readers.read_split_metadata(spark, document).orderBy("position").collect()] == ["b", "a"]


def test_written_reports_read_back(spark, tmp_path):
    rows = [("PTS", "pts_lag_1", 6.0), ("FANTASY_PTS", "home_game", 3.0), ("FANTASY_PTS", "pts_lag_1", 1.0)]
    table = importance.importance_table(spark.createDataFrame(rows, importance.SCORE_SCHEMA), ["home_game", "pts_lag_1"], "m")
    summary = importance.family_summary(table)
    writers.write_importance(table, summary, "m", str(tmp_path / "importance"))
    back = readers.read_importance(spark, str(tmp_path / "importance"), "M")
    assert back.count() == 4 and {r["model"] for r in back.collect()} == {"M"}
    document = readers.read_json_document(spark, str(tmp_path / "importance")).first()
    assert [r["feature"] for r in document["top_20_fantasy_points"]] == ["home_game", "pts_lag_1"]
    assert [r["rank"] for r in document["top_20_fantasy_points"]] == [1, 2]
    shares = [(r["target"], r["gain_share"]) for r in document["family_summary"]]
    assert shares == [("FANTASY_PTS", 0.75), ("FANTASY_PTS", 0.25), ("PTS", 1.0), ("PTS", 0.0)]

    metrics = spark.createDataFrame(
        [("REB", 1.0, 2.0, 0.0, 0.5, 1.0, None), ("AST", 1.0, 2.0, 0.0, 0.5, 1.0, 0.3)],
        "target string, baseline_mae double, baseline_rmse double, baseline_r2 double, m_mae double, m_rmse double, m_r2 double")
    predictions = spark.createDataFrame([("REB", 3.0, 2.0, 5.0)], "target string, actual double, baseline_prediction double, m_prediction double")
    writers.write_training_outputs(metrics, predictions, str(tmp_path / "train"))
    got = readers.read_metrics(spark, str(tmp_path / "train/model_metrics.json"), "m", "M").collect()
    assert [(r["target"], r["model_r2"]) for r in got] == [("AST", 0.3), ("REB", None)]
    row = readers.read_predictions(spark, str(tmp_path / "train/model_predictions.parquet"), "m", "M").first()
    assert (row["model_prediction"], row["error"], row["absolute_error"]) == (5.0, 2.0, 2.0)


def test_split_round_trip(spark, tmp_path):
    rows = [(i % 3, i, date(2024, 1, 1 + i), float(i), 2.0 * i) for i in range(10)]
    frame = spark.createDataFrame(rows, "PLAYER_ID int, GAME_ID int, GAME_DATE date, home_game double, PTS double")
    data, _ = modelling.prepare_modelling_data(frame, targets=["PTS"])
    writers.write_split(data, str(tmp_path))
    back = readers.read_features(spark, str(tmp_path / "data"))
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()} == {"train": 8, "test": 2}
    names = readers.read_split_metadata(spark, str(tmp_path / "split_metadata.json")).collect()
    assert [r["feature"] for r in names] == ["home_game"]
    assert "PartitionFilters: [isnotnull(split" in back.filter(F.col("split") == "test")._jdf.queryExecution().toString()


def test_text_keeps_precision(spark):
    frame = spark.createDataFrame([("12345678901234567",)], "GAME_ID string")
    assert readers.cast_columns(frame, {"GAME_ID": "long"}).first()[0] == 12345678901234567


@pytest.mark.parametrize("size", [0.2, 0.35])
def test_cutoff_matches_the_sorted_position(spark, size):
    days = [date(2024, 1, 1 + (i * 7) % 20) for i in range(50)]
    frame = spark.createDataFrame([(d,) for d in days], "GAME_DATE date")
    assert split.cutoff_date(frame, test_size=size) == sorted(days)[int(50 * (1 - size))]


def test_columns_are_matched_by_name_across_files(spark, tmp_path):
    one = write_text(tmp_path / "a.csv", "PLAYER_ID,GAME_ID,PTS\n1,500,7\n")
    two = write_text(tmp_path / "b.csv", "GAME_ID,PLAYER_ID\n600,2\n")
    logs = readers.read_game_logs(spark, [one, two])
    assert sorted((r["PLAYER_ID"], r["GAME_ID"], r["PTS"]) for r in logs.collect()) == [(1, 500, 7), (2, 600, None)]
    folder = tmp_path / "folder"
    folder.mkdir()
    write_text(folder / "a.csv", "PLAYER_ID,GAME_ID\n1,500\n")
    write_text(folder / "b.csv", "GAME_ID,PLAYER_ID\n600,2\n")
    write_text(folder / "c.csv", 'GAME_ID,"a,b",PLAYER_ID\n\n700,"x,y",NA\nGAME_ID,"a,b",PLAYER_ID\n800,,3\n')
    write_text(folder / "d.csv", "")
    logs = readers.read_text_csv(spark, str(folder))
    assert logs.columns == ["PLAYER_ID", "GAME_ID", "a,b"]
    assert sorted(map(tuple, logs.collect()), key=str) == [("1", "500", None), ("2", "600", None), ("3", "800", None), (None, "700", "x,y")]
    only = readers.read_text_csv(spark, [str(folder / "b.csv"), str(folder / "b.csv")])
    assert only.columns == ["GAME_ID", "PLAYER_ID"] and only.count() == 2


def test_partitioned_writes_have_few_files(spark, tmp_path):
    frame = spark.range(4000).repartition(16).withColumn("SEASON", (F.col("id") % 4).cast("string"))
    writers.write_features(frame, str(tmp_path / "out"), ["SEASON"])
    assert len(list((tmp_path / "out").glob("SEASON=*/*.parquet"))) <= 8
    assert readers.read_features(spark, str(tmp_path / "out")).count() == 4000


def test_tables_by_entity_need_no_second_shuffle(spark, tmp_path):
    from formline.operators import series as S
    from formline.sources.tables import write_by_entity

    rows = spark.range(3_000).selectExpr("id % 50 as PLAYER_ID", "id as GAME_ID", "date_add(date'2020-01-01', cast(id as int)) as GAME_DATE", "'s' as SEASON", "id * 1.5 as PTS")
    logs = write_by_entity(rows, str(tmp_path / "logs"), buckets=4)
    lookup = write_by_entity(rows.groupBy("PLAYER_ID").agg(F.max("PTS").alias("most")), str(tmp_path / "lookup"), order=[], buckets=4)
    result = S.add_features(logs, S.rolling_features(["PTS"], [5]) + S.min_max_features(["PTS"]), hot=None).join(lookup.hint("merge"), "PLAYER_ID")
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan and "SortMergeJoin" in plan
    want = S.add_features(rows, S.rolling_features(["PTS"], [5]) + S.min_max_features(["PTS"]), hot=None)
    assert sorted(map(tuple, result.drop("most").select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_sketches_of_seasons_merge(spark):
    from formline.operators import sketches

    rows = spark.range(60_000).selectExpr("id % 7000 as PLAYER_ID", "id as GAME_ID", "cast(id % 5 as string) as SEASON", "date_add(date'2020-01-01', cast(id % 900 as int)) as GAME_DATE")
    by_season = sketches.season_sketches(rows, ["PLAYER_ID", "GAME_ID"])
    whole = sketches.merged(by_season)
    assert whole.columns == ["rows", "min_date", "max_date", "distinct_PLAYER_ID", "distinct_GAME_ID"]
    found = whole.select("rows", sketches.within_bound(F.col("distinct_PLAYER_ID"), F.lit(7_000)), sketches.within_bound(F.col("distinct_GAME_ID"), F.lit(60_000))).first()
    assert tuple(found) == (60_000, True, True)
    # The same as one sketch of everything, as sketches merge without loss.
    at_once = sketches.merged(sketches.season_sketches(rows.withColumn("SEASON", F.lit("all")), ["PLAYER_ID", "GAME_ID"])).first()
    assert abs(at_once["distinct_GAME_ID"] / whole.first()["distinct_GAME_ID"] - 1) < sketches.ERRORS * sketches.STANDARD_ERROR
    assert sketches.merged(by_season, ["SEASON"]).count() == 5
