import hashlib
from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.functions import names as N
from formline.operators import checks, enrich, ranking
from formline.plans import features as plans
from formline.plans import selection

LAL, BOS = 1610612747, 1610612738


def one(spark, **columns):
    """One row of the given expressions."""
    row = spark.range(1).select(*[expression.alias(name) for name, expression in columns.items()]).first()
    return row if len(columns) > 1 else row[0]


def test_scalars(spark):
    assert one(spark, x=C.height_inches(F.lit("6-9"))) == 81
    assert one(spark, x=C.height_inches(F.lit(None).cast("string"))) is None
    assert one(spark, x=C.safe_divide(F.lit(1), F.lit(2))) == 0.5
    assert one(spark, x=C.safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, x=C.season_start_year(F.lit("2023-24"))) == 2023
    assert one(spark, a=C.season_label(F.lit(2023)), b=C.season_label(F.lit(1999))) == Row(a="2023-24", b="1999-00")
    assert one(spark, x=C.opponent_abbreviation(F.lit("LAL @ BOS"))) == "BOS"
    assert one(spark, x=C.opponent_abbreviation(F.lit("LAL - BOS"))) is None
    assert one(spark, a=C.code_to_id(F.lit("NJN")), b=C.code_to_id(F.lit("XXX"))) == Row(a=1610612751, b=None)
    assert one(spark, x=C.code_to_id(F.lit(None).cast("string"))) is None
    assert one(spark, a=C.draft_pick_number(F.lit("7")), b=C.draft_pick_number(F.lit("Undrafted"))) == Row(a=7.0, b=61.0)
    assert one(spark, a=C.undrafted_flag(F.lit("UNDRAFTED")), b=C.undrafted_flag(F.lit(None).cast("string"))) == Row(a=1, b=0)
    assert one(spark, a=C.to_whole_number(F.lit("34.0")), b=C.to_whole_number(F.lit("abc"))) == Row(a=34, b=None)
    big = C.to_whole_number(F.lit("9007199254740993"), "long")
    assert one(spark, x=big) == 9007199254740993
    assert one(spark, x=C.to_game_date(F.lit("2000-01-01T00:00:00"))) == date(2000, 1, 1)
    assert one(spark, x=C.to_game_date(F.lit("never"))) is None
    assert one(spark, x=C.null_if_nan(F.lit(float("nan")))) is None
    assert one(spark, x=C.days_rest_category(F.lit(-1))) == "unknown"
    assert one(spark, a=C.token_flag(F.lit("a.b"), ".", "b"), b=C.token_flag(F.lit("axb"), ".", "b")) == Row(a=1, b=0)


def test_malformed_height_raises(spark):
    for text in ("tall", "6-9-2", "6", "six-two"):
        with pytest.raises(Exception, match="malformed height"):
            one(spark, x=C.height_inches(F.lit(text)))
    with pytest.raises(Exception, match="malformed season"):
        one(spark, x=C.season_start_year(F.lit("spring")))


def test_feature_families(spark):
    names = {"ast_rolling_10g_std": "time_series", "blk_season_max": "time_series", "opponent_recent_form": "contextual",
             "is_undrafted": "player_specific", "wingspan": "other"}
    rows = spark.createDataFrame([(n,) for n in names], "feature string").select("feature", C.feature_family().alias("family")).collect()
    assert {r["feature"]: r["family"] for r in rows} == names


def test_player_info_join(spark):
    logs = spark.createDataFrame([(31, 1, 5), (32, 1, 6), (31, 2, 7)], "PLAYER_ID int, GAME_ID int, PTS int")
    info = spark.createDataFrame(
        [(32, "5-11", None), (31, "7-0", "Center"), (40, "6-6", "Guard")], "PLAYER_ID int, HEIGHT string, POSITION string")
    merged = {(r["PLAYER_ID"], r["GAME_ID"]): (r["PTS"], r["HEIGHT"], r["POSITION"]) for r in enrich.join_player_info(logs, info).collect()}
    assert merged == {(31, 1): (5, "7-0", "Center"), (32, 1): (6, "5-11", None), (31, 2): (7, "7-0", "Center")}
    twice = enrich.join_player_info(logs, info.unionByName(info.filter("PLAYER_ID = 31")))  # builds without a job
    with pytest.raises(Exception, match="player_info has more than one row for PLAYER_ID 31"):
        twice.collect()
    assert enrich.already_enriched(logs, ["PTS"]) and not enrich.already_enriched(logs)
    info = info.filter("PLAYER_ID < 40").fillna("none")
    report = {r["metric"]: r["value"] for r in checks.merge_report(logs, info, enrich.join_player_info(logs, info)).collect()}
    assert report == {
        "input_rows": 3, "input_columns": 3, "players_in_features": 2, "lookup_rows": 2, "players_in_lookup": 2,
        "merged_rows": 3, "merged_columns": 5, "missing_HEIGHT": 0, "missing_POSITION": 0, "missing_players": 0,
        "duplicate_keys": 0}


def context_frame(spark):
    plan = [("2011-12-03", "@"), ("2011-12-03", "vs."), ("2011-12-05", "@"), ("2011-12-06", "vs."), ("2011-12-20", "@")]
    rows = [(77, 900 + i, date.fromisoformat(day), f"LAL {where} BOS", "2011-12", LAL, "WL"[i % 2]) for i, (day, where) in enumerate(plan)]
    return spark.createDataFrame(
        rows, "PLAYER_ID int, GAME_ID int, GAME_DATE date, MATCHUP string, SEASON string, TEAM_ID long, WL string")


def defense_frame(spark):
    return spark.createDataFrame(
        [(season, BOS, 0.6, 104.5) for season in ("2011-12", "2023-24")], "SEASON string, TEAM_ID long, W_PCT double, DEF_RATING double")


def test_contextual_features(spark):
    result = {r["GAME_ID"]: r for r in plans.contextual_features(context_frame(spark), defense_frame(spark)).collect()}
    games = [result[900 + i] for i in range(5)]
    assert [(g["home_game"], g["away_game"]) for g in games] == [(0, 1), (1, 0), (0, 1), (1, 0), (0, 1)]
    assert {(g["opponent_abbreviation"], g["opponent_team_id"], g["opponent_def_rating"], g["opponent_win_pct"]) for g in games} == {
        ("BOS", BOS, 104.5, 0.6)}
    assert [g["days_rest_category"] for g in games] == ["first_game", "0", "2", "1", "3+"]
    assert {g["opponent_recent_form"] for g in games} == {None}  # nobody of the opponent is in the table


def test_player_specific_features(spark):
    rows = [(5, 10 - i, date(2015, 3, 4 + 10 * i), "2014-15", "1990-06-30T00:00:00", "6-1", 180, "Guard-Forward", 2013, pick)
            for i, pick in enumerate(("undrafted", "17", None))]
    frame = spark.createDataFrame(
        rows, "PLAYER_ID int, GAME_ID int, GAME_DATE date, SEASON string, BIRTHDATE string, HEIGHT string, WEIGHT int,"
              "POSITION string, FROM_YEAR int, DRAFT_PICK string")
    found = sorted(plans.player_specific_features(frame).collect(), key=lambda r: r["GAME_DATE"])
    assert [r["career_games_played"] for r in found] == [0, 1, 2]
    assert [(r["draft_pick_numeric"], r["is_undrafted"]) for r in found] == [(61, 1), (17, 0), (61, 0)]
    assert {(r["season_number"], r["height_inches"], r["position_Forward"], r["position_Guard"]) for r in found} == {(2, 73, 1, 1)}
    assert found[0]["age_at_game"] == pytest.approx((date(2015, 3, 4) - date(1990, 6, 30)).days / 365.25)


def test_ratios(spark):
    frame = spark.createDataFrame(
        [(31, 16, 9, 4, 8, 12), (3, 0, 0, 0, 0, 4)], "PTS int, FGA int, FGM int, 3PM int, FG3A int, FTA int")
    names = ["true_shooting_pct", "effective_fg_pct", "three_point_attempt_rate", "free_throw_attempt_rate"]
    shot, thrown = [[row[name] for name in names] for row in plans.advanced_metrics(frame).orderBy(F.desc("FGA")).collect()]
    assert shot == pytest.approx([31 / (32 + 0.88 * 12), (9 + 0.5 * 4) / 16, 8 / 16, 12 / 16])
    assert thrown[0] == pytest.approx(3 / (0.88 * 4)) and thrown[1:] == [None] * 3


def test_multi_hot_ignores_missing_and_empty(spark):
    frame = spark.createDataFrame([("B-A",), ("A",), (None,), ("",), ("-C",)], "POSITION string")
    encoded = enrich.multi_hot(frame, "POSITION", prefix="p_")
    assert encoded.columns == ["POSITION", "p_A", "p_B", "p_C"]
    assert [tuple(r)[1:] for r in encoded.collect()] == [(1, 1, 0), (1, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 1)]


def full_log(spark):
    """A complete log of two teams, with all columns of the raw file."""
    rows = []
    for game in range(12):
        for player, team, code, other in ((1, LAL, "LAL", "BOS"), (2, LAL, "LAL", "BOS"), (3, BOS, "BOS", "LAL")):
            row = {name: (game * player) % 7 for name in fv.GAME_LOG_INT_COLUMNS + fv.GAME_LOG_DOUBLE_COLUMNS}
            row |= {
                "SEASON_ID": 22023, "PLAYER_ID": player, "TEAM_ID": team, "GAME_ID": 100 + game,
                "PLAYER_NAME": f"P{player}", "TEAM_ABBREVIATION": code, "TEAM_NAME": code,
                "GAME_DATE": date(2023, 12, 20 + game) if game < 12 else None,
                "MATCHUP": f"{code} vs. {other}" if game % 2 else f"{code} @ {other}",
                "WL": "W" if (team == LAL) == (game % 3 == 0) else "L", "SEASON": "2023-24",
            }
            rows.append(row)
    frame = spark.createDataFrame(rows)
    return frame.select(*[F.col(c).cast("double") if c in fv.GAME_LOG_DOUBLE_COLUMNS else F.col(c) for c in frame.columns])


def player_info(spark):
    rows = [(p, f"p{p}", "2000-01-01T00:00:00", None, "X", "6-7", 200 + p, 3, position, "Active", 2020, 2024, "2020", "1", "9")
            for p, position in ((1, "Guard"), (2, "Forward-Center"), (3, None))]
    types = ["int", "string", "string", "string", "string", "string", "int", "int", "string", "string", "int", "int",
             "string", "string", "string"]
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(fv.PLAYER_INFO_COLUMNS, types)))


def full_table(spark):
    from formline.operators.series import all_time_series_features

    logs = full_log(spark)
    featured = all_time_series_features(logs)
    enriched = plans.enrich_with_player_info(featured, player_info(spark))
    return enriched, plans.build_full_features(enriched, defense_frame(spark))


def test_full_features_have_174_columns_and_116_model_features(spark):
    base, full = full_table(spark)
    assert len(full_log(spark).columns) == 33
    assert len(base.columns) == 151
    assert len(full.columns) == 174
    assert len(N.model_feature_columns(full)) == 116
    full = full.cache()
    report = {r["metric"]: r["value"] for r in plans.validate_full_features(base, full).collect()}
    assert report["base_rows"] == report["full_rows"] == 36 and report["new_columns"] == 23
    assert report["missing_opponent_def_rating"] == 12  # games against the team without a rating
    form = {(r["PLAYER_ID"], r["GAME_ID"]): r["opponent_recent_form"] for r in full.collect()}
    assert form[(1, 100)] is None
    assert form[(1, 102)] == pytest.approx(0.5)  # BOS lost game 0 and won game 1
    assert form[(3, 102)] == pytest.approx(0.5)
    assert plans.enrich_with_player_info(base, player_info(spark)) is base


def test_blocked_full_features_equal_the_plain_ones(spark):
    base, full = full_table(spark)
    cut = plans.build_full_features(
        base, defense_frame(spark), keys=plans.SeriesKeys(max_group_rows=4))
    order = lambda df: sorted((tuple(r) for r in df.select(*full.columns).collect()), key=str)
    assert order(cut) == order(full)


def test_checks_raise(spark):
    frame = spark.createDataFrame([(1, 1, "AAA", None), (1, 1, "AAA", None)], "PLAYER_ID int, GAME_ID int, "
                                  "opponent_abbreviation string, opponent_team_id long")
    with pytest.raises(ValueError, match="Duplicate PLAYER_ID"):
        checks.require_no_duplicates(frame)
    with pytest.raises(checks.UnmappedCodes, match="1 codes have no id, e.g. .'AAA'") as raised:
        checks.require_mapped_codes(frame)
    assert [r[0] for r in raised.value.codes.collect()] == ["AAA"]
    with pytest.raises(ValueError, match="Row count"):
        checks.require_same_rowcount(frame, frame.limit(1))
    with pytest.raises(ValueError, match=r"\[1\]"):
        checks.require_entities(frame, frame.filter("PLAYER_ID > 5"))
    with pytest.raises(ValueError, match="MIN"):
        selection.activity_by_player(frame, "current")
    with pytest.raises(ValueError, match="Missing target"):
        checks.require_columns(frame, ["PTS"], "target columns")
    checks.require_no_duplicates(frame.distinct())
    assert checks.duplicate_keys(frame).first()["surplus_rows"] == 1


def test_select_players_breaks_ties_and_fills_missing_usage(spark):
    rosters = spark.createDataFrame(
        [(p, 1 if p < 6 else 2, "AAA" if p < 6 else "BBB") for p in range(1, 9)],
        "PLAYER_ID long, TEAM_ID long, TEAM_ABBREVIATION string")
    logs = lambda rows: spark.createDataFrame(rows, "PLAYER_ID long, GAME_ID long, MIN int")
    current = logs([(1, 10, 30), (1, 11, 30), (2, 10, 60), (3, 10, None), (6, 10, 5)])
    previous = logs([(4, 1, 100), (4, 2, 10), (5, 1, 1)])
    chosen = selection.sorted_selection(selection.select_players(rosters, current, previous, 3)).collect()
    assert [(r["PLAYER_ID"], r["selection_score"]) for r in chosen] == [
        (4, pytest.approx(0.7 * 110 + 14)), (1, 80.0), (2, 70.0), (6, 15.0), (7, 0.0), (8, 0.0)]
    empty = selection.select_players(rosters, current.limit(0), previous.limit(0), 1)
    assert sorted(r["PLAYER_ID"] for r in empty.collect()) == [1, 6]


def test_top_k_is_limited_before_the_shuffle(spark):
    frame = spark.range(0, 5000, 1, 4).select((F.col("id") % 3).alias("g"), "id")
    plan = ranking.top_k_per_group(frame, ["g"], [F.col("id").desc()], 10)
    assert plan.count() == 30
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()
    large = ranking.top_k_per_group(frame, ["g"], [F.col("id").desc()], 1500).collect()
    assert len(large) == 4500 and min(r["id"] for r in large) == 5000 - 4500
    sample = ranking.sample_per_group(frame, ["g"], 1200, 42, ["id"])
    again = ranking.sample_per_group(frame.repartition(7), ["g"], 1200, 42, ["id"])
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect()))
    assert {r["g"]: r["count"] for r in sample.groupBy("g").count().collect()} == {0: 1200, 1: 1200, 2: 1200}


def test_career_logs_and_player_profiles(spark):
    selected = spark.createDataFrame([(1, 1998.0), (2, 1999.0)], "PLAYER_ID long, FROM_YEAR double")
    seasons = ["1997-98", "1998-99", "1999-00", "2000-01", "2001-02"]
    logs = spark.createDataFrame([(p, 5, s) for s in seasons for p in (1, 9)], "PLAYER_ID long, FG3M int, SEASON string")
    rows = selection.career_logs(logs, selected, "2000-01").collect()
    assert sorted((r["PLAYER_ID"], r["3PM"], r["SEASON"]) for r in rows) == [(1, 5, s) for s in seasons[1:4]]
    with pytest.raises(ValueError, match="1990-91"):
        selection.career_logs(logs, selected, "1990-91")

    profile = {name: None for name in fv.PLAYER_PROFILE_SOURCE_COLUMNS}
    types = ", ".join(f"{n} {'long' if n == 'PERSON_ID' else 'string'}" for n in profile)
    one_row = lambda **given: spark.createDataFrame([tuple((profile | given).values())], types)
    info = selection.normalise_player_info([
        one_row(PERSON_ID=1642377, DRAFT_ROUND="0", DRAFT_NUMBER="3", WEIGHT="1"),
        one_row(PERSON_ID=5, DRAFT_ROUND="2", DRAFT_NUMBER="33", WEIGHT="190"),
    ])
    rows = {r["PLAYER_ID"]: (r["DRAFT_PICK"], r["WEIGHT"]) for r in info.collect()}
    assert rows == {1642377: ("Undrafted", "206"), 5: ("33", "190")}


def test_large_k_keeps_few_rows(spark):
    import random

    rng = random.Random(2)
    rows = [(g, rng.choice([None, rng.random(), 0.5]), i) for g, n in (("big", 30_000), ("small", 40), (None, 3_000), ("none", 20)) for i in range(n)]
    rows = [(g, None if g == "none" else v, i) for g, v, i in rows] + [("same", 1.0, i) for i in range(4_000)]
    frame = spark.createDataFrame(rows, "g string, v double, i int").repartition(6)
    for k, descending in ((1_500, True), (1_500, False), (3, True)):
        want = {}
        for g, v, i in rows:
            want.setdefault(g, []).append((v is None, (-v if descending else v) if v is not None else 0, i, v))
        want = {(g, i): place for g, found in want.items() for place, (_, _, i, _) in enumerate(sorted(found)[:k], 1)}
        found = ranking.top_k_by_value(frame, ["g"], "v", k, [F.col("i")], descending, rank="place")
        assert {(r["g"], r["i"]): r["place"] for r in found.collect()} == want


def test_positions_follow_the_order(spark):
    frame = spark.range(1_000).select((F.col("id") * 7919 % 1_000).alias("v"), F.lit("x").alias("_row")).repartition(5)
    found = ranking.positioned(frame, [F.col("v").desc()])
    assert found.columns == ["v", "_row", "position"]
    assert {r["v"]: r["position"] for r in found.collect()} == {v: 1_000 - v for v in range(1_000)}


def test_samples_have_the_asked_size_and_sorts_their_order(spark):
    frame = spark.range(20_000).select((F.col("id") % 7 == 0).alias("g"), "id")
    sample = ranking.sample_per_group(frame, ["g"], 100, 1, ["id"])
    assert {r["g"]: r["count"] for r in sample.groupBy("g").count().collect()} == {True: 100, False: 100}
    draws = {r["id"]: hashlib.md5(f"1|{r['id']}".encode()).hexdigest() for r in frame.filter("g").collect()}
    assert {r["id"] for r in sample.filter("g").collect()} == set(sorted(draws, key=draws.get)[:100])
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("a", 9), (None, 3)], "k string, v int")
    assert [tuple(r) for r in ranking.sort_mixed(rows, [F.col("k").asc_nulls_last(), F.col("v").desc()]).collect()] == [
        ("a", 9), ("a", 2), ("b", 1), (None, 3)]
    games = spark.createDataFrame([(2, 1, date(2020, 1, 2)), (1, 9, date(2020, 1, 2)), (1, 1, None), (3, 1, date(2019, 5, 5))],
                                  "GAME_ID int, PLAYER_ID int, GAME_DATE date")
    assert [tuple(r)[:2] for r in ranking.sort_chronological(games).collect()] == [(3, 1), (1, 9), (2, 1), (1, 1)]


def test_tokens_as_rows(spark):
    frame = spark.createDataFrame([(1, "b-a-b"), (2, None), (3, "")], "id int, POSITION string")
    assert sorted(map(tuple, enrich.token_rows(frame, ["id"], "POSITION").collect())) == [(1, "a"), (1, "b")]
