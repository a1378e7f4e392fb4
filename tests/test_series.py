import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from formline.functions import names as N
from formline.operators import series as S

SCHEMA = "GAME_ID int, PLAYER_ID int, GAME_DATE date, SEASON string, PTS int"


def by_game(df):
    return {row["GAME_ID"]: row for row in df.collect()}


HISTORY = {
    7: [("2011-12", 4), ("2011-12", 9), ("2011-12", 1), ("2012-13", 16), ("2012-13", 25), ("2012-13", 7)],
    8: [("2011-12", 50), ("2012-13", 60)],
}


def history(spark):
    """Two entities over two seasons, a row a week, given in no order."""
    rows, game = [], 0
    for player, values in HISTORY.items():
        for week, (season, value) in enumerate(values):
            game += 1
            rows.append((game, player, date(2011, 11, 1) + timedelta(weeks=week), season, value))
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def expected_rows(compute):
    """game -> compute(earlier values, earlier values of the season, value), by plain Python."""
    result, game = {}, 0
    for values in HISTORY.values():
        for i, (season, value) in enumerate(values):
            game += 1
            result[game] = compute([v for _, v in values[:i]], [v for s, v in values[:i] if s == season], value)
    return result


def check_against(frame, names, compute):
    found = by_game(frame)
    for game, want in expected_rows(compute).items():
        got = tuple(found[game][name] for name in names)
        assert got == tuple(x if x is None else pytest.approx(x) for x in want), game


def test_trailing_frames_hold_earlier_rows_of_the_entity_only(spark):
    def compute(earlier, _, value):
        last = earlier[-2:]
        return (statistics.mean(last) if last else None, statistics.stdev(last) if len(last) > 1 else None)

    check_against(S.rolling_avg_std(history(spark), ["PTS"], [2]), ["pts_rolling_2g_avg", "pts_rolling_2g_std"], compute)


def test_bounds_start_anew_with_a_season_but_not_in_a_career(spark):
    bounds = lambda values: (min(values, default=None), max(values, default=None))
    names = ["pts_season_min", "pts_season_max", "pts_career_min", "pts_career_max"]
    check_against(S.historical_min_max(history(spark), ["PTS"]), names, lambda career, season, _: bounds(season) + bounds(career))


def test_running_total_of_the_season(spark):
    check_against(S.season_cumulative_total(history(spark), ["PTS"]), ["pts_season_cumulative_total"],
                  lambda _, season, value: (sum(season) if season else None,))


def test_previous_value_and_difference(spark):
    check_against(S.lag_and_change(history(spark), ["PTS"]), ["pts_lag_1", "pts_change_from_previous"],
                  lambda career, _, value: (career[-1], value - career[-1]) if career else (None, None))


def test_columns_per_target(spark):
    frame = history(spark).withColumn("REB", F.lit(5))
    result = S.all_time_series_features(frame, ["PTS", "REB"], [4])
    per_target = 2 + 4 + 1 + 2  # one window, bounds of two scopes, total, lag and change
    assert len(result.columns) - len(frame.columns) == len(N.time_series_columns(result)) == 2 * per_target


def test_default_call_adds_104_columns(spark):
    frame = history(spark)
    for target in ["FANTASY_PTS", "REB", "AST", "STL", "BLK", "TOV", "3PM"]:
        frame = frame.withColumn(target, F.lit(1.0))
    result = S.all_time_series_features(frame)
    assert len(result.columns) - len(frame.columns) == 104
    assert N.feature_group_counts(result) == {
        "rolling": 48, "min_max": 32, "cumulative": 8, "lag": 8, "change": 8,
        "features": 104, "columns": len(frame.columns) + 104,
    }


def test_one_shuffle_and_no_python(spark):
    frame = history(spark).repartition(3)
    plan = S._plain(frame, S.rolling_features(["PTS"], [5, 10]) + S.min_max_features(["PTS"]), S.GAME_KEYS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") == 2
    assert "Python" not in text and "SinglePartition" not in text


def test_days_rest_categories(spark):
    days = [1, 2, 4, 4, 8]
    frame = spark.createDataFrame(
        [(101 + i, 1, date(2024, 1, d), "s", 0) for i, d in enumerate(days)] + [(200, 1, None, "s", 0)], SCHEMA)
    rows = by_game(S.days_rest(frame))
    assert [rows[101 + i]["days_rest_category"] for i in range(5)] == ["first_game", "1", "2", "0", "3+"]
    assert rows[200]["days_rest"] is None
    played = by_game(S.career_games_played(frame))
    assert [played[101 + i]["career_games_played"] for i in range(5)] == [0, 1, 2, 3, 4]
    assert played[200]["career_games_played"] == 5


def test_recent_form_counts_each_team_game_once(spark):
    rows, game = [], 0
    results = "WWLWLLW"
    for i, outcome in enumerate(results):
        for player in (1, 2):
            rows.append((player, 100 + i, date(2024, 1, 1) + timedelta(days=i), 7, outcome))
    frame = spark.createDataFrame(rows, "PLAYER_ID int, GAME_ID int, GAME_DATE date, TEAM_ID int, WL string")
    form = {r["GAME_ID"]: r["recent_form"] for r in S.recent_form(frame).collect()}
    assert form[100] is None and form[101] == 1.0
    assert form[103] == pytest.approx(2 / 3)
    assert form[106] == pytest.approx(2 / 5)  # W L W L L


def skewed_logs(spark, rows=900):
    """One player holds most of the rows, several on the same day; NULL ids, dates and values occur."""
    rng = random.Random(5)
    data = []
    for game in range(rows):
        player = rng.choice([1, 1, 1, 1, 2, 3, None])
        day = date(2020, 1, 1) + timedelta(days=rng.choice([0, 0, rng.randrange(900)]))
        when = None if rng.random() < 0.02 else day
        value = None if rng.random() < 0.1 else rng.randrange(1000)
        data.append((game, player, when, str(day.year), value))
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("limit", [5, 40, 300])
def test_blocked_series_equal_the_plain_window(spark, limit):
    frame = skewed_logs(spark).cache()
    whole = S.SeriesKeys()
    cut = S.SeriesKeys(max_group_rows=limit)
    for build in (
        lambda keys: S.all_time_series_features(frame, ["PTS"], [3, 20], keys),
        lambda keys: S.days_rest(frame, keys),
        lambda keys: S.career_games_played(frame, keys),
    ):
        expected, actual = by_game(build(whole)), by_game(build(cut))
        assert actual.keys() == expected.keys()
        for game, row in expected.items():
            for name in row.asDict():
                want, got = row[name], actual[game][name]
                assert got == (pytest.approx(want) if isinstance(want, float) else want), (game, name)


def test_blocked_recent_form_equals_the_plain_window(spark):
    frame = skewed_logs(spark).select(
        "GAME_DATE", F.col("GAME_ID").alias("PLAYER_ID"), (F.col("GAME_ID") % 400).alias("GAME_ID"),
        (F.col("GAME_ID") % 2).alias("TEAM_ID"), F.when(F.col("PTS") % 2 == 0, "W").otherwise("L").alias("WL"))
    frame = frame.filter("GAME_DATE is not null")
    key = lambda r: (r["GAME_ID"], r["TEAM_ID"])
    want = {key(r): r["recent_form"] for r in S.recent_form(frame).collect()}
    got = {key(r): r["recent_form"] for r in S.recent_form(frame, max_group_rows=50).collect()}
    assert got == want
