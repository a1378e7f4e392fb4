"""Queries on the window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.functions import columns as C
from formline.functions import names as N
from formline.operators import enrich, refresh, split
from formline.operators import series as S
from formline.operators.checks import wide_to_long
from formline.operators.layout import find_hot_groups, scratch_path, stored
from formline.sources.tables import write_by_entity
from formline.sources.writers import write_features
from formline.suite.adapters import (
    CODES_SQL, CUTOFF_SQL, GAMES_SQL, LOGS_SQL, LOGS_WITH_LINES_SQL, YEAR_LABEL_SQL, order_logs, order_logs_with_lines, player_games,
)
from formline.suite.registry import Tables, publish, query, rounded, whole, with_ctes

WINDOWS = [5, 10, 20]
ENTITY = 'PARTITION BY "PLAYER_ID" ORDER BY "GAME_DATE", "GAME_ID"'
SEASON = 'PARTITION BY "PLAYER_ID", "SEASON" ORDER BY "GAME_DATE", "GAME_ID"'
PRIOR = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
KEYS = '"PLAYER_ID", "GAME_ID"'
# Averages of up to 20 prices have at most 6 decimals that end; deviations differ in their last bits.
AVG_DIGITS, STD_DIGITS, SUM_DIGITS = 6, 3, 2


def feature_digits(names: list[str]) -> dict[str, int]:
    return {name: AVG_DIGITS for name in names if name.endswith("_avg")} | {
        name: STD_DIGITS for name in names if name.endswith("_std")
    }


def rolling_sql(target: str) -> list[str]:
    columns = []
    for w in WINDOWS:
        frame = f"({ENTITY} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        name = f"{target.lower()}_rolling_{w}g"
        columns.append(f'{rounded(f"""avg("{target}") OVER {frame}""", AVG_DIGITS)} AS {name}_avg')
        columns.append(f'{rounded(f"""stddev_samp("{target}") OVER {frame}""", STD_DIGITS)} AS {name}_std')
    return columns


def history_sql(target: str, scope: str) -> list[str]:
    window = SEASON if scope == "season" else ENTITY
    return [
        f'{rounded(f"""CAST({stat}("{target}") OVER ({window} {PRIOR}) AS DOUBLE)""")}'
        f" AS {target.lower()}_{scope}_{stat}"
        for stat in ("min", "max")
    ]


def total_sql(target: str) -> list[str]:
    total = f'CAST(sum("{target}") OVER ({SEASON} {PRIOR}) AS DOUBLE)'
    return [f"{rounded(total, SUM_DIGITS)} AS {target.lower()}_season_cumulative_total"]


def lag_sql(target: str) -> list[str]:
    lag = f'CAST(lag("{target}") OVER ({ENTITY}) AS DOUBLE)'
    name = target.lower()
    return [f"{rounded(lag)} AS {name}_lag_1", f'{rounded(f"""("{target}" - {lag})""")} AS {name}_change_from_previous']


def logs_sql(columns: list[str], source: str = "logs") -> str:
    ctes = [LOGS_SQL] + ([LOGS_WITH_LINES_SQL] if source != "logs" else [])
    return with_ctes(ctes, f"SELECT {KEYS}, " + ",\n  ".join(columns) + f" FROM {source}")


def features_only(df, targets=("PTS",)):
    return df.drop("GAME_DATE", "SEASON", *targets)


@query("rolling_avg_std", logs_sql(rolling_sql("PTS")))
def rolling_avg_std(t: Tables):
    result = features_only(S.rolling_avg_std(order_logs(t), ["PTS"], WINDOWS))
    return publish(result, **feature_digits(result.columns))


@query("season_min_max", logs_sql(history_sql("PTS", "season")))
def season_min_max(t: Tables):
    return publish(features_only(S.season_min_max(order_logs(t), ["PTS"])))


@query("career_min_max", logs_sql(history_sql("PTS", "career")))
def career_min_max(t: Tables):
    return publish(features_only(S.career_min_max(order_logs(t), ["PTS"])))


@query("season_cumulative_total", logs_sql(total_sql("PTS")))
def season_cumulative_total(t: Tables):
    return publish(features_only(S.season_cumulative_total(order_logs(t), ["PTS"])), SUM_DIGITS)


@query("lag_change", logs_sql(lag_sql("PTS")))
def lag_change(t: Tables):
    return publish(features_only(S.lag_and_change(order_logs(t), ["PTS"])))


ALL_TARGETS = ["PTS", "REB", "AST"]


def all_feature_columns() -> list[str]:
    columns = []
    for target in ALL_TARGETS:
        columns += rolling_sql(target) + history_sql(target, "season") + history_sql(target, "career")
        columns += total_sql(target) + lag_sql(target)
    return columns


@query("all_time_series_features", logs_sql(all_feature_columns(), "wide_logs"))
def all_time_series_features(t: Tables):
    hot = find_hot_groups(order_logs(t), ["PLAYER_ID"])  # the lines add columns, no rows
    result = S.all_time_series_features(order_logs_with_lines(t), ALL_TARGETS, WINDOWS, hot=hot)
    result = features_only(result, ALL_TARGETS)
    result = result.select("PLAYER_ID", "GAME_ID", *[F.col(c).cast("double") for c in result.columns[2:]])
    totals = {name: SUM_DIGITS for name in result.columns if name.endswith("_total")}
    return publish(result, **feature_digits(result.columns), **totals)


@query("bucketed_features", logs_sql(rolling_sql("PTS") + history_sql("PTS", "season") + lag_sql("PTS")))
def bucketed_features(t: Tables):
    """Window features and a join by entity on tables laid out by it: no second stage shuffles."""
    logs = write_by_entity(order_logs(t), scratch_path(t.spark, "by-entity"), buckets=8)
    listed = S.rolling_features(["PTS"], WINDOWS) + S.min_max_features(["PTS"], ["season"]) + S.lag_features(["PTS"])
    found = S.add_features(logs, listed, hot=None).withColumns(S.change_columns(["PTS"]))
    result = features_only(found)
    return publish(result, **feature_digits(result.columns))


WHOLE_SQL = f'whole AS (SELECT {KEYS}, "GAME_DATE", ' + ",\n  ".join(all_feature_columns()) + " FROM wide_logs)"


@query("refresh_features", with_ctes([LOGS_SQL, LOGS_WITH_LINES_SQL, CUTOFF_SQL, WHOLE_SQL],
                                     'SELECT whole.* EXCLUDE ("GAME_DATE") FROM whole, cut WHERE "GAME_DATE" >= cutoff'))
def refresh_features(t: Tables):
    """The last fifth of the orders added to the features of the others in two batches, from the carried state alone."""
    logs = split.label_split(stored(order_logs_with_lines(t), "logs"))  # the days are counted on the stored rows
    history, late = logs.filter("split = 'train'").drop("split"), logs.filter("split = 'test'").drop("split")
    listed = refresh.time_series_list(ALL_TARGETS, WINDOWS)
    path, state_path = scratch_path(t.spark, "features"), scratch_path(t.spark, "state")
    write_features(S.all_time_series_features(history, ALL_TARGETS, WINDOWS), path, ["SEASON"])
    refresh.series_state(history, listed).save(state_path)
    middle = late.agg(F.percentile_approx(F.unix_date("GAME_DATE"), 0.5).alias("day")).first()["day"]
    day = F.unix_date("GAME_DATE")
    for batch in (late.filter(day <= middle), late.filter(day > middle)):
        refresh.refresh_features(batch, path, state_path, ALL_TARGETS, WINDOWS)
    found = t.spark.read.parquet(path).join(late.select("PLAYER_ID", "GAME_ID"), ["PLAYER_ID", "GAME_ID"], "left_semi")
    result = features_only(found, ALL_TARGETS)
    result = result.select("PLAYER_ID", "GAME_ID", *[F.col(c).cast("double") for c in result.columns[2:]])
    totals = {name: SUM_DIGITS for name in result.columns if name.endswith("_total")}
    return publish(result, **feature_digits(result.columns), **totals)


# Nations as entities: they have many rows each, and with this limit all of them are cut into blocks.
HOT_ROWS = 250
NATION_SQL = f"""logs AS (
  SELECT c_nationkey AS "PLAYER_ID", o_orderkey AS "GAME_ID", CAST(o_orderdate AS DATE) AS "GAME_DATE",
         {YEAR_LABEL_SQL.format('o_orderdate')} AS "SEASON", o_totalprice AS "PTS"
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def nation_logs(t: Tables):
    nations = t.customer.select(F.col("c_custkey").alias("PLAYER_ID"), F.col("c_nationkey").alias("nation"))
    logs = order_logs(t).join(nations, "PLAYER_ID").drop("PLAYER_ID").withColumnRenamed("nation", "PLAYER_ID")
    return stored(logs, "nation-logs")  # counted, ordered and cut: joined once for that


def hot_sql(columns: list[str]) -> str:
    return with_ctes([NATION_SQL], f'SELECT CAST("PLAYER_ID" AS BIGINT) AS "PLAYER_ID", "GAME_ID", ' + ",\n  ".join(columns) + " FROM logs")


HOT_KEYS = S.SeriesKeys(max_group_rows=HOT_ROWS)


@query("hot_rolling", hot_sql(rolling_sql("PTS")))
def hot_rolling(t: Tables):
    result = features_only(S.rolling_avg_std(nation_logs(t), ["PTS"], WINDOWS, HOT_KEYS))
    return publish(result, **feature_digits(result.columns))


@query("hot_running", hot_sql(history_sql("PTS", "season") + history_sql("PTS", "career") + total_sql("PTS")
                              + [f"{whole(f'row_number() OVER ({ENTITY}) - 1')} AS career_games_played"]))
def hot_running(t: Tables):
    """Running statistics over blocks: season and career bounds, season totals, number of earlier rows."""
    features = S.min_max_features(["PTS"]) + S.cumulative_features(["PTS"]) + [S.Feature("career_games_played", "count", "PTS")]
    result = features_only(S.add_features(nation_logs(t), features, HOT_KEYS))
    return publish(result, pts_season_cumulative_total=SUM_DIGITS)


@query("hot_lag_change", hot_sql(lag_sql("PTS")))
def hot_lag_change(t: Tables):
    return publish(features_only(S.lag_and_change(nation_logs(t), ["PTS"], HOT_KEYS)))


@query("feature_group_counts", with_ctes([LOGS_SQL], f"""
SELECT 'rolling' AS feature_group, CAST(2 AS BIGINT) AS features, count(a) + count(s) AS filled FROM (
  SELECT avg("PTS") OVER w AS a, stddev_samp("PTS") OVER w AS s FROM logs
  WINDOW w AS ({ENTITY} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
UNION ALL SELECT 'lag', 1, count(l) FROM (SELECT lag("PTS") OVER ({ENTITY}) AS l FROM logs)
UNION ALL SELECT 'cumulative', 1, count(c) FROM (SELECT sum("PTS") OVER ({SEASON} {PRIOR}) AS c FROM logs)"""))
def feature_group_counts(t: Tables):
    """Features per group, and how many of their values are there."""
    features = S.rolling_features(["PTS"], [5]) + S.lag_features(["PTS"]) + S.cumulative_features(["PTS"])
    table = S.add_features(order_logs(t), features)
    counts, groups = N.feature_group_counts(table), N.feature_groups(table.columns)
    present = {name: columns for name, columns in groups.items() if columns}
    return publish(wide_to_long(table, {
        name: {"features": F.max(F.lit(counts[name])), "filled": sum(F.count(c) for c in columns)} for name, columns in present.items()
    }, key="feature_group"))


REST_SQL = f"""rested AS (
  SELECT *, date_diff('day', lag("GAME_DATE") OVER ({ENTITY}), "GAME_DATE") AS rest FROM logs)"""


@query("days_rest", with_ctes([LOGS_SQL, REST_SQL], f"""
SELECT {KEYS}, CAST(rest AS DOUBLE) AS days_rest,
  CASE WHEN rest IS NULL THEN 'first_game' WHEN rest IN (0, 1, 2) THEN CAST(rest AS VARCHAR)
       WHEN rest >= 3 THEN '3+' ELSE 'unknown' END AS days_rest_category
FROM rested"""))
def days_rest(t: Tables):
    return publish(features_only(S.days_rest(order_logs(t))))


@query("career_games_played", with_ctes([LOGS_SQL], f"""
SELECT {KEYS}, {whole(f'row_number() OVER ({ENTITY}) - 1')} AS career_games_played FROM logs"""))
def career_games_played(t: Tables):
    return publish(features_only(S.career_games_played(order_logs(t))))


TEAM_GAMES_SQL = """team_games AS (
  SELECT "GAME_ID", "TEAM_ID", min("GAME_DATE") AS d, max(CASE WHEN "WL" = 'W' THEN 1 ELSE 0 END) AS win
  FROM games GROUP BY 1, 2),
form AS (
  SELECT "GAME_ID" AS g, "TEAM_ID" AS team, d, win, avg(win) OVER (
    PARTITION BY "TEAM_ID" ORDER BY d, "GAME_ID" ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS form
  FROM team_games)"""


@query("team_recent_form", with_ctes([GAMES_SQL, TEAM_GAMES_SQL], f"""
SELECT g AS "GAME_ID", team AS "TEAM_ID", {whole('win')} AS team_win, {rounded('form')} AS recent_form FROM form"""))
def team_recent_form(t: Tables):
    return publish(S.recent_form(stored(player_games(t), "games")).drop("GAME_DATE"))


@query("hot_recent_form", with_ctes([GAMES_SQL, TEAM_GAMES_SQL], f"""
SELECT g AS "GAME_ID", team AS "TEAM_ID", {whole('win')} AS team_win, {rounded('form')} AS recent_form FROM form"""))
def hot_recent_form(t: Tables):
    return publish(S.recent_form(stored(player_games(t), "games"), max_group_rows=HOT_ROWS).drop("GAME_DATE"))


@query("recent_form", with_ctes([GAMES_SQL, CODES_SQL, TEAM_GAMES_SQL], f"""
SELECT {KEYS}, "TEAM_ID", {rounded('form')} AS opponent_recent_form
FROM games LEFT JOIN form ON g = "GAME_ID" AND team = ("TEAM_ID" + 1) % 5"""))
def recent_form(t: Tables):
    played = stored(player_games(t), "games")
    games = played.withColumn("opponent_team_id", F.pmod(F.col("TEAM_ID") + 1, F.lit(5)))
    joined = enrich.join_recent_form(games)
    return publish(joined.select("PLAYER_ID", "GAME_ID", "TEAM_ID", "opponent_recent_form"))


@query("win_flags", with_ctes([GAMES_SQL], f"""
SELECT {KEYS}, {whole("CASE WHEN nullif(\"WL\", CASE WHEN \"FTA\" = 0 THEN 'W' END) = 'W' THEN 1 ELSE 0 END")} AS team_win
FROM games"""))
def win_flags(t: Tables):
    # Some results are removed: a missing result counts as no win.
    result = F.when(~((F.col("FTA") == 0) & (F.col("WL") == "W")), F.col("WL"))
    return publish(player_games(t).select("PLAYER_ID", "GAME_ID", C.win_flag(result).alias("team_win")))
