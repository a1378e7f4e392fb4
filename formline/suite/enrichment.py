"""Queries on lookup joins, checks and reports, and the full feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.operators import checks, enrich
from formline.operators import series as S
from formline.operators.layout import stored
from formline.plans import features as plans
from formline.suite.adapters import (
    CODES_SQL, DEFENSE_SQL, GAMES_SQL, LOGS_SQL, PROFILES_SQL, customer_profiles, in_year, order_logs,
    player_games, region_codes, region_defense,
)
from formline.suite.columns import RATIOS_SQL
from formline.suite.registry import Tables, day_text, publish, query, rounded, whole, with_ctes
from formline.suite.series import ENTITY, TEAM_GAMES_SQL, WINDOWS, rolling_sql

KEYS = '"PLAYER_ID", "GAME_ID"'


def known_customers(t: Tables):
    """A lookup that lacks the customers of one segment, so that some rows find nothing."""
    return t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("PLAYER_ID"), "c_mktsegment", "c_acctbal")


@query("lookup_join", f"""
SELECT o_custkey AS "PLAYER_ID", o_orderkey AS "GAME_ID", c_mktsegment, {rounded('c_acctbal', 2)} AS c_acctbal
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON c_custkey = o_custkey""")
def lookup_join(t: Tables):
    known = known_customers(t)
    return publish(enrich.join_player_info(order_logs(t).select("PLAYER_ID", "GAME_ID"), known), 2)


@query("composite_lookup_join", with_ctes([GAMES_SQL, DEFENSE_SQL], f"""
SELECT {KEYS}, {rounded('w_pct', 8)} AS opponent_win_pct, {rounded('def_rating')} AS opponent_def_rating
FROM games LEFT JOIN defense ON d_season = "SEASON" AND d_team = ("TEAM_ID" + 1) % 5"""))
def composite_lookup_join(t: Tables):
    games = player_games(t).withColumn("opponent_team_id", F.pmod(F.col("TEAM_ID") + 1, F.lit(5)))
    joined = enrich.join_opponent_defense(games, region_defense(t))
    return publish(joined.select("PLAYER_ID", "GAME_ID", "opponent_win_pct", "opponent_def_rating"), opponent_win_pct=8)


@query("apply_overrides", f"""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment,
  {rounded('CASE WHEN c_acctbal < 0 AND c_custkey % 2 = 0 THEN 0 ELSE c_acctbal END', 2)} AS c_acctbal FROM customer""")
def apply_overrides(t: Tables):
    overrides = t.customer.filter(F.col("c_acctbal") < 0).select(
        "c_custkey", F.lit("REVIEW").alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit(0.0)).alias("c_acctbal"))
    customers = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return publish(enrich.apply_overrides(customers, overrides, "c_custkey"), 2)


@query("dedupe_keep_first", f"""
SELECT l_orderkey, {whole('l_linenumber')} AS l_linenumber, {rounded('min(l_extendedprice)', 2)} AS l_extendedprice
FROM lineitem GROUP BY ALL""")
def dedupe_keep_first(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return publish(enrich.dedupe_keep_first(rows, ["l_orderkey", "l_linenumber"], ["l_extendedprice"]), 2)


@query("missing_entities", """
SELECT c_custkey AS "PLAYER_ID" FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 2000)""")
def missing_entities(t: Tables):
    active = t.orders.filter(in_year(2000)).select(F.col("o_custkey").alias("PLAYER_ID"))
    return publish(checks.missing_entities(t.customer.select(F.col("c_custkey").alias("PLAYER_ID")), active))


@query("unmapped_codes", with_ctes([GAMES_SQL], """
SELECT DISTINCT split_part("MATCHUP", ' ', 3) AS opponent_abbreviation FROM games
WHERE split_part("MATCHUP", ' ', 3) = 'ASI'"""))
def unmapped_codes(t: Tables):
    mapped = enrich.map_codes(enrich.parse_matchup(player_games(t)), region_codes(t, leave_out="ASI"))
    return publish(checks.unmapped_codes(mapped))


def profile_sql(source: str, entity: str, season: str, date: str) -> str:
    return f"""SELECT count(*) AS rows, count(DISTINCT {entity}) AS players, count(DISTINCT {season}) AS seasons,
  {day_text(f'min({date})')} AS min_date, {day_text(f'max({date})')} AS max_date FROM {source}"""


@query("profile_summary", with_ctes([LOGS_SQL], profile_sql("logs", '"PLAYER_ID"', '"SEASON"', '"GAME_DATE"')))
def profile_summary(t: Tables):
    return publish(checks.profile_summary(order_logs(t)))


@query("duplicate_keys", """
SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING c > 1)""")
def duplicate_keys(t: Tables):
    return publish(checks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]))


@query("duplicate_groups", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_groups(t: Tables):
    return publish(checks.duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"]))


def rolled(t: Tables):
    return S.rolling_avg_std(order_logs(t), ["PTS"], WINDOWS)


ROLLED_SQL = f"""rolled AS (SELECT "PLAYER_ID", "GAME_ID", {', '.join(rolling_sql('PTS'))} FROM logs)"""
ROLLED = [f"pts_rolling_{w}g_{stat}" for w in WINDOWS for stat in ("avg", "std")]


@query("null_counts", with_ctes([LOGS_SQL, ROLLED_SQL], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count FROM rolled" for c in ROLLED)))
def null_counts(t: Tables):
    return publish(checks.null_counts(rolled(t)))


@query("missing_summary", with_ctes([LOGS_SQL, ROLLED_SQL], "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing_count,"
    f" {rounded(f'count(*) FILTER ({c} IS NULL) / count(*)', 8)} AS missing_pct FROM rolled"
    for c in ["PLAYER_ID", *ROLLED]) + ") WHERE missing_count > 0"))
def missing_summary(t: Tables):
    return publish(checks.missing_summary(rolled(t)), 8)


RANGED = ["pts_rolling_5g_avg", "pts_rolling_20g_avg"]


@query("feature_ranges", with_ctes([LOGS_SQL, ROLLED_SQL], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rounded(f'min({c})', 3)} AS min, {rounded(f'max({c})', 3)} AS max,"
    f" {rounded(f'avg({c})', 3)} AS avg FROM rolled" for c in RANGED)))
def feature_ranges(t: Tables):
    return publish(checks.selected_ranges(rolled(t)), 3)


@query("skip_if_enriched", with_ctes([LOGS_SQL, PROFILES_SQL], """
SELECT "PLAYER_ID", "GAME_ID", position AS "POSITION", CAST(1 AS BIGINT) AS position_columns
FROM logs JOIN profiles ON id = "PLAYER_ID" """))
def skip_if_enriched(t: Tables):
    """Enriched twice: the second time finds the columns and leaves the table as it is."""
    profiles = customer_profiles(t)
    twice = plans.enrich_with_player_info(plans.enrich_with_player_info(order_logs(t), profiles), profiles)
    return publish(twice.select("PLAYER_ID", "GAME_ID", "POSITION", F.lit(twice.columns.count("POSITION")).alias("position_columns")))


@query("merge_report", """
WITH merged AS (SELECT o.o_custkey, o.o_orderkey, c.c_mktsegment, c.c_acctbal FROM orders o
  LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON c.c_custkey = o.o_custkey)
SELECT 'input_rows' AS metric, count(*) AS value FROM orders
UNION ALL SELECT 'input_columns', 2
UNION ALL SELECT 'players_in_features', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'lookup_rows', count(*) FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT 'players_in_lookup', count(DISTINCT c_custkey) FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT 'merged_rows', count(*) FROM merged
UNION ALL SELECT 'merged_columns', 4
UNION ALL SELECT 'missing_c_mktsegment', count(*) FROM merged WHERE c_mktsegment IS NULL
UNION ALL SELECT 'missing_c_acctbal', count(*) FROM merged WHERE c_acctbal IS NULL
UNION ALL SELECT 'missing_players', count(DISTINCT o_custkey) FROM merged WHERE c_mktsegment IS NULL
UNION ALL SELECT 'duplicate_keys', count(*) - count(DISTINCT (o_custkey, o_orderkey)) FROM merged""")
def merge_report(t: Tables):
    logs = order_logs(t).select("PLAYER_ID", "GAME_ID")
    known = known_customers(t)
    return publish(checks.merge_report(logs, known, stored(enrich.join_player_info(logs, known), "merged")))


CONTEXT_SQL = f"""context AS (
  SELECT games.*, CAST(contains("MATCHUP", 'vs.') AS BIGINT) AS home_game,
    CAST(contains("MATCHUP", '@') AS BIGINT) AS away_game,
    codes.code AS opponent_abbreviation, codes.id AS opponent_team_id,
    date_diff('day', lag("GAME_DATE") OVER ({ENTITY}), "GAME_DATE") AS rest,
    w_pct, def_rating, form.form AS recent,
    row_number() OVER ({ENTITY}) - 1 AS played
  FROM games JOIN codes ON codes.code = split_part("MATCHUP", ' ', 3)
  LEFT JOIN defense ON d_season = "SEASON" AND d_team = codes.id
  LEFT JOIN form ON g = "GAME_ID" AND form.team = codes.id)"""
CONTEXT_CTES = [GAMES_SQL, CODES_SQL, DEFENSE_SQL, TEAM_GAMES_SQL, CONTEXT_SQL]
CONTEXT_COLUMNS = f"""home_game, away_game, opponent_abbreviation, opponent_team_id,
  CAST(rest AS DOUBLE) AS days_rest,
  CASE WHEN rest IS NULL THEN 'first_game' WHEN rest IN (0, 1, 2) THEN CAST(rest AS VARCHAR) ELSE '3+' END
    AS days_rest_category,
  {rounded('w_pct', 8)} AS opponent_win_pct, {rounded('def_rating')} AS opponent_def_rating,
  {rounded('recent')} AS opponent_recent_form"""
CONTEXT_NAMES = ["home_game", "away_game", "opponent_abbreviation", "opponent_team_id", "days_rest",
                 "days_rest_category", "opponent_win_pct", "opponent_def_rating", "opponent_recent_form"]


@query("contextual_features", with_ctes(CONTEXT_CTES, f"SELECT {KEYS}, {CONTEXT_COLUMNS} FROM context"))
def contextual_features(t: Tables):
    games = stored(player_games(t), "games")
    result = plans.contextual_features(games, region_defense(t), region_codes(t))
    return publish(result.select("PLAYER_ID", "GAME_ID", *CONTEXT_NAMES), opponent_win_pct=8)


PLAYER_NAMES = ["career_games_played", "season_start_year", "season_number", "age_at_game", "height_inches",
                "draft_pick_numeric", "is_undrafted", "position_Center", "position_Forward", "position_Guard"]
RATIO_NAMES = ["true_shooting_pct", "effective_fg_pct", "three_point_attempt_rate", "free_throw_attempt_rate"]
FULL_CTES = [*CONTEXT_CTES, PROFILES_SQL, f"ratios AS ({RATIOS_SQL})"]


def base_games(t: Tables):
    """Games with the players' metadata, and the position tokens."""
    profiles = customer_profiles(t)
    games = stored(plans.enrich_with_player_info(player_games(t), profiles), "games")
    return games, enrich.token_vocabulary(profiles, "POSITION")


def full_features(t: Tables):
    games, positions = base_games(t)
    return games, plans.build_full_features(games, region_defense(t), region_codes(t), positions=positions)


@query("full_features", with_ctes(FULL_CTES, f"""
SELECT {KEYS}, {CONTEXT_COLUMNS}, {whole('played')} AS career_games_played,
  {whole('year("GAME_DATE")')} AS season_start_year, {whole('year("GAME_DATE") - from_year + 1')} AS season_number,
  {rounded('''date_diff('day', birth, "GAME_DATE") / 365.25''', 6)} AS age_at_game,
  {whole('inches')} AS height_inches, coalesce(TRY_CAST(pick AS DOUBLE), 61.0::DOUBLE) AS draft_pick_numeric,
  {whole("coalesce(pick = 'Undrafted', false)")} AS is_undrafted,
  {whole("coalesce(contains(position, 'Center'), false)")} AS "position_Center",
  {whole("coalesce(contains(position, 'Forward'), false)")} AS "position_Forward",
  {whole("coalesce(contains(position, 'Guard'), false)")} AS "position_Guard",
  {', '.join(RATIO_NAMES)}
FROM context JOIN profiles ON profiles.id = "PLAYER_ID" JOIN ratios USING ("PLAYER_ID", "GAME_ID")"""))
def full_features_query(t: Tables):
    _, full = full_features(t)
    digits = {name: 8 for name in ["opponent_win_pct", *RATIO_NAMES[1:]]} | {"age_at_game": 6}
    return publish(full.select("PLAYER_ID", "GAME_ID", *CONTEXT_NAMES, *PLAYER_NAMES, *RATIO_NAMES), **digits)


@query("full_feature_report", with_ctes(FULL_CTES, f"""
SELECT 'base_rows' AS metric, count(*) AS value FROM games
UNION ALL SELECT 'full_rows', count(*) FROM games
UNION ALL SELECT 'base_columns', 18
UNION ALL SELECT 'full_columns', 41
UNION ALL SELECT 'new_columns', 23
UNION ALL SELECT 'duplicate_keys', 0
UNION ALL SELECT 'missing_home_game', 0
UNION ALL SELECT 'missing_opponent_abbreviation', 0
UNION ALL SELECT 'missing_opponent_def_rating', count(*) FILTER (def_rating IS NULL) FROM context
UNION ALL SELECT 'missing_age_at_game', 0
UNION ALL SELECT 'missing_height_inches', 0
UNION ALL SELECT 'missing_draft_pick_numeric', 0
UNION ALL SELECT 'missing_true_shooting_pct', count(*) FILTER (true_shooting_pct IS NULL) FROM ratios
UNION ALL SELECT 'missing_effective_fg_pct', count(*) FILTER (effective_fg_pct IS NULL) FROM ratios"""))
def full_feature_report(t: Tables):
    games, full = full_features(t)
    return publish(checks.full_feature_report(games, stored(full, "full")))
