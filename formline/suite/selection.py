"""Queries on activity, selection, ranking, seasons and lookup tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.operators import enrich, ranking, reshape, sketches
from formline.operators.layout import stored
from formline.plans import selection as plans
from formline.sources.readers import distinct_seasons as seasons_of
from formline.suite.adapters import YEAR_LABEL_SQL, in_year, order_day, order_logs, year_label
from formline.suite.registry import Tables, day_text, publish, query, rounded, whole, with_ctes

CURRENT, PREVIOUS = 2000, 1999


def year_logs(t: Tables, year: int):
    return t.orders.filter(in_year(year)).select(
        F.col("o_custkey").alias("PLAYER_ID"), F.col("o_orderkey").alias("GAME_ID"), F.col("o_totalprice").alias("MIN"))


def roster(t: Tables):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("PLAYER_ID"), F.col("c_nationkey").cast("long").alias("TEAM_ID"),
        F.col("n_name").alias("TEAM_ABBREVIATION"))


def usage_sql(year: int, prefix: str) -> str:
    return f"""{prefix} AS (
  SELECT o_custkey AS id, count(DISTINCT o_orderkey) AS games, sum(o_totalprice) AS minutes
  FROM orders WHERE year(o_orderdate) = {year} GROUP BY 1)"""


JOINED_SQL = f"""joined AS (
  SELECT c_custkey AS "PLAYER_ID", CAST(c_nationkey AS BIGINT) AS "TEAM_ID", n_name AS "TEAM_ABBREVIATION",
    coalesce(cur.games, 0) AS current_games, coalesce(cur.minutes, 0) AS current_minutes,
    coalesce(prev.games, 0) AS previous_games, coalesce(prev.minutes, 0) AS previous_minutes
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN cur ON cur.id = c_custkey LEFT JOIN prev ON prev.id = c_custkey)"""
USAGE_CTES = [usage_sql(CURRENT, "cur"), usage_sql(PREVIOUS, "prev"), JOINED_SQL]
USAGE_COLUMNS = f"""{whole('current_games')} AS current_games, {rounded('current_minutes', 2)} AS current_minutes,
  {whole('previous_games')} AS previous_games, {rounded('previous_minutes', 2)} AS previous_minutes"""


@query("activity", f"""
SELECT o_custkey AS "PLAYER_ID", {whole('count(DISTINCT o_orderkey)')} AS all_games,
  {rounded('sum(o_totalprice)', 2)} AS all_minutes FROM orders GROUP BY o_custkey""")
def activity(t: Tables):
    logs = t.orders.select(
        F.col("o_custkey").alias("PLAYER_ID"), F.col("o_orderkey").alias("GAME_ID"), F.col("o_totalprice").alias("MIN"))
    return publish(plans.activity_by_player(logs, "all"), 2)


@query("join_usage", with_ctes(USAGE_CTES, f"""
SELECT "PLAYER_ID", "TEAM_ID", "TEAM_ABBREVIATION", {USAGE_COLUMNS} FROM joined"""))
def join_usage(t: Tables):
    current = plans.activity_by_player(year_logs(t, CURRENT), "current")
    previous = plans.activity_by_player(year_logs(t, PREVIOUS), "previous")
    return publish(plans.join_usage(roster(t), current, previous), 2)


@query("select_players", with_ctes(USAGE_CTES, f"""
SELECT "PLAYER_ID", "TEAM_ID", "TEAM_ABBREVIATION", {USAGE_COLUMNS}, {rounded('score', 3)} AS selection_score
FROM (SELECT *, current_minutes + 0.7::DOUBLE * previous_minutes + 10 * current_games + 7 * previous_games AS score
      FROM joined)
QUALIFY row_number() OVER (PARTITION BY "TEAM_ID"
  ORDER BY score DESC, current_minutes DESC, previous_minutes DESC, "PLAYER_ID") <= 10"""))
def select_players(t: Tables):
    return publish(plans.select_players(roster(t), year_logs(t, CURRENT), year_logs(t, PREVIOUS)), 2, selection_score=3)


@query("top_k_per_group", f"""
SELECT c_custkey, {whole('c_nationkey')} AS c_nationkey, {rounded('c_acctbal', 2)} AS c_acctbal,
  {whole('row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)')} AS place
FROM customer QUALIFY place <= 10""")
def top_k_per_group(t: Tables):
    order = [F.col("c_acctbal").desc(), F.col("c_custkey")]
    rows = t.customer.select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey"), "c_acctbal")
    return publish(ranking.top_k_per_group(rows, ["c_nationkey"], order, 10, rank="place"), 2)


@query("top_k_by_value", f"""
SELECT event_type, event_id, {rounded('value')} AS value,
  {whole('row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id)')} AS place FROM events QUALIFY place <= 1500""")
def top_k_by_value(t: Tables):
    """More rows per group than Spark limits by itself before a window."""
    rows = t.events.select("event_type", "event_id", "value")
    return publish(ranking.top_k_by_value(rows, ["event_type"], "value", 1500, [F.col("event_id")], rank="place"))


@query("top_n", f"""
SELECT o_orderkey, {rounded('o_totalprice', 2)} AS o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 30""")
def top_n(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return publish(ranking.top_n(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 30), 2)


@query("sort_mixed", f"""
SELECT o_orderpriority, o_orderkey, {rounded('o_totalprice', 2)} AS o_totalprice,
  row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS position FROM orders""")
def sort_mixed(t: Tables):
    rows = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    order = [F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return publish(ranking.positioned(rows, order), 2)


@query("sort_chronological", f"""
SELECT o_custkey AS "PLAYER_ID", o_orderkey AS "GAME_ID", {day_text('o_orderdate')} AS "GAME_DATE",
  row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey, o_custkey) AS position FROM orders""")
def sort_chronological(t: Tables):
    return publish(ranking.positioned(order_logs(t).select("PLAYER_ID", "GAME_ID", "GAME_DATE"), ranking.chronological()))


@query("sample_per_group", f"""
SELECT event_type, event_id, {rounded('value')} AS value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5('42|' || event_id), event_id) <= 5000""")
def sample_per_group(t: Tables):
    rows = t.events.select("event_type", "event_id", "value")
    return publish(ranking.sample_per_group(rows, ["event_type"], 5000, 42, ["event_id"]))


@query("sample_sizes", """
SELECT event_type, CAST(count(*) AS BIGINT) AS rows, count(DISTINCT event_id) AS distinct_rows
FROM (SELECT event_type, event_id FROM events
      QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5('42|' || event_id), event_id) <= 500) GROUP BY event_type""")
def sample_sizes(t: Tables):
    sample = ranking.sample_per_group(t.events.select("event_type", "event_id"), ["event_type"], 500, 42, ["event_id"])
    return publish(sample.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("distinct_rows")))


@query("keep_selected", f"""
SELECT o_custkey AS "PLAYER_ID", o_orderkey AS "GAME_ID", {rounded('o_totalprice', 2)} AS "MIN" FROM orders o
WHERE year(o_orderdate) = 1999
  AND EXISTS (SELECT 1 FROM orders s WHERE s.o_custkey = o.o_custkey AND year(s.o_orderdate) = 2000)""")
def keep_selected(t: Tables):
    selected = year_logs(t, CURRENT).select("PLAYER_ID").distinct()
    return publish(enrich.keep_selected(year_logs(t, PREVIOUS), selected), 2)


YEARS_SQL = """years AS (
  SELECT o_custkey AS id, min(year(o_orderdate)) AS from_year, max(year(o_orderdate)) AS to_year
  FROM orders GROUP BY 1)"""


def player_years_text(t: Tables):
    """First and last order year as text; a first year of 1996 is given as unknown."""
    years = t.orders.groupBy(F.col("o_custkey").alias("PERSON_ID")).agg(
        F.min(F.year(order_day())).cast("string").alias("FROM_YEAR"),
        F.max(F.year(order_day())).cast("string").alias("TO_YEAR"))
    unknown = F.when(F.col("FROM_YEAR") == "1996", "unknown").otherwise(F.col("FROM_YEAR"))
    return years.withColumn("FROM_YEAR", unknown)


@query("player_years", with_ctes([YEARS_SQL], """
SELECT c_custkey AS "PLAYER_ID", CAST(nullif(from_year, 1996) AS DOUBLE) AS "FROM_YEAR",
  CAST(to_year AS DOUBLE) AS "TO_YEAR" FROM customer LEFT JOIN years ON id = c_custkey"""))
def player_years(t: Tables):
    return publish(plans.add_player_years(t.customer.select(F.col("c_custkey").alias("PLAYER_ID")), player_years_text(t)))


@query("earliest_season", with_ctes([YEARS_SQL], """
SELECT CAST(min(nullif(from_year, 1996)) AS BIGINT) AS earliest_year FROM years"""))
def earliest_season(t: Tables):
    selected = enrich.join_player_years(t.customer.select(F.col("c_custkey").alias("PLAYER_ID")), player_years_text(t))
    return publish(plans.earliest_season(selected))


@query("generate_seasons", """
SELECT CAST(y AS BIGINT) AS start_year, printf('%d-%02d', y, (y + 1) % 100) AS "SEASON"
FROM (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS y FROM orders)""")
def generate_seasons(t: Tables):
    year = F.year(order_day())
    bounds = t.orders.agg(F.min(year).alias("first"), F.max(year).alias("last"))
    return publish(plans.generate_seasons(bounds, "first", "last"))


@query("distinct_seasons", f"SELECT DISTINCT {YEAR_LABEL_SQL.format('o_orderdate')} AS \"SEASON\" FROM orders")
def distinct_seasons(t: Tables):
    return publish(seasons_of(order_logs(t)))


def season_branches(t: Tables):
    """The logs of the first season and those of all others as frames of their own; the first lacks a column."""
    first = t.orders.agg(F.min(F.year(order_day()))).first()[0]
    return [order_logs(t, in_year(first)).drop("PTS"), order_logs(t, ~in_year(first))]


@query("union_seasons", f"""
SELECT o_custkey AS "PLAYER_ID", o_orderkey AS "GAME_ID", {day_text('o_orderdate')} AS "GAME_DATE",
  {YEAR_LABEL_SQL.format('o_orderdate')} AS "SEASON",
  {rounded('CASE WHEN year(o_orderdate) <> (SELECT min(year(o_orderdate)) FROM orders) THEN o_totalprice END', 2)} AS "PTS"
FROM orders""")
def union_seasons(t: Tables):
    stacked = reshape.union_all(season_branches(t))
    return publish(stacked.select("PLAYER_ID", "GAME_ID", "GAME_DATE", "SEASON", "PTS"), 2)


@query("career_logs", with_ctes([YEARS_SQL, """chosen AS (
  SELECT c_custkey, from_year FROM customer JOIN years ON id = c_custkey WHERE c_mktsegment = 'BUILDING')"""], f"""
SELECT o_custkey AS "PLAYER_ID", o_orderkey AS "GAME_ID", {rounded('o_totalprice', 2)} AS "3PM",
  {YEAR_LABEL_SQL.format('o_orderdate')} AS "SEASON"
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM chosen) AND year(o_orderdate) >= (SELECT min(from_year) FROM chosen)"""))
def career_logs(t: Tables):
    years = player_years_text(t).withColumn("FROM_YEAR", F.when(F.col("FROM_YEAR") != "unknown", F.col("FROM_YEAR")))
    building = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("PLAYER_ID"))
    selected = enrich.join_player_years(building, years)

    rows = order_logs(t).select("PLAYER_ID", "GAME_ID", F.col("PTS").alias("FG3M"), "SEASON")
    current = seasons_of(rows).agg(F.max("SEASON")).first()[0]
    logs = plans.career_logs(rows, selected, current)
    return publish(logs.select("PLAYER_ID", "GAME_ID", "3PM", "SEASON"), 2)


DEFENSE_TABLE_SQL = f"""rows AS (
  SELECT {YEAR_LABEL_SQL.format('o_orderdate')} AS "SEASON", CAST(n_nationkey AS BIGINT) AS "TEAM_ID",
    n_name AS "TEAM_NAME", count(*) AS "GP", count(*) FILTER (o_orderstatus = 'F') AS "W",
    avg(o_totalprice) AS "E_DEF_RATING", max(o_totalprice) AS "DEF_RATING", min(o_totalprice) AS "PACE",
    count(DISTINCT o_custkey) AS "POSS"
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)"""


@query("opponent_table", with_ctes([DEFENSE_TABLE_SQL], f"""
SELECT "SEASON", "TEAM_ID", "TEAM_NAME", "GP", "W", "GP" - "W" AS "L", {rounded('"W" / "GP"', 8)} AS "W_PCT",
  {rounded('"E_DEF_RATING"')} AS "E_DEF_RATING", {rounded('"DEF_RATING"')} AS "DEF_RATING",
  {whole('row_number() OVER (PARTITION BY "SEASON" ORDER BY "DEF_RATING", "TEAM_ID")')} AS "DEF_RATING_RANK",
  {rounded('"PACE"')} AS "PACE", "POSS" FROM rows"""))
def opponent_table(t: Tables):
    """The statistics per season and nation, all seasons in one scan."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    stats = rows.groupBy(
        year_label(order_day()).alias("SEASON"), F.col("n_nationkey").cast("long").alias("TEAM_ID"), F.col("n_name").alias("TEAM_NAME")
    ).agg(
        F.count(F.lit(1)).alias("GP"), F.count_if(F.col("o_orderstatus") == "F").alias("W"),
        F.avg("o_totalprice").alias("E_DEF_RATING"), F.max("o_totalprice").alias("DEF_RATING"),
        F.min("o_totalprice").alias("PACE"), F.count_distinct("o_custkey").alias("POSS"))
    place = F.row_number().over(Window.partitionBy("SEASON").orderBy("DEF_RATING", "TEAM_ID"))
    table = stats.withColumns({"L": F.col("GP") - F.col("W"), "W_PCT": F.col("W") / F.col("GP"), "DEF_RATING_RANK": place})
    return publish(plans.opponent_defense_table(table), W_PCT=8)


@query("player_profiles", """
SELECT s_suppkey AS "PLAYER_ID", s_name AS "PLAYER_NAME", CAST(s_suppkey % 3 AS VARCHAR) AS "DRAFT_ROUND",
  CASE WHEN s_suppkey % 3 = 0 THEN 'Undrafted' ELSE CAST(s_suppkey % 60 AS VARCHAR) END AS "DRAFT_PICK",
  n_name AS "COUNTRY" FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def player_profiles(t: Tables):
    k = F.col("s_suppkey")
    known = {
        "PERSON_ID": k, "DISPLAY_FIRST_LAST": F.col("s_name"), "COUNTRY": F.col("n_name"), "WEIGHT": F.lit(200),
        "DRAFT_ROUND": (k % 3).cast("string"), "DRAFT_NUMBER": (k % 60).cast("string"),
        "TEAM_ID": F.col("s_nationkey"), "TEAM_NAME": F.col("n_name"), "FROM_YEAR": F.lit(1995), "TO_YEAR": F.lit(2001),
    }
    profiles = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(*[
        known.get(name, F.lit(None).cast("string")).alias(name) for name in fv.PLAYER_PROFILE_SOURCE_COLUMNS])
    even = F.col("PERSON_ID") % 2 == 0
    info = plans.normalise_player_info([profiles.filter(even), profiles.filter(~even)])
    return publish(info.select("PLAYER_ID", "PLAYER_NAME", "DRAFT_ROUND", "DRAFT_PICK", "COUNTRY"))


@query("sketched_profile", """
SELECT count(*) AS rows, CAST(1 AS BIGINT) AS players_within_bound, CAST(1 AS BIGINT) AS games_within_bound, count(DISTINCT o_custkey) AS players,
  count(DISTINCT o_orderkey) AS games FROM orders""")
def sketched_profile(t: Tables):
    """Distinct players and games from one stored sketch per season, merged, beside the exact counts."""
    logs = order_logs(t)
    stored_sketches = stored(sketches.season_sketches(logs, ["PLAYER_ID", "GAME_ID"]), "sketches")
    exact = logs.agg(F.count_distinct("PLAYER_ID").alias("players"), F.count_distinct("GAME_ID").alias("games"))
    both = sketches.merged(stored_sketches).crossJoin(F.broadcast(exact))  # one row each
    return publish(both.select(
        "rows", sketches.within_bound(F.col("distinct_PLAYER_ID"), F.col("players")).alias("players_within_bound"),
        sketches.within_bound(F.col("distinct_GAME_ID"), F.col("games")).alias("games_within_bound"), "players", "games"))
