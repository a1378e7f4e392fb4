"""Queries on scalar expressions, encodings and typed projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.functions import columns as C
from formline.operators import enrich
from formline.operators.layout import scratch_path
from formline.plans import features as plans
from formline.plans.selection import tag_season as tag
from formline.sources.readers import cast_columns, empty_to_null
from formline.sources.writers import write_csv
from formline.suite.adapters import (
    CODES_SQL, GAMES_SQL, LOGS_SQL, PROFILES_SQL, customer_profiles, in_year, order_day, order_logs, player_games,
    region_codes,
)
from formline.suite.registry import Tables, publish, query, rounded, whole, with_ctes

KEYS = '"PLAYER_ID", "GAME_ID"'


@query("season_labels", f"""
SELECT DISTINCT {whole('year(o_orderdate)')} AS start_year,
  printf('%d-%02d', year(o_orderdate), (year(o_orderdate) + 1) % 100) AS season,
  {whole('year(o_orderdate)')} AS parsed_year
FROM orders""")
def season_labels(t: Tables):
    labels = t.orders.select(F.year(order_day()).alias("start_year")).distinct()
    labels = labels.withColumn("season", C.season_label("start_year"))
    return publish(labels.withColumn("parsed_year", C.season_start_year("season")))


@query("matchup_parse", with_ctes([GAMES_SQL, CODES_SQL], f"""
SELECT {KEYS}, {whole('contains("MATCHUP", $$vs.$$)')} AS home_game,
  {whole('contains("MATCHUP", $$@$$)')} AS away_game, split_part("MATCHUP", ' ', 3) AS opponent_abbreviation,
  codes.id AS opponent_team_id
FROM games LEFT JOIN codes ON codes.code = split_part("MATCHUP", ' ', 3) AND codes.code <> 'ASI'"""))
def matchup_parse(t: Tables):
    parsed = enrich.map_codes(enrich.parse_matchup(player_games(t)), region_codes(t, leave_out="ASI"))
    return publish(parsed.select(
        "PLAYER_ID", "GAME_ID", "home_game", "away_game", "opponent_abbreviation", "opponent_team_id"))


@query("team_code_map", f"""
SELECT DISTINCT code, CASE code WHEN 'BOS' THEN CAST(1610612738 AS BIGINT) WHEN 'NJN' THEN 1610612751 WHEN 'BKN' THEN 1610612751
  WHEN 'SEA' THEN 1610612760 WHEN 'OKC' THEN 1610612760 END AS team_id
FROM (SELECT CASE c_nationkey % 6 WHEN 0 THEN 'BOS' WHEN 1 THEN 'NJN' WHEN 2 THEN 'BKN' WHEN 3 THEN 'SEA'
  WHEN 4 THEN 'OKC' ELSE 'XXX' END AS code FROM customer)""")
def team_code_map(t: Tables):
    place = F.col("c_nationkey") % 6
    code = F.when(place == 5, "XXX")
    for i, name in enumerate(["BOS", "NJN", "BKN", "SEA", "OKC"]):
        code = F.when(place == i, name).otherwise(code)
    return publish(t.customer.select(code.alias("code")).distinct().withColumn("team_id", C.code_to_id("code")))


@query("age_at_event", with_ctes([LOGS_SQL, PROFILES_SQL], f"""
SELECT {KEYS}, {rounded('''date_diff('day', birth, "GAME_DATE") / 365.25''', 6)} AS age_at_game
FROM logs JOIN profiles ON id = "PLAYER_ID" """))
def age_at_event(t: Tables):
    aged = order_logs(t).join(customer_profiles(t), "PLAYER_ID")
    return publish(aged.select(
        "PLAYER_ID", "GAME_ID", C.age_at("GAME_DATE", F.to_date("BIRTHDATE")).alias("age_at_game")), 6)


@query("season_number", with_ctes([LOGS_SQL, PROFILES_SQL], f"""
SELECT {KEYS}, {whole('year("GAME_DATE") - from_year + 1')} AS season_number
FROM logs JOIN profiles ON id = "PLAYER_ID" """))
def season_number(t: Tables):
    joined = order_logs(t).join(customer_profiles(t), "PLAYER_ID")
    number = C.season_number(C.season_start_year("SEASON"), "FROM_YEAR")
    return publish(joined.select("PLAYER_ID", "GAME_ID", number.alias("season_number")))


@query("height_inches", f"""
SELECT p_partkey, {whole('CASE WHEN p_size % 9 <> 0 THEN (5 + p_size % 3) * 12 + p_size % 12 END')} AS height_inches
FROM part""")
def height_inches(t: Tables):
    size = F.col("p_size")
    text = F.concat((size % 3 + 5).cast("string"), F.lit("-"), (size % 12).cast("string"))
    heights = t.part.select("p_partkey", F.when(size % 9 != 0, text).alias("HEIGHT"))
    return publish(heights.select("p_partkey", C.height_inches().alias("height_inches")))


def supplier_picks(t: Tables):
    """Every 7th supplier is undrafted (in mixed case), every 11th has no pick, some have nonsense."""
    k = F.col("s_suppkey")
    return t.supplier.select(
        "s_suppkey",
        (k % 3).cast("string").alias("DRAFT_ROUND"),
        F.when(k % 14 == 0, "undrafted").when(k % 7 == 0, "Undrafted")
        .when(k % 13 == 0, "n/a").when(k % 11 != 0, k.cast("string")).alias("DRAFT_PICK"),
    )


PICKS_SQL = """picks AS (
  SELECT s_suppkey, CAST(s_suppkey % 3 AS VARCHAR) AS draft_round,
    CASE WHEN s_suppkey % 14 = 0 THEN 'undrafted' WHEN s_suppkey % 7 = 0 THEN 'Undrafted'
         WHEN s_suppkey % 13 = 0 THEN 'n/a' WHEN s_suppkey % 11 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS pick
  FROM supplier)"""


@query("draft_features", with_ctes([PICKS_SQL], f"""
SELECT s_suppkey, coalesce(TRY_CAST(pick AS DOUBLE), 61.0::DOUBLE) AS draft_pick_numeric,
  {whole("coalesce(lower(pick) = 'undrafted', false)")} AS is_undrafted FROM picks"""))
def draft_features(t: Tables):
    return publish(supplier_picks(t).select(
        "s_suppkey", C.draft_pick_number().alias("draft_pick_numeric"), C.undrafted_flag().alias("is_undrafted")))


@query("numeric_coerce", with_ctes([PICKS_SQL], "SELECT s_suppkey, TRY_CAST(pick AS DOUBLE) AS pick FROM picks"))
def numeric_coerce(t: Tables):
    return publish(supplier_picks(t).select("s_suppkey", C.to_number("DRAFT_PICK").alias("pick")))


@query("mark_undrafted", with_ctes([PICKS_SQL], """
SELECT s_suppkey, CASE WHEN draft_round = '0' THEN 'Undrafted' ELSE pick END AS draft_pick FROM picks"""))
def mark_undrafted(t: Tables):
    return publish(supplier_picks(t).select(
        "s_suppkey", C.undrafted_pick("DRAFT_ROUND", "DRAFT_PICK").alias("draft_pick")))


@query("multi_hot", with_ctes(["""tokens AS (
  SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part)"""], """
SELECT token, count(*) AS parts, CAST(sum(p_partkey) AS BIGINT) AS key_sum FROM tokens GROUP BY token"""))
def multi_hot(t: Tables):
    """Encoded and added up: the columns come from the data, so each column's sums are compared."""
    vocabulary = enrich.token_vocabulary(t.part, "p_name", " ")
    encoded = enrich.multi_hot(t.part.select("p_partkey", "p_name"), "p_name", " ", "word_", vocabulary)
    rows = encoded.select("p_partkey", F.inline(F.array(*[
        F.struct(F.lit(token).alias("token"), F.col(f"word_{token}").alias("flag")) for token in vocabulary])))
    return publish(rows.groupBy("token").agg(
        F.sum("flag").alias("parts"), F.sum(F.col("p_partkey") * F.col("flag")).alias("key_sum")))


@query("safe_ratios", f"""
SELECT l_orderkey, {whole('l_linenumber')} AS l_linenumber, {rounded('l_discount / nullif(l_tax, 0)', 8)} AS discount_per_tax,
  {rounded('l_extendedprice / nullif(l_quantity, 0)')} AS unit_price FROM lineitem""")
def safe_ratios(t: Tables):
    return publish(t.lineitem.select(
        "l_orderkey", "l_linenumber",
        C.safe_divide("l_discount", "l_tax").alias("discount_per_tax"),
        C.safe_divide("l_extendedprice", "l_quantity").alias("unit_price"),
    ), discount_per_tax=8)


RATIOS_SQL = f"""SELECT {KEYS},
  {rounded('"PTS" / nullif(2 * ("FGA" + 0.44::DOUBLE * "FTA"), 0)')} AS true_shooting_pct,
  {rounded('("FGM" + 0.5::DOUBLE * "3PM") / nullif("FGA", 0)', 8)} AS effective_fg_pct,
  {rounded('"FG3A" / nullif("FGA", 0)', 8)} AS three_point_attempt_rate,
  {rounded('"FTA" / nullif("FGA", 0)', 8)} AS free_throw_attempt_rate FROM games"""


@query("shooting_ratios", with_ctes([GAMES_SQL], RATIOS_SQL))
def shooting_ratios(t: Tables):
    return publish(plans.advanced_metrics(player_games(t)).select(
        "PLAYER_ID", "GAME_ID", "true_shooting_pct", "effective_fg_pct", "three_point_attempt_rate",
        "free_throw_attempt_rate"), 8, true_shooting_pct=4)


@query("fill_recode", """
SELECT o_orderkey, CASE coalesce(nullif(o_orderstatus, 'P'), 'O') WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Finished' END
  AS status, CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice END AS price FROM orders""")
def fill_recode(t: Tables):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    price = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice"))
    filled = enrich.fill_defaults(
        t.orders.select("o_orderkey", status.alias("status"), price.alias("price")), {"status": "O", "price": 0.0})
    return publish(filled.withColumn("status", C.recode("status", {"O": "Open", "F": "Finished"})))


def orders_as_text(t: Tables):
    """Orders as a CSV reader would give them: text, some cells missing, decimal or malformed."""
    k = F.col("o_orderkey")
    return t.orders.select(
        F.when(k % 7 == 0, F.concat(k.cast("string"), F.lit(".0"))).otherwise(k.cast("string")).alias("GAME_ID"),
        F.when(k % 13 == 0, "x").when(k % 17 != 0, F.col("o_custkey").cast("string")).alias("PLAYER_ID"),
        F.when(k % 11 == 0, "never").otherwise(F.date_format(order_day(), "yyyy-MM-dd")).alias("GAME_DATE"),
        F.when(k % 5 == 0, "").otherwise(F.col("o_totalprice").cast("string")).alias("FG3M"),
        "o_orderstatus",
    )


@query("cast_columns", f"""
SELECT {whole('o_orderkey')} AS "GAME_ID",
  {whole('CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END')} AS "PLAYER_ID",
  CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS "GAME_DATE",
  {rounded('CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END', 2)} AS "3PM" FROM orders""")
def cast_columns_query(t: Tables):
    types = {"GAME_ID": "long", "PLAYER_ID": "long", "GAME_DATE": "date", "3PM": "double"}
    renamed = empty_to_null(orders_as_text(t)).withColumnsRenamed({"FG3M": "3PM"})
    return publish(cast_columns(renamed, types).select(*types), 2)


@query("tag_season", f"""
SELECT o_orderkey, '1998-99' AS "SEASON" FROM orders WHERE year(o_orderdate) = 1998""")
def tag_season(t: Tables):
    rows = t.orders.filter(in_year(1998))
    return publish(tag(rows.select("o_orderkey"), "1998-99"))


@query("fill_sentinel", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
  CASE WHEN l_tax = 0 THEN 'NA' ELSE CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) END AS tax FROM lineitem""")
def fill_sentinel(t: Tables):
    cents = F.round(F.col("l_tax") * 100).cast("long").cast("string")
    tax = F.when(F.col("l_tax") != 0, cents)
    path = scratch_path(t.spark, "csv")
    write_csv(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", tax.alias("tax")), path)
    text = t.spark.read.option("header", True).csv(path)  # as any other program reads the file
    types = {"l_orderkey": "long", "l_linenumber": "long", "l_quantity": "double"}
    return publish(text.select(*[F.col(c).cast(kind).alias(c) for c, kind in types.items()], "tax"))


@query("player_specific_features", with_ctes([LOGS_SQL, PROFILES_SQL], f"""
SELECT {KEYS}, {whole('row_number() OVER (PARTITION BY "PLAYER_ID" ORDER BY "GAME_DATE", "GAME_ID") - 1')}
    AS career_games_played,
  {whole('year("GAME_DATE")')} AS season_start_year, {whole('year("GAME_DATE") - from_year + 1')} AS season_number,
  {rounded('''date_diff('day', birth, "GAME_DATE") / 365.25''', 6)} AS age_at_game,
  {whole('inches')} AS height_inches, coalesce(TRY_CAST(pick AS DOUBLE), 61.0::DOUBLE) AS draft_pick_numeric,
  {whole("coalesce(pick = 'Undrafted', false)")} AS is_undrafted,
  {whole("coalesce(contains(position, 'Center'), false)")} AS "position_Center",
  {whole("coalesce(contains(position, 'Forward'), false)")} AS "position_Forward",
  {whole("coalesce(contains(position, 'Guard'), false)")} AS "position_Guard"
FROM logs LEFT JOIN profiles ON id = "PLAYER_ID" """))
def player_specific_features(t: Tables):
    profiles = customer_profiles(t)
    logs = enrich.join_player_info(order_logs(t), profiles)
    tokens = enrich.token_vocabulary(profiles, "POSITION")
    result = plans.player_specific_features(logs, positions=tokens)
    return publish(result.select(
        "PLAYER_ID", "GAME_ID", "career_games_played", "season_start_year", "season_number", "age_at_game",
        "height_inches", "draft_pick_numeric", "is_undrafted", "position_Center", "position_Forward",
        "position_Guard"), 6)
