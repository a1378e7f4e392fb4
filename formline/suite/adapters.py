"""The test tables in the shape of game logs, and the same shapes as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.functions import columns as C
from formline.suite.registry import Tables


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def year_label(day: Column) -> Column:
    return C.season_label(F.year(day))


def in_year(year: int) -> Column:
    """Bounds on the stored column itself, so that they reach the Parquet scan."""
    first, last = (F.to_timestamp_ntz(F.lit(f"{y}-01-01 00:00:00")) for y in (year, year + 1))
    return (F.col("o_orderdate") >= first) & (F.col("o_orderdate") < last)


def order_logs(t: Tables, condition: Column | None = None) -> DataFrame:
    """A customer is a player, an order is a game, its price the points."""
    return t.orders.filter(F.lit(True) if condition is None else condition).select(
        F.col("o_custkey").alias("PLAYER_ID"),
        F.col("o_orderkey").alias("GAME_ID"),
        order_day().alias("GAME_DATE"),
        year_label(order_day()).alias("SEASON"),
        F.col("o_totalprice").alias("PTS"),
    )


YEAR_LABEL_SQL = "printf('%d-%02d', year({0}), (year({0}) + 1) % 100)"
LOGS_SQL = f"""logs AS (
  SELECT o_custkey AS "PLAYER_ID", o_orderkey AS "GAME_ID", CAST(o_orderdate AS DATE) AS "GAME_DATE",
         {YEAR_LABEL_SQL.format('o_orderdate')} AS "SEASON", o_totalprice AS "PTS"
  FROM orders)"""


def order_logs_with_lines(t: Tables) -> DataFrame:
    """The same with the quantity and the number of the order's lines; orders without lines have NULL."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("GAME_ID")).agg(
        F.sum("l_quantity").alias("REB"), F.count(F.lit(1)).alias("AST")
    )
    return order_logs(t).join(lines, "GAME_ID", "left").select(
        "PLAYER_ID", "GAME_ID", "GAME_DATE", "SEASON", "PTS", "REB", "AST"
    )


LOGS_WITH_LINES_SQL = """lines AS (
  SELECT l_orderkey, sum(l_quantity) AS "REB", count(*) AS "AST" FROM lineitem GROUP BY l_orderkey),
wide_logs AS (
  SELECT logs.*, lines."REB", lines."AST" FROM logs LEFT JOIN lines ON l_orderkey = "GAME_ID")"""


def player_games(t: Tables) -> DataFrame:
    """One row per customer and day. A day is a game, a region a team, and its customers team-mates.

    The opponent of a region is the next one. Shooting numbers come from the price, so some are zero.
    """
    teams = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("PLAYER_ID"),
        F.col("n_regionkey").cast("long").alias("TEAM_ID"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("own_code"),
    )
    opponents = t.region.select(
        F.pmod(F.col("r_regionkey") + 4, F.lit(5)).cast("long").alias("TEAM_ID"),
        F.upper(F.substring("r_name", 1, 3)).alias("opponent_code"),
    )
    days = (
        t.orders.groupBy(F.col("o_custkey").alias("PLAYER_ID"), order_day().alias("GAME_DATE"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("PTS"))
    )
    game = F.datediff("GAME_DATE", F.lit("1970-01-01").cast("date")).cast("long")
    attempts = F.pmod(F.floor("PTS"), F.lit(20)).cast("long")
    return (
        days.join(teams, "PLAYER_ID").join(opponents, "TEAM_ID")
        .withColumns({"GAME_ID": game, "FGA": attempts})
        .select(
            "PLAYER_ID", "GAME_ID", "GAME_DATE",
            year_label(F.col("GAME_DATE")).alias("SEASON"),
            "TEAM_ID",
            F.when((F.col("TEAM_ID") + F.col("GAME_ID")) % 2 == 0, "W").otherwise("L").alias("WL"),
            F.concat(
                "own_code", F.when(F.col("GAME_ID") % 2 == 0, " vs. ").otherwise(" @ "), "opponent_code"
            ).alias("MATCHUP"),
            "PTS", "FGA",
            F.floor(F.col("FGA") / 2).alias("FGM"),
            F.floor(F.col("FGA") / 4).alias("3PM"),
            F.floor(F.col("FGA") / 3).alias("FG3A"),
            (F.col("GAME_ID") % 7).alias("FTA"),
        )
    )


GAMES_SQL = f"""days AS (
  SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS pts
  FROM orders GROUP BY 1, 2),
numbered AS (
  SELECT *, date_diff('day', DATE '1970-01-01', d) AS g, CAST(floor(pts) AS BIGINT) % 20 AS fga FROM days),
games AS (
  SELECT k AS "PLAYER_ID", g AS "GAME_ID", d AS "GAME_DATE", {YEAR_LABEL_SQL.format('d')} AS "SEASON",
         CAST(n_regionkey AS BIGINT) AS "TEAM_ID",
         CASE WHEN (n_regionkey + g) % 2 = 0 THEN 'W' ELSE 'L' END AS "WL",
         upper(left(c_mktsegment, 3)) || CASE WHEN g % 2 = 0 THEN ' vs. ' ELSE ' @ ' END
           || upper(left(r_name, 3)) AS "MATCHUP",
         pts AS "PTS", fga AS "FGA", fga // 2 AS "FGM", fga // 4 AS "3PM", fga // 3 AS "FG3A", g % 7 AS "FTA"
  FROM numbered JOIN customer ON c_custkey = k JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = (n_regionkey + 1) % 5)"""


def region_codes(t: Tables, leave_out: str | None = None) -> DataFrame:
    """Codes of the regions; one may be left out so that a code stays unmapped."""
    codes = t.region.select(
        F.upper(F.substring("r_name", 1, 3)).alias("opponent_abbreviation"),
        F.col("r_regionkey").cast("long").alias("opponent_team_id"),
    )
    return codes.filter(F.col("opponent_abbreviation") != leave_out) if leave_out else codes


CODES_SQL = """codes AS (
  SELECT upper(left(r_name, 3)) AS code, CAST(r_regionkey AS BIGINT) AS id FROM region)"""

MISSING_SEASON = "1998-99"


def region_defense(t: Tables, leave_out: str | None = MISSING_SEASON) -> DataFrame:
    """Per season and region: the share of finished orders and the average price."""
    rows = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(year_label(order_day()).alias("SEASON"), F.col("n_regionkey").cast("long").alias("TEAM_ID"))
        .agg(
            (F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("W_PCT"),
            F.avg("o_totalprice").alias("DEF_RATING"),
        )
    )
    return rows.filter(F.col("SEASON") != leave_out) if leave_out else rows


DEFENSE_SQL = f"""defense AS (
  SELECT {YEAR_LABEL_SQL.format('o_orderdate')} AS d_season, CAST(n_regionkey AS BIGINT) AS d_team,
         count(*) FILTER (o_orderstatus = 'F') / count(*) AS w_pct, avg(o_totalprice) AS def_rating
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2 HAVING d_season <> '{MISSING_SEASON}')"""


def customer_profiles(t: Tables) -> DataFrame:
    """Customers with the text columns of a player profile, some of them missing."""
    k = F.col("c_custkey")
    birth = F.date_add(F.lit("1970-01-01").cast("date"), (k % 5000).cast("int"))
    return t.customer.select(
        k.alias("PLAYER_ID"),
        F.concat(F.date_format(birth, "yyyy-MM-dd"), F.lit("T00:00:00")).alias("BIRTHDATE"),
        F.concat((k % 3 + 5).cast("string"), F.lit("-"), (k % 12).cast("string")).alias("HEIGHT"),
        F.when(k % 4 == 0, "Guard").when(k % 4 == 1, "Forward").when(k % 4 == 2, "Forward-Center").alias("POSITION"),
        (k % 6 + 1990).cast("int").alias("FROM_YEAR"),
        F.when(k % 7 == 0, "Undrafted").when(k % 11 != 0, (k % 60).cast("string")).alias("DRAFT_PICK"),
    )


PROFILES_SQL = """profiles AS (
  SELECT c_custkey AS id, CAST(DATE '1970-01-01' + CAST(c_custkey % 5000 AS INTEGER) AS DATE) AS birth,
         (c_custkey % 3 + 5) * 12 + c_custkey % 12 AS inches, 1990 + c_custkey % 6 AS from_year,
         CASE WHEN c_custkey % 7 = 0 THEN 'Undrafted'
              WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey % 60 AS VARCHAR) END AS pick,
         CASE c_custkey % 4 WHEN 0 THEN 'Guard' WHEN 1 THEN 'Forward' WHEN 2 THEN 'Forward-Center' END AS position
  FROM customer)"""

CUTOFF_SQL = """day_counts AS (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS c FROM orders GROUP BY 1),
cut AS (
  SELECT min(d) AS cutoff FROM (SELECT d, sum(c) OVER (ORDER BY d) AS reached FROM day_counts)
  WHERE reached > (SELECT CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) FROM orders))"""
