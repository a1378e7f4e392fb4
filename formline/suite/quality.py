"""Queries on broken rules, on tables with planted faults, and on a build that is checked while it is written."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.operators import split, violations
from formline.operators.layout import scratch_path
from formline.plans import features as plans
from formline.suite.adapters import CUTOFF_SQL, LOGS_SQL, order_logs, region_codes, region_defense
from formline.suite.enrichment import FULL_CTES, base_games, known_customers
from formline.suite.registry import Tables, day_text, publish, query, whole, with_ctes

REPEATED_SQL = """SELECT 'unique_lookup' AS rule, CAST(id AS VARCHAR) AS key, count(*) AS rows FROM (
  SELECT c_custkey AS id FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY id HAVING count(*) > 1"""


def repeated_lookup(t: Tables):
    """Customers in debt stand in the lookup twice."""
    lookup = t.customer.select(F.col("c_custkey").alias("PLAYER_ID"), "c_acctbal")
    return violations.repeated_keys(lookup.unionByName(lookup.filter("c_acctbal < 0")), ["PLAYER_ID"], "unique_lookup")


@query("repeated_lookup_keys", REPEATED_SQL)
def repeated_lookup_keys(t: Tables):
    return publish(repeated_lookup(t))


DUPLICATES_SQL = """SELECT 'unique_key' AS rule, o_custkey || ',' || o_orderpriority AS key, count(*) AS rows FROM orders
  GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1"""


def duplicates(t: Tables):
    return violations.repeated_keys(t.orders, ["o_custkey", "o_orderpriority"])


@query("duplicate_violations", DUPLICATES_SQL)
def duplicate_violations(t: Tables):
    """Customers with several orders of one priority."""
    return publish(duplicates(t))


ROWCOUNT_SQL = """SELECT 'same_rowcount' AS rule, had || ' to ' || has AS key, abs(has - had) AS rows FROM (
  SELECT (SELECT count(*) FROM orders) AS had, (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'BUILDING') AS has)
  WHERE had <> has"""


def lost_rows(t: Tables):
    logs = order_logs(t)
    return violations.changed_rowcount(logs, logs.join(known_customers(t), "PLAYER_ID"))


@query("rowcount_violations", ROWCOUNT_SQL)
def rowcount_violations(t: Tables):
    """An inner join with an incomplete lookup loses rows."""
    return publish(lost_rows(t))


UNKNOWN_SQL = """SELECT 'known_entity' AS rule, CAST(o_custkey AS VARCHAR) AS key, count(*) AS rows FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY o_custkey"""


def unknown(t: Tables):
    return violations.unknown_entities(order_logs(t), known_customers(t))


@query("unknown_entities", UNKNOWN_SQL)
def unknown_entities(t: Tables):
    return publish(unknown(t))


CODES_SQL = """SELECT 'mapped_code' AS rule, n_name AS key, count(*) AS rows FROM customer JOIN nation ON n_nationkey = c_nationkey
  WHERE n_regionkey = 1 GROUP BY n_name"""


def unmapped(t: Tables):
    nations = t.nation.select("n_nationkey", F.col("n_name").alias("opponent_abbreviation"), F.when(F.col("n_regionkey") != 1, F.col("n_regionkey")).alias("opponent_team_id"))
    return violations.codes_without_id(t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")))


@query("codes_without_id", CODES_SQL)
def codes_without_id(t: Tables):
    """The nations of one region have no id."""
    return publish(unmapped(t))


DATES_SQL = f"""SELECT 'disjoint_dates' AS rule, {day_text('"GAME_DATE"')} AS key, count(*) AS rows FROM logs, cut
  WHERE "GAME_DATE" >= cutoff AND "GAME_ID" % 10 = 0 GROUP BY "GAME_DATE" """


def late_training_rows(t: Tables):
    labelled = split.label_split(order_logs(t))
    test, late = F.col("split") == "test", F.col("GAME_ID") % 10 == 0
    return violations.dates_on_both_sides(labelled.filter(~test | late), labelled.filter(test))


@query("overlapping_dates", with_ctes([LOGS_SQL, CUTOFF_SQL], DATES_SQL))
def overlapping_dates(t: Tables):
    """A tenth of the test rows has slipped into the train part."""
    return publish(late_training_rows(t))


STACKED_SQL = " UNION ALL ".join([REPEATED_SQL, DUPLICATES_SQL, ROWCOUNT_SQL, UNKNOWN_SQL, CODES_SQL, DATES_SQL,
                                  "SELECT 'column_present', column_name, 0 FROM (VALUES ('REB'), ('AST')) missing(column_name)"])


@query("violations", with_ctes([LOGS_SQL, CUTOFF_SQL], f"""
SELECT rule, count(*) AS keys, {whole('sum(rows)')} AS rows, min(key) AS first_key, max(key) AS last_key FROM ({STACKED_SQL}) GROUP BY rule"""))
def all_violations(t: Tables):
    """All rules in one table, summed up."""
    absent = violations.absent_columns(order_logs(t), ["PLAYER_ID", "PTS", "REB", "AST"])
    rules = violations.stacked([repeated_lookup(t), duplicates(t), lost_rows(t), unknown(t), unmapped(t), late_training_rows(t), absent])
    return publish(rules.groupBy("rule").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("rows").alias("rows"), F.min("key").alias("first_key"), F.max("key").alias("last_key")))


@query("checked_build", with_ctes(FULL_CTES, """
SELECT 'base_rows' AS metric, count(*) AS value FROM games
UNION ALL SELECT 'full_rows', count(*) FROM games
UNION ALL SELECT 'base_columns', 18
UNION ALL SELECT 'full_columns', 41
UNION ALL SELECT 'new_columns', 23
UNION ALL SELECT 'duplicate_keys', 0
UNION ALL SELECT 'written_rows', count(*) FROM games
UNION ALL SELECT 'missing_home_game', 0
UNION ALL SELECT 'missing_opponent_abbreviation', 0
UNION ALL SELECT 'missing_opponent_def_rating', count(*) FILTER (def_rating IS NULL) FROM context
UNION ALL SELECT 'missing_age_at_game', 0
UNION ALL SELECT 'missing_height_inches', 0
UNION ALL SELECT 'missing_draft_pick_numeric', 0
UNION ALL SELECT 'missing_true_shooting_pct', count(*) FILTER (true_shooting_pct IS NULL) FROM ratios
UNION ALL SELECT 'missing_effective_fg_pct', count(*) FILTER (effective_fg_pct IS NULL) FROM ratios"""))
def checked_build(t: Tables):
    """The full feature table, checked by the job that writes it; and the rows found in the files."""
    games, positions = base_games(t)
    path = scratch_path(t.spark, "checked")
    report = plans.write_full_features(games, region_defense(t), path, region_codes(t), positions=positions)
    written = t.spark.read.parquet(path).agg(F.lit("written_rows").alias("metric"), F.count(F.lit(1)).alias("value"))
    return publish(report.unionByName(written))
