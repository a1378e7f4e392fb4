"""Rules as data, and a build that is checked while it is written."""

import pytest
from pyspark.sql import functions as F

from formline.operators import violations as V

GAMES = "PLAYER_ID int, GAME_ID int, GAME_DATE date, opponent_abbreviation string, opponent_team_id int"


def games(spark):
    return spark.createDataFrame([(1, 1, None, "BOS", 5), (1, 2, None, "XXX", None), (2, 1, None, None, None), (2, 1, None, "XXX", None), (None, 3, None, "BOS", 5)], GAMES)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rules_name_what_breaks_them(spark):
    rows = games(spark)
    assert found(V.repeated_keys(rows)) == [("unique_key", "2,1", 2)]
    assert found(V.changed_rowcount(rows, rows.filter("GAME_ID = 1"))) == [("same_rowcount", "5 to 3", 2)]
    assert found(V.changed_rowcount(rows, rows)) == []
    lookup = spark.createDataFrame([(1,), (1,)], "PLAYER_ID int")
    assert found(V.unknown_entities(rows, lookup)) == [("known_entity", "2", 2), ("known_entity", "NULL", 1)]
    assert found(V.codes_without_id(rows)) == [("mapped_code", "NULL", 1), ("mapped_code", "XXX", 2)]
    assert found(V.absent_columns(rows, ["GAME_ID", "PTS"])) == [("column_present", "PTS", 0)]
    dated = spark.sql("SELECT * FROM VALUES (date'2024-01-01'), (date'2024-01-05'), (date'2024-01-05'), (null) AS t(GAME_DATE)")
    test = spark.sql("SELECT date'2024-01-03' AS GAME_DATE")
    assert found(V.dates_on_both_sides(dated, test)) == [("disjoint_dates", "2024-01-05", 2)]
    assert found(V.dates_on_both_sides(dated, test.limit(0))) == []


def test_violations_raise(spark):
    rows = games(spark)
    V.require_none(V.repeated_keys(rows.filter("GAME_ID > 1")))
    with pytest.raises(V.BrokenRules, match="mapped_code is broken by 2, e.g. 'NULL'; unique_key is broken by 1") as raised:
        V.require_none(V.stacked([V.repeated_keys(rows), V.codes_without_id(rows)]))
    assert raised.value.violations.count() == 3


def whole(spark):
    return spark.range(100).selectExpr("cast(id % 10 as int) PLAYER_ID", "cast(id as int) GAME_ID", "'2020' SEASON", "1 opponent_team_id", "if(id < 7, null, 1) home_game")


def test_a_build_is_checked_by_the_job_that_writes_it(spark, tmp_path):
    path = str(tmp_path / "full")
    base, tracker = whole(spark), spark.sparkContext.statusTracker()
    build = lambda df: df.withColumn("more", F.col("GAME_ID") + 1)
    spark.sparkContext.setJobGroup("plain", "")
    build(base).write.parquet(str(tmp_path / "plain"))
    spark.sparkContext.setJobGroup("checked", "")
    report = V.report_values(V.write_checked(base, build, path, columns=["home_game"]))
    jobs = len(tracker.getJobIdsForGroup("checked")), len(tracker.getJobIdsForGroup("plain"))
    spark.sparkContext.setJobGroup("", "")
    assert report == {"base_rows": 100, "base_columns": 5, "full_rows": 100, "full_columns": 6, "new_columns": 1, "duplicate_keys": 0, "missing_home_game": 7}
    assert jobs[0] <= jobs[1] + 2  # the window's shuffle under adaptive execution, and the rows of the report
    assert spark.read.parquet(path).count() == 100


@pytest.mark.parametrize("build, told", [
    (lambda df: df.filter("GAME_ID > 3"), "same_rowcount is broken by 4 rows"), (lambda df: df.withColumn("GAME_ID", F.col("GAME_ID") % 20), "unique_key is broken by 80 rows"),
    (lambda df: df.withColumn("opponent_team_id", F.when(F.col("GAME_ID") > 90, 1)), "mapped_code is broken by 91 rows")])
def test_a_broken_build_leaves_the_old_table(spark, tmp_path, build, told):
    path = tmp_path / "full"
    whole(spark).limit(3).write.parquet(str(path))
    with pytest.raises(V.BrokenRules, match=told) as raised:
        V.write_checked(whole(spark), build, str(path))
    assert raised.value.violations.count() == 1
    assert spark.read.parquet(str(path)).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["full"]
