"""New rows from a carried state against a full build."""

import random
from datetime import date, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from formline.operators import refresh
from formline.operators import series as S
from formline.operators.violations import BrokenRules
from formline.sources import writers
from formline.suite import series as queries

SCHEMA = "PLAYER_ID int, GAME_ID int, GAME_DATE date, SEASON string, PTS double, REB int"


def games(spark, n=300, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = date(2020, 1, 1) + timedelta(days=i * 2 + rng.randrange(2))
        rows.append((rng.choice([1, 1, 1, 2, 3, None]), i, day, f"{day.year}-x", rng.choice([None, 1.5 * rng.randrange(40)]), rng.randrange(9)))
    return spark.createDataFrame(rows, SCHEMA)


def as_rows(df, columns):
    near = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(near(r[c]) for c in columns) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [2_000_000, 20])  # plain windows, and blocks for the new rows of large entities
def test_batches_equal_a_full_build(spark, limit):
    keys = S.SeriesKeys(max_group_rows=limit)
    listed = refresh.time_series_list(["PTS", "REB"], [3, 20]) + [S.Feature("games", "count", "REB")]
    rows = games(spark)
    whole = S.add_features(rows, listed, S.GAME_KEYS)
    state = refresh.series_state(rows.filter("GAME_ID < 100"), listed, keys)
    found = []
    for low, high in ((100, 103), (103, 104), (104, 260), (260, 300)):
        new = rows.filter(f"GAME_ID >= {low} and GAME_ID < {high}")
        more, state = refresh.extend_features(new, state, listed, keys)
        assert more.columns == whole.columns
        found += as_rows(more, whole.columns)
    assert sorted(found, key=str) == as_rows(whole.filter("GAME_ID >= 100"), whole.columns)
    assert state.tails.groupBy("PLAYER_ID").count().agg(F.max("count")).first()[0] <= 20


def test_rows_that_come_late_are_refused(spark):
    listed = refresh.time_series_list(["PTS"], [3])
    rows = games(spark)
    state = refresh.series_state(rows.filter("GAME_ID < 200"), listed)
    late = rows.filter("GAME_ID between 190 and 205")
    broken = refresh.late_rows(late, state)
    assert {r["rule"] for r in broken.collect()} == {"later_than_state"} and broken.agg(F.sum("rows")).first()[0] == 10
    with pytest.raises(BrokenRules, match="later_than_state"):
        refresh.extend_features(late, state, listed)
    nothing, same = refresh.extend_features(rows.limit(0), state, listed)
    assert nothing.count() == 0 and same.tails.count() == state.tails.count()


def test_only_touched_seasons_are_written_again(spark, tmp_path):
    path, state_path = str(tmp_path / "features"), str(tmp_path / "state")
    rows, listed = games(spark), refresh.time_series_list(["PTS"], [5])
    whole = S.all_time_series_features(rows, ["PTS"], [5])
    writers.write_features(S.all_time_series_features(rows.filter("GAME_ID < 250"), ["PTS"], [5]), path, ["SEASON"])
    refresh.series_state(rows.filter("GAME_ID < 250"), listed).save(state_path)
    files = lambda season: sorted(p.name for p in (tmp_path / "features" / f"SEASON={season}").glob("*.parquet"))
    before = files("2020-x")
    new = rows.filter("GAME_ID >= 250")
    refresh.SeriesState.load(spark, state_path).save(str(tmp_path / "kept"))
    refresh.refresh_features(new, path, state_path, ["PTS"], [5])
    refresh.refresh_features(new, path, str(tmp_path / "kept"), ["PTS"], [5])  # run again with the old state: rows are replaced
    assert files("2020-x") == before
    assert as_rows(spark.read.parquet(path), whole.columns) == as_rows(whole, whole.columns)


def test_the_query_joins_the_lines_once(spark, monkeypatch):
    seen = []

    def label_split(df, *rest):
        seen.append(df.inputFiles())
        raise InterruptedError

    monkeypatch.setattr(queries.split, "label_split", label_split)
    day = F.lit("1995-03-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate")
    orders = spark.range(5).select(F.col("id").alias("o_custkey"), F.col("id").alias("o_orderkey"), day, F.lit(1.5).alias("o_totalprice"))
    lines = spark.range(9).select((F.col("id") % 5).alias("l_orderkey"), F.lit(2.0).alias("l_quantity"))
    with pytest.raises(InterruptedError):
        queries.refresh_features(SimpleNamespace(spark=spark, orders=orders, lineitem=lines))
    assert seen[0] and all("/logs-" in file for file in seen[0])
