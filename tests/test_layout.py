from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from formline.operators import layout
from formline.operators import series as S


def test_scratch_lies_in_the_shared_folder(spark):
    session = lambda **conf: SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)))
    named = session(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert layout.scratch_path(named, "blocks").startswith("hdfs:///shared/blocks-")
    unset = session(**{"spark.sql.warehouse.dir": "hdfs:///warehouse"})
    assert layout.scratch_path(unset, "blocks").startswith("hdfs:///warehouse/_scratch/blocks-")
    for master, fits in (("local[4]", True), ("yarn", False)):
        own = session(**{"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"})
        own.sparkContext = SimpleNamespace(master=master)
        if fits:
            assert layout.scratch_path(own, "blocks").startswith("file:/home/me/spark-warehouse/_scratch/blocks-")
        else:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                layout.scratch_path(own, "blocks")


def test_scratch_can_be_removed(spark):
    frame = layout.stored(spark.range(10), "gone")
    assert frame.count() == 10
    folder = Path(frame.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists() and folder.parent == Path(spark.conf.get("spark.checkpoint.dir"))
    layout.remove_scratch(frame)
    assert not folder.exists()


def test_numbers_follow_partitions_and_rows(spark):
    frame = spark.range(1_000, numPartitions=7).filter("id % 3 = 0").withColumn("_row", F.lit("x"))
    found, total = layout.numbered(frame, "n", first=5)
    rows = sorted(tuple(r) for r in found.collect())
    assert total == 334 and found.columns == ["id", "_row", "n"] and [n for _, _, n in rows] == list(range(5, 339))
    nothing, none = layout.numbered(frame.limit(0), "n")
    assert none == 0 and nothing.count() == 0


def test_hot_groups_and_blocks(spark):
    frame = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("o"))
    assert layout.find_hot_groups(frame, ["k"], 500) is None
    hot = layout.find_hot_groups(frame, ["k"], 50)
    assert hot.rows == 600 and {r["hot_k"] for r in hot.table.collect()} == {1, None}
    assert layout.without_hot(frame, hot).count() == 400
    blocks = layout.cut_blocks(frame, hot, [F.col("o")]).collect()
    assert len(blocks) == 600
    for key in (1, None):
        mine = sorted((r["o"], r[layout.BLOCK]) for r in blocks if r["k"] == key)
        assert [b for _, b in mine] == sorted(b for _, b in mine)  # blocks follow the order
        assert len({b for _, b in mine}) > 1


def test_tasks_follow_the_rows_and_not_the_blocks(spark):
    frame = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    blocks = layout.cut_blocks(frame, layout.find_hot_groups(frame, ["k"], 20), [F.col("o")])
    assert len(blocks.inputFiles()) <= spark.sparkContext.defaultParallelism  # there were 150
    sizes = [r["count"] for r in blocks.groupBy(layout.BLOCK).count().collect()]
    assert len(sizes) >= 150 and max(sizes) <= 20


def test_blocked_plan_has_no_cross_join_and_no_python(spark):
    frame = spark.range(2000).select(
        (F.col("id") % 2).alias("PLAYER_ID"), F.col("id").alias("GAME_ID"), F.lit("2024-01-01").cast("date").alias("GAME_DATE"),
        F.lit("s").alias("SEASON"), F.col("id").alias("PTS"))
    result = S.all_time_series_features(frame, ["PTS"], [5], S.SeriesKeys(max_group_rows=100))
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert operator not in plan
