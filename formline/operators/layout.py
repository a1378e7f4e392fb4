"""Groups too large for one task: how they are found, and how they are cut into ordered blocks.

An ordered window sends all rows of a group to one task. That is right for a group of thousands of
rows and wrong for one that holds a third of the table. ``find_hot_groups`` counts the groups (a
partial aggregate over the key columns alone), and ``cut_blocks`` range-partitions the rows of
those over the limit by (group, order), so that every block is a contiguous stretch of one group's
order with a bounded number of rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one group that a single window task is asked to sort.
MAX_GROUP_ROWS = 2_000_000
# Rows that a task orders where blocks are smaller: tasks and files follow the rows, not the blocks.
TASK_ROWS = 250_000
BLOCK, PLACE = "_block", "_in_order"
# Bits of ``monotonically_increasing_id`` that number the rows of a partition.
ROW_BITS = 33


@dataclass(frozen=True)
class HotGroups:
    """Groups with more rows than one task should sort."""

    keys: tuple[str, ...]
    table: DataFrame  # one row per hot group; key columns named hot_<key>
    rows: int
    block_rows: int

    def matches(self) -> Column:
        return same_values(self.keys, [f"hot_{key}" for key in self.keys])


def same_values(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality that also pairs NULL with NULL, as grouping and windows do."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    A session without the setting gets one inside its warehouse. On a cluster that has to be a place all
    executors reach: a warehouse in a local folder is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if root.startswith(("/", "file:")) and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"Name a folder that all executors reach in spark.checkpoint.dir; {root} is on the driver's machine.")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    It is computed once, keeps its rows when executors are lost, and has a known size, by which
    Catalyst decides whether to broadcast it. Files go when the job that asked for them is over:
    see ``remove_scratch``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` returned, once nothing lazy reads it any more."""
    spark = df.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def find_hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> HotGroups | None:
    """The groups with more than ``max_rows`` rows, or None when there are none (the usual case)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_rows)
    found = sizes.agg(F.sum("_rows").alias("rows")).first()
    if found["rows"] is None:
        return None
    # At most rows / max_rows groups qualify.
    table = stored(sizes.select(*[F.col(key).alias(f"hot_{key}") for key in keys]), "hot-groups")
    return HotGroups(tuple(keys), table, found["rows"], max_rows)


def cut_blocks(df: DataFrame, hot: HotGroups, order: Sequence[Column]) -> DataFrame:
    """The rows of the hot groups with a place and a block number that follow the order within each group.

    A block has ``block_rows`` rows at most and is numbered by its first place. The range bounds come from
    a sample, which affects only how even the tasks are. The result is stored, so that every later use of
    it sees the same numbers, also where rows tie in the order.
    """
    least = max(math.ceil(hot.rows / TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    tasks = min(math.ceil(hot.rows / hot.block_rows), least)
    by = [*[F.col(key) for key in hot.keys], *order]
    ranged = df.join(hot.table, hot.matches(), "left_semi").repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    row = F.col(PLACE).bitwiseAND((1 << ROW_BITS) - 1)
    return stored(ranged.withColumn(PLACE, F.monotonically_increasing_id()).withColumn(BLOCK, F.col(PLACE) - row % hot.block_rows), "blocks")


def without_hot(df: DataFrame, hot: HotGroups) -> DataFrame:
    return df.join(hot.table, hot.matches(), "left_anti")


def unused_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front where the frame has such a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, column: str, first: int = 0, label: str = "numbered") -> tuple[DataFrame, int]:
    """The rows with a gapless number in the order of the partitions and of the rows in them; and how many there are.

    The frame is stored with a number per partition and row. What the driver adds up is one count per partition.
    """
    mark = unused_name(df, "_row")
    marked = stored(df.withColumn(mark, F.monotonically_increasing_id()), label)
    part = F.shiftright(mark, ROW_BITS).cast("int")
    sizes = marked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()
    begins, total = [], 0
    for size in sizes:
        begins.append((size["part"], total + first))
        total += size["rows"]
    offsets = df.sparkSession.createDataFrame(begins, "_part int, _begin long")
    placed = marked.join(F.broadcast(offsets), part == F.col("_part"))  # one row per partition
    number = F.col("_begin") + F.col(mark).bitwiseAND((1 << ROW_BITS) - 1)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns if c != column], number.alias(column)), total
