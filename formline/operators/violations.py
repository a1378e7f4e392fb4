"""Broken rules as data, and checks that ride on the job that writes a table.

A rule gives rows (rule, key, rows): what breaks it, and how many rows do. ``require_none`` turns them into an
error. ``write_checked`` watches the rows of a build while they are written, so that a checked table is
computed and read once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.operators.checks import GAME_KEY, duplicate_groups
from formline.operators.layout import unused_name
from formline.sources.writers import write_features

SCHEMA = "rule string, key string, rows long"


class BrokenRules(ValueError):
    """Rules that do not hold; ``violations`` is the frame of everything that breaks them."""

    def __init__(self, message: str, violations: DataFrame):
        super().__init__(message)
        self.violations = violations


def _key(columns: Sequence[str]) -> Column:
    """The values of a key as text, comma-joined; NULL is written out."""
    return F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")) for c in columns])


def _rows(df: DataFrame, rule: str, key: Column, rows: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.alias("key"), rows.cast("long").alias("rows"))


def repeated_keys(df: DataFrame, keys: Sequence[str] = GAME_KEY, rule: str = "unique_key") -> DataFrame:
    """Keys that stand on more than one row: the contract of a lookup, and of a table with a row per game."""
    return _rows(duplicate_groups(df, keys), rule, _key(keys), F.col("rows"))


def changed_rowcount(before: DataFrame, after: DataFrame, rule: str = "same_rowcount") -> DataFrame:
    """One row if a step lost or added rows: from how many to how many, and the difference."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    both = count(before, "had").crossJoin(F.broadcast(count(after, "has")))  # one row each
    return _rows(both.filter(F.col("had") != F.col("has")), rule, F.concat_ws(" to ", F.col("had").cast("string"), F.col("has").cast("string")),
                 F.abs(F.col("has") - F.col("had")))


def unknown_entities(facts: DataFrame, lookup: DataFrame, entity: str = "PLAYER_ID", rule: str = "known_entity") -> DataFrame:
    """Entities of the facts that the lookup lacks; a missing entity is unknown as well.

    The facts are counted per entity before they are joined.
    """
    counted = facts.groupBy(entity).agg(F.count(F.lit(1)).alias("rows"))
    return _rows(counted.join(lookup.select(entity).distinct(), entity, "left_anti"), rule, _key([entity]), F.col("rows"))


def codes_without_id(df: DataFrame, code: str = "opponent_abbreviation", mapped: str = "opponent_team_id", rule: str = "mapped_code") -> DataFrame:
    """Codes for which no id was found; a row without a code counts as one."""
    return _rows(df.filter(F.col(mapped).isNull()).groupBy(code).agg(F.count(F.lit(1)).alias("rows")), rule, _key([code]), F.col("rows"))


def absent_columns(df: DataFrame, columns: Sequence[str], rule: str = "column_present") -> DataFrame:
    """Columns that the schema lacks; no row breaks this rule, so ``rows`` is 0."""
    return df.sparkSession.createDataFrame([(rule, c, 0) for c in columns if c not in df.columns], SCHEMA)


def dates_on_both_sides(train: DataFrame, test: DataFrame, date: str = "GAME_DATE", rule: str = "disjoint_dates") -> DataFrame:
    """Dates of train rows on or after the first test date, with their rows; rows without a date are in neither part."""
    first = test.agg(F.min(date).alias("_first"))
    days = train.groupBy(F.col(date).alias("_day")).agg(F.count(F.lit(1)).alias("rows"))  # as long as the calendar
    return _rows(days.join(F.broadcast(first), F.col("_day") >= F.col("_first")), rule, F.date_format("_day", "yyyy-MM-dd"), F.col("rows"))


def stacked(violations: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, violations)


def require_none(violations: DataFrame, examples: int = 5) -> None:
    """Raise ``BrokenRules`` if there is a violation, with some of each kind in the message."""
    kinds = violations.groupBy("rule").agg(F.count(F.lit(1)).alias("keys"), F.min("key").alias("first"), F.max("key").alias("last")).orderBy("rule").limit(examples).collect()
    if kinds:
        told = "; ".join(f"{kind['rule']} is broken by {kind['keys']}, e.g. {kind['first']!r}" for kind in kinds)
        raise BrokenRules(told, violations)


# ------------------------------------------------------------------------- checks in flight
def write_checked(
    base: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, partition_by: Sequence[str] = (),
    keys: Sequence[str] = GAME_KEY, mapped: Sequence[str] = ("opponent_team_id",), columns: Sequence[str] = fv.IMPORTANT_COLUMNS,
) -> DataFrame:
    """Write ``build(base)`` and return its report (metric, value), or raise ``BrokenRules`` and leave ``path`` alone.

    The job that writes the table counts the rows that go into the build and come out of it, repeated keys,
    rows without a ``mapped`` id, and the missing values of ``columns``; nothing is read for that. Rows are told
    to be repeated by a window over ``keys``, which sorts inside the partitions of the entity's windows. The
    table is written beside ``path`` and takes its place when all rules hold.
    """
    spark = base.sparkSession
    went_in, came_out = Observation(f"in-{uuid.uuid4().hex}"), Observation(f"out-{uuid.uuid4().hex}")
    full = build(base.observe(went_in, F.count(F.lit(1)).alias("rows")))
    repeat = unused_name(full, "_repeat")
    marked = full.withColumn(repeat, F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) > 1)
    present = [c for c in columns if c in full.columns]
    watched = marked.observe(
        came_out, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(repeat)).alias("repeated"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"unmapped_{i}") for i, c in enumerate(mapped)],
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"missing_{i}") for i, c in enumerate(present)])
    beside = f"{path.rstrip('/')}.unchecked-{uuid.uuid4().hex}"
    write_features(watched.drop(repeat), beside, partition_by)
    before, after = went_in.get, came_out.get
    report = {
        "base_rows": before["rows"], "base_columns": len(base.columns), "full_rows": after["rows"], "full_columns": len(full.columns),
        "new_columns": len(full.columns) - len(base.columns), "duplicate_keys": after["repeated"],
        **{f"missing_{c}": after[f"missing_{i}"] for i, c in enumerate(present)}}
    broken = [("same_rowcount", f"{before['rows']} to {after['rows']}", abs(before["rows"] - after["rows"])), ("unique_key", ",".join(keys), after["repeated"]),
              *[("mapped_code", c, after[f"unmapped_{i}"]) for i, c in enumerate(mapped)]]
    broken = [row for row in broken if row[2]]
    if broken:
        _delete(spark, beside)
        raise BrokenRules("; ".join(f"{rule} is broken by {rows} rows ({key})" for rule, key, rows in broken), spark.createDataFrame(broken, SCHEMA))
    take_place(spark, beside, path)
    return spark.createDataFrame(list(report.items()), "metric string, value long")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def take_place(spark: SparkSession, written: str, path: str) -> None:
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(Path(path), True)
    if not files.rename(Path(written), Path(path)):
        raise OSError(f"{written} is checked, but could not be moved to {path}.")


def report_values(report: DataFrame) -> Mapping[str, int]:
    """A report as a dictionary; it has a row per metric."""
    return {row["metric"]: row["value"] for row in report.collect()}
