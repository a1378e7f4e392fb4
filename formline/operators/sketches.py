"""Distinct counts that add up over partitions: one sketch per season, merged when asked.

An exact distinct count reads all rows again whenever a season is added. A HyperLogLog sketch of a season is a
few kilobytes, is written once, and the sketches of any seasons merge. Estimates carry an error, so the exact
operators (``checks.profile_summary``, ``selection.activity_by_player``) stay what they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Logarithm of a sketch's registers, and the standard error that follows: about 0.65 % of the true count.
LOG_REGISTERS = 14
STANDARD_ERROR = 0.8326 / math.sqrt(1 << LOG_REGISTERS)
# Estimates lie within so many standard errors but for one case in ten thousand.
ERRORS = 4


def season_sketches(logs: DataFrame, distinct: Sequence[str], season: str = "SEASON", by: Sequence[str] = (), date: str = "GAME_DATE") -> DataFrame:
    """One row per season (and value of ``by``): rows, date range, and a sketch of each ``distinct`` column.

    Sketches are built on the map side, so a season of any size shuffles one small row per task.
    """
    return logs.groupBy(season, *by).agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("min_date"), F.max(date).alias("max_date"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LOG_REGISTERS)).alias(f"sketch_{c}") for c in distinct])


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of all rows (or of each value of ``by``) as one: rows, date range, an estimate per column."""
    columns = [c.removeprefix("sketch_") for c in sketches.columns if c.startswith("sketch_")]
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(f"distinct_{c}") for c in columns])


def within_bound(estimate: Column, exact: Column) -> Column:
    """Whether an estimate is as near to the exact count as its error promises."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(ERRORS * STANDARD_ERROR))
