"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.operators.layout import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
# A source's weight at time t in [0, 1] is weight * (1 + slope * (2 t - 1)): its integral over time is the weight.
SLOPES = (-0.5, 0.0, 0.5)
SHARE, CAP = 1.5, 2.0
# Rows of one source that one task puts into order.
RUN_ROWS = 10_000


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, slopes: Sequence[float] = SLOPES,
                   share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size) with ``target`` and ``slope``: one row per source.

    Sources by code point, null last, take the weights in turn and share ``share`` times all sizes. A target
    stops at ``cap`` times its source's size; what is left over is shared again by weight. Sorted by
    cap * size / weight the sources that stop come first, so the common level is found with running sums.
    """
    def nth(values: Sequence[float], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))

    names = Window.orderBy(F.asc_nulls_last("source"))
    rows = totals.withColumn("_at", F.row_number().over(names) - 1)
    rows = rows.withColumn("_w", nth(weights, F.col("_at"))).withColumn("slope", nth(slopes, F.col("_at")))
    rows = rows.withColumn("_most", F.col("source_size") * F.lit(float(cap)))
    by_level = Window.orderBy((F.col("_most") / F.col("_w")).asc(), "_at")
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.row_number().over(by_level).alias("_rank"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("_all"),
        F.coalesce(F.sum("_most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_stopped"),
        F.sum("_w").over(by_level.rowsBetween(0, Window.unboundedFollowing)).alias("_left"))
    rows = rows.withColumn("_level", (F.col("_all") - F.col("_stopped")) / F.col("_left"))
    free = F.when(F.col("_most") > F.col("_level") * F.col("_w"), F.struct("_rank", "_level"))
    rows = rows.withColumn("_first", F.min(free).over(everything))
    goes = F.col("_first").isNotNull() & (F.col("_rank") >= F.col("_first._rank"))
    return rows.withColumn("target", F.when(goes, F.least(F.col("_first._level") * F.col("_w"), F.col("_most"))).otherwise(F.col("_most"))) \
        .select("source", "source_size", "target", "slope")


def position_at(demand: Column, slope: Column) -> Column:
    """The time at which a share ``demand`` of a source's tokens has been asked for.

    Demand up to t is the integral t + slope * (t^2 - t); the root in [0, 1] inverts it.
    """
    straight = F.abs(slope) < 1e-12
    root = F.sqrt(F.pow(1 - slope, F.lit(2.0)) + 4 * slope * demand)
    return F.when(straight, demand).otherwise((root - (1 - slope)) / (2 * F.when(straight, F.lit(1.0)).otherwise(slope)))


def curriculum_plan(df: DataFrame, size: str = "size", source: str = "source", weights: Sequence[float] = WEIGHTS,
                    slopes: Sequence[float] = SLOPES, share: float = SHARE, cap: float = CAP, seed: int = 0,
                    run_rows: int = RUN_ROWS) -> DataFrame:
    """All rows and columns of ``df`` with what the mix takes of them and when.

    Adds ``source_size``, ``target`` (tokens the mix takes from the source), ``copies`` (times the row is
    taken), ``taken`` (copies * size) and ``positions`` (one training position in [0, 1] per copy).
    A source's rows form one random order, repeated epoch by epoch; the mix takes the rows whose middle
    lies before the target, so a source misses its target by half a row at most. Position: the share of the
    source's target that lies before the middle of the row, inverted through the integrated schedule.

    The running sums need no task that holds a source: rows are cut by hash into runs, runs are summed
    (a map-side combined aggregate), and a window orders the rows of one run only.
    Sizes are whole numbers; null counts as 0 and gives no tokens. Null sources are one source, the last.
    Rows with equal values are interchangeable: any of them may be the one taken once more. An empty table
    gives an empty table. Columns of ``df`` with the added names are replaced; names with _mx_ are reserved.
    """
    added = ("source_size", "target", "copies", "taken", "positions")
    columns = [c for c in df.columns if c not in added]
    hashed = [F.col(f"`{c}`") for c, kind in df.dtypes if c in columns and "map<" not in kind and kind != "variant"]
    runs = max(1, math.ceil(df.count() / run_rows))
    rows = df.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col(f"`{source}`").cast("string").alias("_mx_source"),
        F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long").alias("_mx_size"),
        F.xxhash64(F.lit(seed), *hashed).alias("_mx_key"))
    rows = rows.withColumn("_mx_run", F.floor(
        F.pmod(F.shiftright("_mx_key", 20), F.lit(1 << 30)) * runs / F.lit(float(1 << 30))).cast("int"))

    sums = stored(rows.groupBy("_mx_source", "_mx_run").agg(F.sum("_mx_size").alias("_mx_sum")), "mix-runs")
    totals = sums.groupBy(F.col("_mx_source").alias("source")).agg(F.sum("_mx_sum").alias("source_size"))
    targets = source_targets(totals, weights, slopes, share, cap)
    earlier = Window.partitionBy("_mx_source").orderBy("_mx_run").rowsBetween(Window.unboundedPreceding, -1)
    runs_before = sums.select("_mx_source", "_mx_run", F.coalesce(F.sum("_mx_sum").over(earlier), F.lit(0)).alias("_mx_base"))
    runs_before = runs_before.join(targets, F.col("_mx_source").eqNullSafe(F.col("source"))).select(
        F.col("_mx_source").alias("_mx_s"), F.col("_mx_run").alias("_mx_r"), "_mx_base", "source_size", "target", "slope")

    within = Window.partitionBy("_mx_source", "_mx_run").orderBy("_mx_key", *[
        F.col(f"`{c}`") for c, kind in df.dtypes if c in columns and kind in ("bigint", "int", "string") and c != "text"])
    placed = rows.withColumn("_mx_end", F.sum("_mx_size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(runs_before, F.col("_mx_source").eqNullSafe(F.col("_mx_s")) & (F.col("_mx_run") == F.col("_mx_r")))
    middle = F.col("_mx_base") + F.col("_mx_end") - F.col("_mx_size") / 2
    # Epoch e takes the row when e * source_size + middle lies before the target.
    copies = F.when(F.col("_mx_size") == 0, 0).otherwise(F.greatest(
        F.lit(0), F.ceil((F.col("target") - middle) / F.col("source_size"))))
    placed = placed.withColumn("copies", copies.cast("int")).withColumn("_mx_middle", middle)
    epochs = F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda e: F.struct(
        (e * F.col("source_size") + F.col("_mx_middle")).alias("done")))
    spot = lambda x: position_at(F.least(F.lit(1.0), x["done"] / F.col("target")), F.col("slope"))
    positions = F.when(F.col("copies") > 0, F.transform(epochs, spot)).otherwise(F.array().cast("array<double>"))
    return placed.select(
        *[F.col(f"`{c}`") for c in columns], "source_size", "target", "copies",
        (F.col("copies") * F.col("_mx_size")).cast("long").alias("taken"), positions.alias("positions"))


def curriculum_rows(plan: DataFrame) -> DataFrame:
    """One row per copy that the mix takes, sorted by training position: the mixed corpus.

    Columns of the plan's table, then ``copy`` (0, 1, ...) and ``position``. The sort is a range exchange.
    """
    kept = [F.col(f"`{c}`") for c in plan.columns if c not in ("positions", "copy", "position")]
    return plan.select(*kept, F.posexplode("positions").alias("copy", "position")).orderBy("position", "copy")
