"""Column statistics, outliers, histograms and box-plot statistics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import names as N
from formline.functions.columns import null_if_nan
from formline.operators.quantiles import MAX_VALUES, column_partials, exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def describe_columns(df: DataFrame, columns: Sequence[str], max_values: int = MAX_VALUES) -> DataFrame:
    """count, mean, sample std, min, quartiles and max: one row per column.

    All but the quartiles come from the pass that sketches them, whatever the number of columns.
    """
    found, others = exact_quantiles(
        df, columns, QUARTILES, max_values,
        {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    rows = [
        (column, others[column]["count"], others[column]["mean"], others[column]["std"], others[column]["min"],
         *[found[column][q] for q in QUARTILES], others[column]["max"])
        for column in columns
    ]
    numbers = ", ".join(f"{name} double" for name in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count long, {numbers}")


def outlier_columns(df: DataFrame, targets: Sequence[str] = fv.TARGETS) -> list[str]:
    return N.numeric_columns(df, [*fv.CORRELATION_ID_COLUMNS, *targets, *fv.BINARY_COLUMNS])


def _beyond_fences(df: DataFrame, columns: Sequence[str], max_values: int) -> DataFrame:
    """(column, q25, q50, q75, outlier_count, whisker_low, whisker_high): one row per column.

    Outliers lie more than 1.5 interquartile ranges beyond the quartiles; whiskers are the outermost values
    that do not. One pass after the quartiles, with a few numbers per column and batch.
    """
    found, _ = exact_quantiles(df, columns, QUARTILES, max_values)
    quartiles = {column: [found[column][q] for q in QUARTILES] for column in columns}

    def summary(column: str, x: np.ndarray) -> list[tuple]:
        low, _, high = quartiles[column]
        if low is None or not len(x):
            return []
        reach = (high - low) * 1.5
        outside = (x < low - reach) | (x > high + reach)
        within = x[~outside]
        return [(column, int(outside.sum()), float(within.min()) if len(within) else None, float(within.max()) if len(within) else None)]

    parts = column_partials(df, columns, summary, "column string, outside long, low double, high double")
    counted = parts.groupBy("column").agg(F.sum("outside").alias("outlier_count"), F.min("low").alias("whisker_low"), F.max("high").alias("whisker_high"))
    listed = df.sparkSession.createDataFrame([(c, *quartiles[c]) for c in columns], "column string, q25 double, q50 double, q75 double")
    return listed.join(counted, "column", "left").withColumn("outlier_count", F.coalesce("outlier_count", F.lit(0)))


def outlier_summary(
    df: DataFrame, columns: Sequence[str] | None = None, max_values: int = MAX_VALUES
) -> DataFrame:
    """Values beyond 1.5 interquartile ranges, as a count and as a share of all rows (NULLs included)."""
    chosen = outlier_columns(df) if columns is None else list(columns)
    rows = df.agg(F.count(F.lit(1)).alias("_rows"))
    found = _beyond_fences(df, chosen, max_values).crossJoin(F.broadcast(rows))  # one row
    return found.select("column", "outlier_count", F.try_divide(F.col("outlier_count"), F.col("_rows")).alias("outlier_pct"))


def box_stats(df: DataFrame, columns: Sequence[str] = fv.TARGETS, max_values: int = MAX_VALUES) -> DataFrame:
    """Quartiles and whiskers (the outermost values within 1.5 interquartile ranges) per column."""
    return _beyond_fences(df, columns, max_values).select("column", "q25", "q50", "q75", "whisker_low", "whisker_high", "outlier_count")


def literal(value: float | None) -> Column:
    return F.lit(value).cast("double")


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the range of the column, all of them listed; NULLs are left out.

    ``by`` counts each group on the common bins; ``density`` integrates to 1 over each group. Without
    values there is no bin; if all values are equal there is one, of width 0.
    """
    value = null_if_nan(column)
    bounds = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    low, high = bounds["lo"], bounds["hi"]
    if low is None or low == high:
        width, bins, bin_of = 0.0, 1, F.lit(0)
    else:
        width = (high - low) / bins
        bin_of = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    counted = (
        df.filter(value.isNotNull())
        .groupBy(*by, bin_of.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # One row per group and bin from here on. Bins without rows come from the groups, and so from the table.
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin")
    listed = counted.select(*by).distinct().select(*by, every) if by else counted.agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(every)
    counted = listed.join(counted, [*by, "bin"], "left").fillna(0, ["rows"])
    totals = counted.groupBy(*by).agg(F.sum("rows").alias("_total")) if by else None
    counted = counted.withColumns({
        "bin_start": literal(low) + F.col("bin") * F.lit(width),
        "bin_end": literal(low) + (F.col("bin") + 1) * F.lit(width),
    })
    if totals is None:
        return counted
    density = F.try_divide(F.col("rows").cast("double"), F.col("_total") * F.lit(width))
    return counted.join(totals, list(by)).withColumn("density", density).drop("_total")


def density_curve(histogram_rows: DataFrame, bandwidth: float) -> DataFrame:
    """(bin, center, density): a Gaussian kernel estimate from the binned counts of ``histogram``.

    One row holds all bins and becomes one row per bin; the work is the square of the number of bins.
    """
    center = ((F.col("bin_start") + F.col("bin_end")) / 2).alias("center")
    listed = histogram_rows.agg(F.collect_list(F.struct("bin", center, "rows")).alias("bins"), F.sum("rows").alias("total"))
    kernel = lambda x, c: F.exp(-F.pow((c - x["center"]) / bandwidth, F.lit(2.0)) / 2) * x["rows"]
    at = lambda c: F.aggregate(F.transform("bins", lambda x: kernel(x, c)), F.lit(0.0), lambda a, b: a + b)
    scale = F.col("total") * bandwidth * F.sqrt(2 * F.pi())
    return listed.select(F.inline(F.transform("bins", lambda y: F.struct(
        y["bin"].alias("bin"), y["center"].alias("center"), F.try_divide(at(y["center"]), scale).alias("density")))))
