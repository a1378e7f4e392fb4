"""Ranks, top-k per group, samples per group, and ordered heads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.operators.layout import numbered, stored

# Rows of one input partition that the first round of a top-k takes together: 2 ** RUN_BITS.
RUN_BITS = 20
# Accuracy of a sketch, and the shares of a group that it is asked for: 1, 1/2, 1/4 and so on.
SKETCH, SHARE_STEPS = 10_000, 24
# Standard deviations by which a sample's draw threshold lies above the wanted number of rows.
MARGIN = 6


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(name) for name in names]


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group. ``order`` has to be total for a deterministic result.

    A first round keeps k rows of each group and run of about a million input rows, so no task sorts a
    large group, whatever k and however many rows are alike. The second takes the best of those.
    """
    place = rank or "_place"
    run = Window.partitionBy(*group, "_run").orderBy(*order)
    first = (
        df.withColumn("_run", F.shiftright(F.monotonically_increasing_id(), RUN_BITS))
        .withColumn("_run_place", F.row_number().over(run))
        .filter(F.col("_run_place") <= k)
        .drop("_run", "_run_place")
    )
    ranked = first.withColumn(place, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    kept = ranked.filter(F.col(place) <= k)
    return kept if rank else kept.drop(place)


def top_k_by_value(
    df: DataFrame, group: Sequence[str], by: str, k: int, ties: Sequence[Column], descending: bool = True, rank: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group by a number, then by ``ties``, for any k; rows without the number come last.

    A sketch per group gives a value that about 1 to 2 k rows reach; only those are shuffled and ranked. They are
    counted first: a group that fell short, or has fewer numbers than k, is ranked whole.
    """
    value = F.col(by).cast("double") if descending else -F.col(by).cast("double")
    shares = [2.0 ** -i for i in range(SHARE_STEPS)]
    names = [f"_g_{name}" for name in group]
    sketches = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_numbers"),
        F.percentile_approx(value, [1.0 - share for share in shares], F.lit(SKETCH)).alias("_reached"))
    # The smallest share that holds k rows in spite of the sketch's error.
    needed = F.try_divide(F.lit(float(k + 1)), F.col("_numbers")) + F.lit(2.0 / SKETCH)
    step = F.greatest(F.floor(-F.log2(F.least(needed, F.lit(1.0)))), F.lit(0)).cast("int")
    least = F.when(F.col("_numbers") > k, F.get("_reached", F.least(step, F.lit(SHARE_STEPS - 1))))
    bounds = stored(sketches.select(*[F.col(g).alias(n) for g, n in zip(group, names)], "_rows", F.when(step > 0, least).alias("_least")), "bounds")
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names)])
    reach = df.withColumn("_value", value).join(bounds, same)
    kept = reach.filter(F.col("_least").isNull() | (F.col("_value") >= F.col("_least")))
    short = kept.filter(F.col("_least").isNotNull()).groupBy(*names).agg(F.count(F.lit(1)).alias("_kept")).filter(F.col("_kept") < k) \
        .select(*[F.col(n).alias(f"_short{n}") for n in names])
    among = lambda columns: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_short{n}")) for c, n in zip(columns, names)])
    chosen = kept.join(short, among(names), "left_anti").select(*df.columns).unionByName(df.join(short, among(group), "left_semi"))
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return top_k_per_group(chosen, group, [first, *ties], k, rank)


def sample_per_group(df: DataFrame, group: Sequence[str], n: int, seed: int, key: Sequence[str]) -> DataFrame:
    """Up to ``n`` rows of each group without replacement. The same seed and keys give the same rows.

    Rows are drawn in the order of md5(seed|keys). The group's size (a partial aggregate) tells below which
    draw its first n rows lie, up to a margin; only rows below it are ranked. A group that fell short in
    spite of the margin is ranked whole.
    """
    drawn = df.withColumn("_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), *_columns(key)).cast("binary")))
    wanted = n + MARGIN * n ** 0.5 + MARGIN * MARGIN
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).select(
        *[F.col(name).alias(f"_g_{name}") for name in group], "_rows",
        F.least(F.lit(1.0), F.lit(float(wanted)) / F.col("_rows")).alias("_share"))
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_g_{name}")) for name in group])
    place = F.conv(F.substring("_draw", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    sized = drawn.join(sizes, same)
    low = sized.filter(place < F.col("_share"))
    short = low.groupBy(*[f"_g_{name}" for name in group]).agg(
        F.count(F.lit(1)).alias("_low"), F.any_value("_rows").alias("_all")).filter(F.col("_low") < F.least(F.lit(n), F.col("_all")))
    rest = drawn.join(short, same, "left_semi").select(*drawn.columns)
    kept = low.select(*drawn.columns).join(short, same, "left_anti").unionByName(rest)
    return top_k_per_group(kept, group, [F.col("_draw"), *_columns(key)], n).drop("_draw")


def rank_features(
    df: DataFrame, group: Sequence[str] = ("target",), gain: str = "gain", ordinal: str = "ordinal"
) -> DataFrame:
    """Rank by falling gain within a target; equal gains keep the order of the feature list.

    A group holds one row per model feature, so its size is that of a schema.
    """
    window = Window.partitionBy(*group).orderBy(F.col(gain).desc(), F.col(ordinal).asc())
    return df.withColumn("rank", F.row_number().over(window))


def sort_mixed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sorted by several keys, each with its own direction; for display and export."""
    return df.orderBy(*order)


def positioned(df: DataFrame, order: Sequence[Column], column: str = "position") -> DataFrame:
    """The rows with their place in the order, from 1, as data: an order that joins, files and other engines can tell.

    A range sort, and the sizes of its partitions added up; no task sees more than its part of the order.
    Equal rows get places in any order, so let keys break ties.
    """
    return numbered(df.orderBy(*order), column, first=1, label="sorted")[0]


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_n_distinct(df: DataFrame, column: str, order: str, n: int = 30) -> DataFrame:
    """The first ``n`` distinct values of a column in ranked order."""
    return (
        df.groupBy(column).agg(F.min(order).alias("first_rank"))
        .orderBy(F.col("first_rank"), F.col(column)).limit(n)
    )


def sort_chronological(
    df: DataFrame, date: str = "GAME_DATE", game: str = "GAME_ID", entity: str = "PLAYER_ID"
) -> DataFrame:
    """For display and export only: windows carry their own order."""
    return df.orderBy(*chronological(date, game, entity))


def chronological(date: str = "GAME_DATE", game: str = "GAME_ID", entity: str = "PLAYER_ID") -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in (date, game, entity)]
