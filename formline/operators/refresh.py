"""Window features of new rows from a carried state, without the history.

The state of an entity is what its next rows can see: its last rows, as many as the longest trailing frame, and
the totals of its career and of its seasons. New rows are computed from the state and themselves; the state
moves on with them. The result is that of a full build, row by row, as long as new rows come later than those
of the state; ``late_rows`` tells which do not.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.operators import series as S
from formline.operators.layout import same_values, stored
from formline.operators.series import COMBINE, STATISTICS, Feature, SeriesKeys
from formline.operators.violations import require_none, take_place

CARRIED, OWN = "_is_carried", "_own_"
# The totals of two stretches of rows from those of each.
MERGE = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}


@dataclass(frozen=True)
class SeriesState:
    """``tails``: the last rows of every entity. ``career``, ``seasons``: its running totals, one column per feature."""

    tails: DataFrame
    career: DataFrame
    seasons: DataFrame

    def save(self, path: str) -> None:
        """All three tables, written beside ``path`` and moved there together."""
        spark, beside = self.tails.sparkSession, f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
        for name in ("tails", "career", "seasons"):
            getattr(self, name).write.parquet(f"{beside}/{name}")
        take_place(spark, beside, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SeriesState:
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in ("tails", "career", "seasons")])


def _running(features: Sequence[Feature], per_season: bool) -> list[Feature]:
    return [f for f in features if not f.size and f.per_season == per_season]


def _columns(features: Sequence[Feature], keys: SeriesKeys) -> list[str]:
    return list(dict.fromkeys([keys.entity, keys.date, keys.tiebreak, keys.season, *[f.source for f in features]]))


def _totals(rows: DataFrame, features: Sequence[Feature], scope: Sequence[str]) -> DataFrame:
    """One aggregate per scope, combined before the shuffle."""
    found = [STATISTICS[f.statistic](F.col(f.source)).alias(f.name) for f in features]
    return rows.groupBy(*scope).agg(*found, F.count(F.lit(1)).alias("_rows"))


def _last_rows(rows: DataFrame, keys: SeriesKeys, reach: int) -> DataFrame:
    """The last ``reach`` rows of every entity. Spark keeps that many per entity and task before the shuffle."""
    backwards = Window.partitionBy(keys.entity).orderBy(*keys.reverse_order())
    return rows.withColumn("_from_end", F.row_number().over(backwards)).filter(F.col("_from_end") <= reach).drop("_from_end")


def series_state(history: DataFrame, features: Sequence[Feature], keys: SeriesKeys = S.GAME_KEYS) -> SeriesState:
    """The state after all rows of ``history``."""
    rows = history.select(*_columns(features, keys))
    reach = max([f.size for f in features] + [1])
    return SeriesState(
        stored(_last_rows(rows, keys, reach), "tails"), stored(_totals(rows, _running(features, False), [keys.entity]), "career"),
        stored(_totals(rows, _running(features, True), [keys.entity, keys.season]), "seasons"))


def late_rows(new: DataFrame, state: SeriesState, keys: SeriesKeys = S.GAME_KEYS) -> DataFrame:
    """(rule, key, rows): entities with new rows that do not come after those of the state, and how many do not."""
    place = lambda: F.struct(F.col(keys.date).isNull() == F.lit(keys.nulls_last), keys.date, keys.tiebreak)
    last = state.tails.groupBy(F.col(keys.entity).alias("_entity")).agg(F.max(place()).alias("_last"))
    early = new.join(last, F.col(keys.entity).eqNullSafe(F.col("_entity"))).filter(place() <= F.col("_last"))
    return early.groupBy(F.col(keys.entity).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("later_than_state").alias("rule"), "key", "rows")


def extend_features(new: DataFrame, state: SeriesState, features: Sequence[Feature], keys: SeriesKeys = S.GAME_KEYS) -> tuple[DataFrame, SeriesState]:
    """The new rows with their window columns, and the state after them.

    Read are the new rows, and of the state the entities that have any. Entities with very many new rows are cut
    into blocks as in a full build. Raises ``BrokenRules`` for rows that come too late.
    """
    require_none(late_rows(new, state, keys))
    touched = new.select(F.col(keys.entity).alias("_entity")).distinct()
    tails = state.tails.join(touched, F.col(keys.entity).eqNullSafe(F.col("_entity")), "left_semi")
    rows = new.withColumn(CARRIED, F.lit(False)).unionByName(tails.withColumn(CARRIED, F.lit(True)), allowMissingColumns=True)
    # Running frames hold new rows alone, as the totals of the state are added.
    sources = {f.source for f in features if not f.size}
    rows = rows.withColumns({f"{OWN}{source}": F.when(~F.col(CARRIED), F.col(source)) for source in sources})
    seen = [f if f.size else Feature(f.name, f.statistic, f"{OWN}{f.source}", 0, f.per_season) for f in features]
    result = S.add_features(rows, seen, keys).filter(~F.col(CARRIED))
    for totals, running, scope in (
        (state.career, _running(features, False), [keys.entity]), (state.seasons, _running(features, True), [keys.entity, keys.season])):
        if running:
            earlier = totals.select(*[F.col(c).alias(f"_at_{c}") for c in scope], *[F.col(f.name).alias(f"_earlier_{f.name}") for f in running])
            joined = result.join(earlier, same_values(scope, [f"_at_{c}" for c in scope]), "left")
            completed = {f.name: COMBINE[f.statistic](F.col(f"_earlier_{f.name}"), F.col(f.name)) for f in running}
            result = joined.withColumns(completed).select(*result.columns)
    return result.select(*new.columns, *[f.name for f in features]), _moved_on(new, state, features, keys)


def _moved_on(new: DataFrame, state: SeriesState, features: Sequence[Feature], keys: SeriesKeys) -> SeriesState:
    rows = new.select(*_columns(features, keys))
    reach = max([f.size for f in features] + [1])

    def merged(before: DataFrame, running: Sequence[Feature], scope: Sequence[str]) -> DataFrame:
        both = before.unionByName(_totals(rows, running, scope))
        return both.groupBy(*scope).agg(*[MERGE[f.statistic](f.name).alias(f.name) for f in running], F.sum("_rows").alias("_rows"))

    return SeriesState(
        stored(_last_rows(state.tails.unionByName(rows), keys, reach), "tails"), stored(merged(state.career, _running(features, False), [keys.entity]), "career"),
        stored(merged(state.seasons, _running(features, True), [keys.entity, keys.season]), "seasons"))


def time_series_list(targets: Sequence[str] = fv.TARGETS, windows: Sequence[int] = fv.ROLLING_WINDOWS) -> list[Feature]:
    """The window columns of ``series.all_time_series_features``, but for changes, which follow from the lags."""
    return [*S.rolling_features(targets, windows), *S.min_max_features(targets), *S.cumulative_features(targets), *S.lag_features(targets)]


def refresh_features(
    new: DataFrame, path: str, state_path: str, targets: Sequence[str] = fv.TARGETS, windows: Sequence[int] = fv.ROLLING_WINDOWS,
    keys: SeriesKeys = S.GAME_KEYS,
) -> DataFrame:
    """Extend the feature table at ``path`` (partitioned by season) by new rows, and the state beside it.

    Only the seasons of the new rows are written again: their old rows are read, joined by the new ones and
    replace their folders at once (dynamic partition overwrite), so a run that died can be run again with the
    same state; rows with the keys of new ones are replaced. The state is written last, under ``state_path``.
    Returns the new rows as written.
    """
    spark = new.sparkSession
    state = SeriesState.load(spark, state_path)
    features, after = extend_features(new, state, time_series_list(targets, windows), keys)
    features = stored(features.withColumns(S.change_columns(targets)), "refreshed")
    seasons = [row[0] for row in features.select(keys.season).distinct().collect()]  # as many as a batch has seasons
    old = spark.read.parquet(path).filter(_among(keys.season, seasons))
    same = [F.col(f"_new_{c}").eqNullSafe(F.col(c)) for c in (keys.entity, keys.tiebreak)]
    fresh = features.select(*[F.col(c).alias(f"_new_{c}") for c in (keys.entity, keys.tiebreak)])
    whole = stored(old.join(fresh, same[0] & same[1], "left_anti").unionByName(features), "seasons")
    whole.hint("rebalance", keys.season).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(keys.season).parquet(path)
    after.save(state_path)
    return features


def _among(column: str, values: Sequence[str]) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known

