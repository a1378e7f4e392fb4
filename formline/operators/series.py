"""Window features of an entity's time series. The current row is never part of its own feature.

All features of one call share one shuffle by entity. Two kinds of frame occur:

* trailing: the last ``size`` prior rows of the entity (rolling statistics, lag);
* running: all prior rows of the entity or of the entity's season (min, max, sum, count).

Entities with more rows than one task should sort are cut into blocks (see ``layout``). A block
gets the few rows that precede it, which completes its trailing frames, and the running frames are
completed by the totals of the earlier blocks. Results are the same as those of the plain window
(floating-point sums up to the order of addition).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.functions import names as N
from formline.operators.layout import (
    BLOCK, MAX_GROUP_ROWS, PLACE, HotGroups, cut_blocks, find_hot_groups, same_values, stored,
    without_hot,
)


@dataclass(frozen=True)
class SeriesKeys:
    """Columns that make up an entity's time series. (date, tiebreak) orders the rows of an entity."""

    entity: str = "PLAYER_ID"
    date: str = "GAME_DATE"
    tiebreak: str = "GAME_ID"
    season: str = "SEASON"
    nulls_last: bool = False
    max_group_rows: int = MAX_GROUP_ROWS

    def order(self) -> list[Column]:
        parts = [F.col(self.date), F.col(self.tiebreak)]
        return [part.asc_nulls_last() if self.nulls_last else part.asc_nulls_first() for part in parts]

    def reverse_order(self) -> list[Column]:
        parts = [F.col(self.date), F.col(self.tiebreak)]
        return [part.desc_nulls_first() if self.nulls_last else part.desc_nulls_last() for part in parts]

    def with_nulls_last(self) -> SeriesKeys:
        return replace(self, nulls_last=True)


GAME_KEYS = SeriesKeys()


@dataclass(frozen=True)
class Feature:
    """One window column. ``size`` is the length of a trailing frame; 0 stands for a running frame."""

    name: str
    statistic: str
    source: str
    size: int = 0
    per_season: bool = False


STATISTICS: dict[str, Callable[[Column], Column]] = {
    "avg": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
}
# A running statistic of all prior rows from that of the earlier blocks and that of the own block.
COMBINE: dict[str, Callable[[Column, Column], Column]] = {
    "min": F.least,
    "max": F.greatest,
    "sum": lambda earlier, own: F.coalesce(earlier + own, earlier, own),
    "count": lambda earlier, own: F.coalesce(earlier, F.lit(0)) + own,
}
CARRIED = "_carried"
# Hot groups may be handed over when they are known, e.g. from the table before many-to-one joins.
FIND = "find"
Hot = HotGroups | None | str


# ------------------------------------------------------------------------------ feature lists
def rolling_features(targets: Sequence[str], windows: Sequence[int]) -> list[Feature]:
    return [
        Feature(N.rolling_name(target, size, statistic), statistic, target, size)
        for target in targets
        for size in windows
        for statistic in ("avg", "std")
    ]


def min_max_features(targets: Sequence[str], scopes: Sequence[str] = ("season", "career")) -> list[Feature]:
    return [
        Feature(N.history_name(target, scope, statistic), statistic, target, per_season=scope == "season")
        for target in targets
        for scope in scopes
        for statistic in ("min", "max")
    ]


def cumulative_features(targets: Sequence[str]) -> list[Feature]:
    return [Feature(N.cumulative_name(target), "sum", target, per_season=True) for target in targets]


def lag_features(targets: Sequence[str]) -> list[Feature]:
    return [Feature(N.lag_name(target), "lag", target, 1) for target in targets]


def change_columns(targets: Sequence[str]) -> dict[str, Column]:
    return {N.change_name(target): F.col(target) - F.col(N.lag_name(target)) for target in targets}


# ------------------------------------------------------------------------------ evaluation
def add_features(
    df: DataFrame, features: Sequence[Feature], keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND
) -> DataFrame:
    """Append the window columns. ``hot`` may hand over groups found earlier for the same entity."""
    if hot == FIND:
        hot = find_hot_groups(df, [keys.entity], keys.max_group_rows)
    if hot is None:
        return _plain(df, features, keys)
    return _plain(without_hot(df, hot), features, keys).unionByName(_blocked(df, features, keys, hot))


def _expression(feature: Feature, source: Column, trailing: WindowSpec, running: WindowSpec) -> Column:
    if feature.statistic == "lag":
        return F.lag(source, feature.size).over(trailing)
    if feature.size:
        return STATISTICS[feature.statistic](source).over(trailing.rowsBetween(-feature.size, -1))
    return STATISTICS[feature.statistic](source).over(running.rowsBetween(Window.unboundedPreceding, -1))


def _plain(df: DataFrame, features: Sequence[Feature], keys: SeriesKeys) -> DataFrame:
    career = Window.partitionBy(keys.entity).orderBy(*keys.order())
    season = Window.partitionBy(keys.entity, keys.season).orderBy(*keys.order())
    return df.withColumns({
        feature.name: _expression(feature, F.col(feature.source), career, season if feature.per_season else career)
        for feature in features
    })


def _blocked(df: DataFrame, features: Sequence[Feature], keys: SeriesKeys, hot: HotGroups) -> DataFrame:
    blocks = cut_blocks(df, hot, keys.order())
    reach = max((feature.size for feature in features), default=0)
    rows = blocks.withColumn(CARRIED, F.lit(False))
    if reach:
        rows = rows.unionByName(_preceding_rows(blocks, keys, reach))

    career = Window.partitionBy(keys.entity, BLOCK).orderBy(PLACE)
    season = Window.partitionBy(keys.entity, BLOCK, keys.season).orderBy(PLACE)
    computed = {}
    for feature in features:
        source = F.col(feature.source)
        own = source if feature.size else F.when(~F.col(CARRIED), source)
        computed[feature.name] = _expression(feature, own, career, season if feature.per_season else career)
    result = rows.withColumns(computed).filter(~F.col(CARRIED))

    for per_season in (False, True):
        running = [f for f in features if not f.size and f.per_season == per_season]
        if running:
            scope = [keys.entity, keys.season] if per_season else [keys.entity]
            result = _add_earlier_blocks(result, blocks, running, scope)
    return result.select(*df.columns, *[feature.name for feature in features])


def _preceding_rows(blocks: DataFrame, keys: SeriesKeys, reach: int) -> DataFrame:
    """For every block, the last ``reach`` rows of its entity before the block.

    They are among the last ``reach`` rows of the entity's blocks, a table of at most ``reach`` rows
    per block. ``_nth`` numbers that table per entity; a block that starts after ``_start`` of its
    rows is preceded by the numbers ``_start - reach + 1`` to ``_start``. Those lie in two stretches of
    ``reach`` numbers, by which both are joined.
    """
    backwards = Window.partitionBy(keys.entity, BLOCK).orderBy(F.desc(PLACE))
    last = blocks.withColumn("_from_end", F.row_number().over(backwards)).filter(F.col("_from_end") <= reach)
    numbered = Window.partitionBy(keys.entity).orderBy(PLACE)
    tails = stored(last.drop("_from_end").withColumn("_nth", F.row_number().over(numbered)), "block-tails")
    starts = tails.groupBy(F.col(keys.entity).alias("_entity"), F.col(BLOCK).alias("_to_block")).agg(
        (F.min("_nth") - 1).alias("_start")
    )
    stretch = F.floor(F.col("_start") / reach)
    asked = starts.withColumn("_asked", F.explode(F.array(stretch - 1, stretch)))
    offered = tails.withColumn("_stretch", F.floor(F.col("_nth") / reach))
    near = (F.col("_nth") > F.col("_start") - reach) & (F.col("_nth") <= F.col("_start"))
    placed = offered.join(asked, same_values([keys.entity, "_stretch"], ["_entity", "_asked"]) & near)
    return placed.withColumn(BLOCK, F.col("_to_block")).select(*blocks.columns, F.lit(True).alias(CARRIED))


def _add_earlier_blocks(
    result: DataFrame, blocks: DataFrame, features: Sequence[Feature], scope: Sequence[str]
) -> DataFrame:
    """Complete running statistics by those of the earlier blocks (one small row per block and scope)."""
    totals = blocks.groupBy(*scope, BLOCK).agg(
        *[STATISTICS[f.statistic](F.col(f.source)).alias(f.name) for f in features]
    )
    earlier = Window.partitionBy(*scope).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    over_blocks = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}
    carried = stored(totals.select(
        *[F.col(column).alias(f"_at_{column}") for column in [*scope, BLOCK]],
        *[over_blocks[f.statistic](F.col(f.name)).over(earlier).alias(f"_earlier_{f.name}") for f in features],
    ), "block-totals")
    on = [*scope, BLOCK]
    joined = result.join(carried, same_values(on, [f"_at_{column}" for column in on]), "left")
    return joined.withColumns({
        f.name: COMBINE[f.statistic](F.col(f"_earlier_{f.name}"), F.col(f.name)) for f in features
    }).select(*result.columns)


# ------------------------------------------------------------------------------ public operators
def rolling_avg_std(
    df: DataFrame,
    targets: Sequence[str] = fv.TARGETS,
    windows: Sequence[int] = fv.ROLLING_WINDOWS,
    keys: SeriesKeys = GAME_KEYS,
    hot: Hot = FIND,
) -> DataFrame:
    """Average and sample standard deviation of up to ``w`` prior rows."""
    return add_features(df, rolling_features(targets, windows), keys, hot)


def season_min_max(
    df: DataFrame, targets: Sequence[str] = fv.TARGETS, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND
) -> DataFrame:
    return add_features(df, min_max_features(targets, ["season"]), keys, hot)


def career_min_max(
    df: DataFrame, targets: Sequence[str] = fv.TARGETS, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND
) -> DataFrame:
    return add_features(df, min_max_features(targets, ["career"]), keys, hot)


def historical_min_max(
    df: DataFrame, targets: Sequence[str] = fv.TARGETS, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND
) -> DataFrame:
    return add_features(df, min_max_features(targets), keys, hot)


def season_cumulative_total(
    df: DataFrame, targets: Sequence[str] = fv.TARGETS, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND
) -> DataFrame:
    """Sum of the prior rows of the season; NULL (not 0) on its first row."""
    return add_features(df, cumulative_features(targets), keys, hot)


def lag_1(
    df: DataFrame, targets: Sequence[str] = fv.TARGETS, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND
) -> DataFrame:
    return add_features(df, lag_features(targets), keys, hot)


def lag_and_change(
    df: DataFrame, targets: Sequence[str] = fv.TARGETS, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND
) -> DataFrame:
    """The previous value and the change from it. The change holds the current value: never a model input."""
    lagged = lag_1(df, targets, keys, hot)
    changes = change_columns(targets)
    columns = [name for target in targets for name in (N.lag_name(target), N.change_name(target))]
    return lagged.withColumns(changes).select(*df.columns, *columns)


def all_time_series_features(
    df: DataFrame,
    targets: Sequence[str] = fv.TARGETS,
    windows: Sequence[int] = fv.ROLLING_WINDOWS,
    keys: SeriesKeys = GAME_KEYS,
    hot: Hot = FIND,
) -> DataFrame:
    """All window features in one pass: two window specifications, one shuffle."""
    features = [
        *rolling_features(targets, windows),
        *min_max_features(targets),
        *cumulative_features(targets),
        *lag_features(targets),
    ]
    lags = [name for target in targets for name in (N.lag_name(target), N.change_name(target))]
    others = [f.name for f in features if f.statistic != "lag"]
    return (
        add_features(df, features, keys, hot)
        .withColumns(change_columns(targets))
        .select(*df.columns, *others, *lags)
    )


def days_rest(df: DataFrame, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND) -> DataFrame:
    """Days since the entity's previous row, and their category."""
    return rest_and_experience(df, keys, hot).drop("career_games_played")


def career_games_played(df: DataFrame, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND) -> DataFrame:
    """How many rows of the entity come before this one."""
    return rest_and_experience(df, keys, hot).drop("days_rest", "days_rest_category")


def rest_and_experience(df: DataFrame, keys: SeriesKeys = GAME_KEYS, hot: Hot = FIND) -> DataFrame:
    """Rest days, their category and the number of earlier rows, from one window."""
    features = [
        Feature("_previous_date", "lag", keys.date, 1),
        Feature("career_games_played", "count", "_one"),
    ]
    rest = F.datediff(F.col(keys.date), F.col("_previous_date"))
    return (
        add_features(df.withColumn("_one", F.lit(1)), features, keys.with_nulls_last(), hot)
        .withColumn("days_rest", rest.cast("double"))
        .withColumn("days_rest_category", C.days_rest_category("days_rest"))
        .select(*df.columns, "days_rest", "days_rest_category", "career_games_played")
    )


def recent_form(
    df: DataFrame,
    team: str = "TEAM_ID",
    game: str = "GAME_ID",
    date: str = "GAME_DATE",
    result: str = "WL",
    entity: str = "PLAYER_ID",
    games: int = fv.RECENT_FORM_GAMES,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Per (game, team): the share of wins in up to five games the team played before.

    Team-mates repeat a team's game, so the rows are first reduced to one per (game, team). All of
    them carry the same result; taking that of the smallest entity keeps it deterministic, and
    reducing numbers rather than text keeps the aggregate in hash tables.
    """
    team_games = df.groupBy(team, game).agg(
        F.min(date).alias(date), F.min_by(C.win_flag(result), F.col(entity)).alias("team_win")
    )
    keys = SeriesKeys(team, date, game, nulls_last=True, max_group_rows=max_group_rows)
    # The rows of a team bound its games, and counting them needs no de-duplication.
    hot = find_hot_groups(df, [team], max_group_rows)
    if hot is not None:
        hot = find_hot_groups(team_games, [team], max_group_rows)
    form = Feature("recent_form", "avg", "team_win", games)
    return add_features(team_games, [form], keys, hot).select(game, team, date, "team_win", "recent_form")
