"""From logs and rosters to the selected players, their career logs and the lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.operators import enrich, ranking, reshape
from formline.operators.checks import require_columns


def activity_by_player(
    logs: DataFrame, prefix: str, entity: str = "PLAYER_ID", game: str = "GAME_ID", minutes: str = "MIN"
) -> DataFrame:
    """Distinct games and total minutes of each player."""
    require_columns(logs, [minutes], "columns in the game logs")
    return logs.groupBy(entity).agg(
        F.count_distinct(game).alias(f"{prefix}_games"),
        F.coalesce(F.sum(minutes).cast("double"), F.lit(0.0)).alias(f"{prefix}_minutes"),
    )


def join_usage(
    rosters: DataFrame, current: DataFrame, previous: DataFrame, entity: str = "PLAYER_ID"
) -> DataFrame:
    """Rosters with the usage of two seasons; players without logs get zeros."""
    zeros = {f"{season}_{what}": 0 for season in ("current", "previous") for what in ("games", "minutes")}
    return enrich.fill_defaults(rosters.join(current, entity, "left").join(previous, entity, "left"), zeros)


def select_players(
    rosters: DataFrame,
    current_logs: DataFrame,
    previous_logs: DataFrame,
    players_per_team: int = fv.PLAYERS_PER_TEAM,
    team: str = "TEAM_ID",
    entity: str = "PLAYER_ID",
) -> DataFrame:
    """The most active players of each team; equal scores are ordered by minutes and then by player."""
    usage = join_usage(
        rosters,
        activity_by_player(current_logs, "current", entity),
        activity_by_player(previous_logs, "previous", entity),
        entity,
    )
    order = [F.col(c).desc() for c in ("selection_score", "current_minutes", "previous_minutes")] + [F.col(entity)]
    scored = usage.withColumn("selection_score", C.selection_score())
    return ranking.top_k_per_group(scored, [team], order, players_per_team)


def sorted_selection(selected: DataFrame, team_name: str = "TEAM_ABBREVIATION", entity: str = "PLAYER_ID") -> DataFrame:
    return selected.orderBy(F.col(team_name).asc(), F.col("selection_score").desc(), F.col(entity).asc())


def add_player_years(selected: DataFrame, years: DataFrame) -> DataFrame:
    """First and last year of the selected players, and the manual patches."""
    joined = enrich.join_player_years(selected, years)
    if "WEIGHT" in joined.columns:
        joined = enrich.override_values(joined, "PLAYER_ID", "WEIGHT", fv.MANUAL_WEIGHT)
    if "HOW_ACQUIRED" in joined.columns:
        joined = enrich.override_values(joined, "PLAYER_ID", "HOW_ACQUIRED", fv.MANUAL_HOW_ACQUIRED)
    return joined


def earliest_season(selected: DataFrame, first_year: str = "FROM_YEAR") -> DataFrame:
    return selected.agg(F.min(first_year).cast("int").alias("earliest_year"))


def generate_seasons(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Season labels from the first to the last start year, inclusive."""
    years = bounds.select(F.explode(F.sequence(F.col(first).cast("int"), F.col(last).cast("int"))).alias("start_year"))
    return years.withColumn("SEASON", C.season_label("start_year"))


def tag_season(logs: DataFrame, season: str) -> DataFrame:
    return logs.withColumn("SEASON", F.lit(season))


def normalise_logs(logs: DataFrame, season: str) -> DataFrame:
    """One season's raw logs: the three-pointer column under its usual name, and the season."""
    return tag_season(logs.withColumnsRenamed({"FG3M": "3PM"}), season)


def career_logs(
    logs: DataFrame, selected: DataFrame, current_season: str, entity: str = "PLAYER_ID", season: str = "SEASON"
) -> DataFrame:
    """All rows of the selected players from the earliest selected debut to the current season.

    ``logs`` holds all seasons, told apart by the season column: one scan, which skips the folders of other
    seasons where that column partitions the files. The earliest debut is the only value collected.
    """
    first = earliest_season(selected).first()["earliest_year"]
    last = int(current_season.split("-")[0])
    if first is None or first > last:
        raise ValueError(f"No selected player starts by {current_season}.")
    labels = [f"{year}-{(year + 1) % 100:02d}" for year in range(first, last + 1)]
    chosen = logs.withColumnsRenamed({"FG3M": "3PM"}).filter(F.col(season).isin(labels))
    return enrich.keep_selected(chosen, selected, entity)


def normalise_player_info(parts: Sequence[DataFrame]) -> DataFrame:
    """Player profiles stacked, projected, renamed; undrafted players marked; manual weights patched."""
    info = (
        reshape.union_all(parts)
        .select(*fv.PLAYER_PROFILE_SOURCE_COLUMNS)
        .withColumnsRenamed(fv.PLAYER_PROFILE_RENAMES)
        .withColumn("DRAFT_PICK", C.undrafted_pick("DRAFT_ROUND", "DRAFT_PICK"))
    )
    return enrich.override_values(info, "PLAYER_ID", "WEIGHT", fv.MANUAL_WEIGHT)


def team_stats_table(seasons: dict[str, DataFrame]) -> DataFrame:
    """Season totals of the teams from one frame per season (as files per season are read), stacked and tagged."""
    return reshape.union_all([normalise_logs(frame, season) for season, frame in seasons.items()])


def opponent_defense_table(stats: DataFrame) -> DataFrame:
    """The defensive columns of the teams' advanced season statistics; ``stats`` holds all seasons."""
    return stats.select(*fv.OPPONENT_DEFENSE_COLUMNS)
