"""From game logs to the full feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.operators import checks, enrich, series, violations
from formline.operators.layout import find_hot_groups
from formline.operators.series import GAME_KEYS, SeriesKeys


def enrich_with_player_info(features: DataFrame, player_info: DataFrame) -> DataFrame:
    """Player metadata on every row, unless it is there already; every player has to be known."""
    if enrich.already_enriched(features, player_info.columns):
        return features
    checks.require_entities(features, player_info)
    return enrich.join_player_info(features, player_info)


def _parsed(features: DataFrame, codes: DataFrame | Mapping[str, int], keys: SeriesKeys) -> DataFrame:
    typed = features.withColumn(keys.date, C.to_game_date(keys.date))
    return enrich.map_codes(enrich.parse_matchup(typed), codes)


def _with_opponent(
    features: DataFrame, opponent_defense: DataFrame, keys: SeriesKeys, games: DataFrame
) -> DataFrame:
    defended = enrich.join_opponent_defense(features, opponent_defense)
    return enrich.join_recent_form(
        defended, game=keys.tiebreak, date=keys.date, entity=keys.entity, max_group_rows=keys.max_group_rows,
        source=games.withColumn(keys.date, C.to_game_date(keys.date)),
    )


def _player_columns(
    features: DataFrame, profiles: DataFrame, keys: SeriesKeys, positions: Sequence[str] | None
) -> DataFrame:
    """Columns that follow from a row alone. ``profiles`` is where the position tokens are looked up."""
    start_year = C.season_start_year(keys.season)
    dated = features.withColumn("BIRTHDATE", F.to_date("BIRTHDATE")).withColumns({
        "season_start_year": start_year,
        "season_number": C.season_number(start_year, "FROM_YEAR"),
        "age_at_game": C.age_at(keys.date, "BIRTHDATE"),
        "height_inches": C.height_inches("HEIGHT"),
        "draft_pick_numeric": C.draft_pick_number("DRAFT_PICK"),
        "is_undrafted": C.undrafted_flag("DRAFT_PICK"),
    })
    vocabulary = enrich.token_vocabulary(profiles, "POSITION") if positions is None else positions
    return enrich.multi_hot(dated, "POSITION", prefix="position_", vocabulary=vocabulary)


def contextual_features(
    features: DataFrame,
    opponent_defense: DataFrame,
    codes: DataFrame | Mapping[str, int] = fv.TEAM_CODES,
    keys: SeriesKeys = GAME_KEYS,
) -> DataFrame:
    """Home and away, opponent, rest days, the opponent's season strength and recent form."""
    hot = find_hot_groups(features.select(keys.entity), [keys.entity], keys.max_group_rows)
    rested = series.days_rest(_parsed(features, codes, keys), keys, hot)
    return _with_opponent(rested, opponent_defense, keys, features)


def player_specific_features(
    features: DataFrame, keys: SeriesKeys = GAME_KEYS, positions: Sequence[str] | None = None
) -> DataFrame:
    """Experience, age, height, draft and position columns."""
    return _player_columns(series.career_games_played(features, keys), features, keys, positions)


def advanced_metrics(features: DataFrame) -> DataFrame:
    """Shooting ratios of the game; NULL without attempts."""
    return features.withColumns({
        "true_shooting_pct": C.true_shooting(),
        "effective_fg_pct": C.effective_field_goal(),
        "three_point_attempt_rate": C.safe_divide("FG3A", "FGA"),
        "free_throw_attempt_rate": C.safe_divide("FTA", "FGA"),
    })


def build_full_features(
    features: DataFrame,
    opponent_defense: DataFrame,
    codes: DataFrame | Mapping[str, int] = fv.TEAM_CODES,
    keys: SeriesKeys = GAME_KEYS,
    positions: Sequence[str] | None = None,
) -> DataFrame:
    """Contextual, player-specific and ratio columns, with one shuffle by entity for all windows."""
    hot = find_hot_groups(features.select(keys.entity), [keys.entity], keys.max_group_rows)
    windowed = series.rest_and_experience(_parsed(features, codes, keys), keys, hot)
    joined = _with_opponent(windowed, opponent_defense, keys, features)
    return advanced_metrics(_player_columns(joined, features, keys, positions))


def write_full_features(
    features: DataFrame,
    opponent_defense: DataFrame,
    path: str,
    codes: DataFrame | Mapping[str, int] = fv.TEAM_CODES,
    keys: SeriesKeys = GAME_KEYS,
    positions: Sequence[str] | None = None,
) -> DataFrame:
    """Build, check and write the full feature table by season in one job; returns the report, or raises and writes nothing."""
    build = lambda base: build_full_features(base, opponent_defense, codes, keys, positions)
    return violations.write_checked(features, build, path, [keys.season], keys=(keys.entity, keys.tiebreak))


def validate_full_features(base: DataFrame, full: DataFrame, keys: Sequence[str] = checks.GAME_KEY) -> DataFrame:
    """Raise on lost or doubled rows and unmapped opponents; otherwise the report.

    ``full`` is read several times here: write it first, and pass the written table.
    """
    checks.require_same_rowcount(base, full)
    checks.require_no_duplicates(full, keys)
    checks.require_mapped_codes(full)
    return checks.full_feature_report(base, full, keys=keys)
