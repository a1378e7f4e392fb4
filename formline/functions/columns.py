"""Scalar column expressions. Each takes Columns (or names) and returns a Column; none needs a UDF."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from formline import fixed_values as fv

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value: ColumnLike) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    return as_column(value).try_cast("double")


def to_whole_number(value: ColumnLike, type_name: str = "int") -> Column:
    """Text to an integer type. ``34.0`` counts as 34; text that is no number becomes NULL."""
    column = as_column(value)
    return F.coalesce(column.try_cast(type_name), column.try_cast("double").try_cast(type_name))


def to_game_date(value: ColumnLike) -> Column:
    """Text, timestamp or date to DATE; malformed text becomes NULL."""
    return as_column(value).try_cast("date")


def null_if_nan(value: ColumnLike) -> Column:
    """Spark treats NaN as a value greater than all others; missing data is NULL here."""
    column = as_column(value).cast("double")
    return F.when(~F.isnan(column), column)


def season_start_year(season: ColumnLike) -> Column:
    """``2023-24`` gives 2023. NULL stays NULL; anything that does not begin with a number raises."""
    text = as_column(season).cast("string")
    return F.when(text.isNotNull(), _or_error(F.split_part(text, F.lit("-"), F.lit(1)).try_cast("int"), "season", text))


def _or_error(parsed: Column, what: str, text: Column) -> Column:
    """The parsed value, or an error that shows the text; independent of the session's ANSI mode."""
    return F.coalesce(parsed, F.raise_error(F.concat(F.lit(f"malformed {what}: "), text)).cast("int"))


def season_label(start_year: ColumnLike) -> Column:
    """2023 gives ``2023-24`` and 1999 gives ``1999-00``."""
    year = as_column(start_year).cast("int")
    return F.format_string("%d-%02d", year, F.pmod(year + 1, F.lit(100)))


def selection_score(
    current_minutes: ColumnLike = "current_minutes",
    previous_minutes: ColumnLike = "previous_minutes",
    current_games: ColumnLike = "current_games",
    previous_games: ColumnLike = "previous_games",
) -> Column:
    weights = fv.SCORE_WEIGHTS
    return (
        as_column(current_minutes) * weights["current_minutes"]
        + as_column(previous_minutes) * weights["previous_minutes"]
        + as_column(current_games) * weights["current_games"]
        + as_column(previous_games) * weights["previous_games"]
    )


def undrafted_pick(draft_round: ColumnLike, draft_pick: ColumnLike) -> Column:
    """The pick text, replaced by ``Undrafted`` where the round is 0."""
    undrafted = as_column(draft_round).cast("string") == fv.UNDRAFTED_ROUND
    return F.when(undrafted, F.lit(fv.UNDRAFTED)).otherwise(as_column(draft_pick).cast("string"))


def contains_flag(text: ColumnLike, marker: str) -> Column:
    """1 when the text holds the marker (literally, no pattern), else 0; NULL stays NULL."""
    return F.contains(as_column(text), F.lit(marker)).cast("int")


def home_flag(matchup: ColumnLike = "MATCHUP") -> Column:
    return contains_flag(matchup, fv.HOME_MARKER)


def away_flag(matchup: ColumnLike = "MATCHUP") -> Column:
    return contains_flag(matchup, fv.AWAY_MARKER)


def opponent_abbreviation(matchup: ColumnLike = "MATCHUP") -> Column:
    return F.nullif(F.regexp_extract(as_column(matchup), fv.OPPONENT_PATTERN, 1), F.lit(""))


def code_to_id(code: ColumnLike, codes: Mapping[str, int] = fv.TEAM_CODES) -> Column:
    """Look a code up in a literal table that is fixed in the program; unknown codes give NULL."""
    pairs = [F.lit(part) for item in codes.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), as_column(code)).cast("long")


def days_rest_category(days_rest: ColumnLike = "days_rest") -> Column:
    days = as_column(days_rest)
    return (
        F.when(days.isNull(), fv.FIRST_GAME)
        .when(days.isin(0, 1, 2), days.cast("int").cast("string"))
        .when(days >= 3, fv.LONG_REST)
        .otherwise(fv.UNKNOWN_REST)
    )


def season_number(start_year: ColumnLike, first_year: ColumnLike) -> Column:
    return as_column(start_year) - as_column(first_year) + 1


def age_at(day: ColumnLike, birth_day: ColumnLike) -> Column:
    """Whole days between the two dates, in years."""
    return F.datediff(as_column(day), as_column(birth_day)) / fv.DAYS_PER_YEAR


def height_inches(height: ColumnLike = "HEIGHT") -> Column:
    """``6-9`` gives 81. NULL stays NULL; malformed text raises, as a silent NULL would hide bad data."""
    text = as_column(height)
    feet = F.split_part(text, F.lit("-"), F.lit(1)).try_cast("int")
    inches = F.split_part(text, F.lit("-"), F.lit(2)).try_cast("int")
    parsed = F.when(F.size(F.split(text, "-")) == 2, feet * 12 + inches)
    return F.when(text.isNotNull(), _or_error(parsed, "height", text))


def draft_pick_number(draft_pick: ColumnLike = "DRAFT_PICK") -> Column:
    return F.coalesce(to_number(draft_pick), F.lit(float(fv.UNDRAFTED_PICK)))


def undrafted_flag(draft_pick: ColumnLike = "DRAFT_PICK") -> Column:
    return F.coalesce((F.lower(as_column(draft_pick)) == fv.UNDRAFTED.lower()).cast("int"), F.lit(0))


def token_flag(text: ColumnLike, separator: str, token: str) -> Column:
    """1 when the token is one of the parts of the text, else 0 (also for NULL)."""
    parts = F.split(as_column(text), "\\Q" + separator + "\\E")
    return F.coalesce(F.array_contains(parts, token).cast("int"), F.lit(0))


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """The quotient, or NULL when the denominator is zero."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def true_shooting(pts: ColumnLike = "PTS", fga: ColumnLike = "FGA", fta: ColumnLike = "FTA") -> Column:
    return safe_divide(pts, (as_column(fga) + as_column(fta) * fv.FREE_THROW_WEIGHT) * 2)


def effective_field_goal(fgm: ColumnLike = "FGM", threes: ColumnLike = "3PM", fga: ColumnLike = "FGA") -> Column:
    return safe_divide(as_column(fgm) + as_column(threes) * fv.THREE_POINT_BONUS, fga)


def win_flag(result: ColumnLike = "WL") -> Column:
    return F.coalesce((as_column(result) == "W").cast("int"), F.lit(0))


def feature_family(feature: ColumnLike = "feature") -> Column:
    """The family of a feature, read from its name; the first family that fits wins."""
    name = as_column(feature)
    by_marker = F.lit(False)
    for marker in fv.TIME_SERIES_MARKERS:
        by_marker = by_marker | F.contains(name, F.lit(marker))
    return (
        F.when(by_marker, "time_series")
        .when(name.isin(fv.CONTEXTUAL_FEATURES) | name.startswith("opponent_"), "contextual")
        .when(name.isin(fv.PLAYER_SPECIFIC_FEATURES) | name.startswith("position_"), "player_specific")
        .otherwise("other")
    )


def recode(value: ColumnLike, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values and keep all others."""
    column = as_column(value)
    result = column
    for old, new in mapping.items():
        result = F.when(column == old, F.lit(new)).otherwise(result)
    return result


def order_position(value: ColumnLike, ordering: Iterable[str]) -> Column:
    """Place of a value in a fixed display order (1-based, 0 when it is not listed)."""
    return F.array_position(F.array(*[F.lit(item) for item in ordering]), as_column(value))
