"""Many-to-one lookup joins, keyed patches and encodings.

Lookups grow with the number of entities, so none is broadcast by hint: Catalyst broadcasts a side
whose size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where
adaptive execution splits skewed partitions of the fact side. Lookup keys are checked to be unique.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.operators import checks, series
from formline.operators.layout import MAX_GROUP_ROWS


def lookup_join(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], renames: Mapping[str, str] | None = None,
    name: str = "lookup",
) -> DataFrame:
    """Left join to a lookup with one row per key. Row count is preserved; duplicate keys raise.

    The check is part of the plan: nothing runs while it is built, and the lookup is computed once.
    """
    right = checks.unique_by(lookup.withColumnsRenamed(dict(renames or {})), keys, name)
    return df.join(right, list(keys), "left").select(*df.columns, *[c for c in right.columns if c not in keys])


def join_player_info(features: DataFrame, player_info: DataFrame, entity: str = "PLAYER_ID") -> DataFrame:
    return lookup_join(features, player_info, [entity], name="player_info")


def already_enriched(df: DataFrame, columns: Sequence[str] = fv.PLAYER_INFO_COLUMNS) -> bool:
    """True when all metadata columns are present, so that the join can be skipped."""
    return set(columns) <= set(df.columns)


def join_opponent_defense(features: DataFrame, opponent_defense: DataFrame) -> DataFrame:
    """Win share and defensive rating of the opponent in the season.

    The values are those of the whole season, so early games see later results; this is how the
    feature is defined.
    """
    renames = fv.OPPONENT_DEFENSE_RENAMES
    right = opponent_defense.select("SEASON", *renames)
    return lookup_join(features, right, ["SEASON", renames["TEAM_ID"]], renames, "opponent_defense")


def join_recent_form(
    features: DataFrame,
    team: str = "TEAM_ID",
    opponent: str = "opponent_team_id",
    game: str = "GAME_ID",
    date: str = "GAME_DATE",
    result: str = "WL",
    entity: str = "PLAYER_ID",
    max_group_rows: int = MAX_GROUP_ROWS,
    source: DataFrame | None = None,
) -> DataFrame:
    """The opponent's recent form in each game. One row per (game, team) by construction: no check needed.

    ``source`` may name the table to read the games from, when ``features`` is that table with more
    columns: the joins and windows behind those need not run again for it.
    """
    form = series.recent_form(
        features if source is None else source, team=team, game=game, date=date, result=result, entity=entity, max_group_rows=max_group_rows
    ).select(game, F.col(team).alias(opponent), F.col("recent_form").alias("opponent_recent_form"))
    joined = features.join(form, [game, opponent], "left")
    return joined.select(*features.columns, "opponent_recent_form")


def keep_selected(df: DataFrame, selected: DataFrame, entity: str = "PLAYER_ID") -> DataFrame:
    return df.join(selected.select(entity), entity, "left_semi").select(*df.columns)


def join_player_years(selected: DataFrame, years: DataFrame) -> DataFrame:
    """First and last year of each player, from text that may hold non-numbers."""
    right = years.select(
        F.col("PERSON_ID").alias("PLAYER_ID"),
        C.to_number("FROM_YEAR").alias("FROM_YEAR"),
        C.to_number("TO_YEAR").alias("TO_YEAR"),
    )
    return lookup_join(selected, right, ["PLAYER_ID"], name="player years")


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Replace values of the columns that ``overrides`` holds, for the keys it lists."""
    columns = [column for column in overrides.columns if column != key]
    patched = df.join(
        checks.unique_by(overrides, [key], "overrides").select(key, *[F.col(column).alias(f"_new_{column}") for column in columns]), key, "left"
    )
    return patched.select(*[
        F.coalesce(F.col(f"_new_{c}").cast(df.schema[c].dataType), F.col(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ])


def override_values(df: DataFrame, key: str, column: str, values: Mapping[int, object]) -> DataFrame:
    """The same for a handful of values written in the program."""
    result: Column = F.col(column)
    for key_value, value in values.items():
        result = F.when(F.col(key) == key_value, F.lit(value).cast(df.schema[column].dataType)).otherwise(result)
    return df.withColumn(column, result)


def map_codes(
    df: DataFrame, codes: DataFrame | Mapping[str, int] = fv.TEAM_CODES,
    code: str = "opponent_abbreviation", mapped: str = "opponent_team_id",
) -> DataFrame:
    """Code to id, by a literal table or by a table of (code, id); unknown codes give NULL."""
    if isinstance(codes, Mapping):
        return df.withColumn(mapped, C.code_to_id(code, codes))
    return lookup_join(df, codes.select(code, mapped), [code], name="code table")


def parse_matchup(df: DataFrame, matchup: str = "MATCHUP") -> DataFrame:
    return df.withColumns({
        "home_game": C.home_flag(matchup),
        "away_game": C.away_flag(matchup),
        "opponent_abbreviation": C.opponent_abbreviation(matchup),
    })


def token_rows(df: DataFrame, keys: Sequence[str], column: str, separator: str = "-") -> DataFrame:
    """(keys, token): one row per non-empty token of a multi-valued text column, for vocabularies of any size."""
    pattern = "\\Q" + separator + "\\E"
    tokens = F.explode(F.array_distinct(F.split(F.col(column), pattern))).alias("token")
    return df.select(*keys, tokens).filter(F.col("token") != "")


def token_vocabulary(df: DataFrame, column: str, separator: str = "-") -> list[str]:
    """Distinct non-empty tokens, sorted. They become column names: pass the smallest table that has them all."""
    tokens = token_rows(df.select(column).distinct(), [], column, separator).distinct()
    return sorted(row["token"] for row in tokens.collect())


def multi_hot(
    df: DataFrame, column: str, separator: str = "-", prefix: str = "", vocabulary: Sequence[str] | None = None
) -> DataFrame:
    """One 0/1 column per token, in alphabetical order."""
    tokens = token_vocabulary(df, column, separator) if vocabulary is None else list(vocabulary)
    return df.withColumns({f"{prefix}{token}": C.token_flag(column, separator, token) for token in tokens})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL replaced per column by a default of the column's kind."""
    return df.fillna(dict(defaults))


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in the given order, column by column from the same row.

    An aggregate rather than a window, so duplicates are reduced before the shuffle.
    """
    others = [column for column in df.columns if column not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[
        F.col(column) if column in keys else F.col(f"_first.`{column}`").alias(column) for column in df.columns
    ])
