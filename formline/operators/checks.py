"""Data-quality checks and the reports behind them. The ``require_*`` functions raise ``ValueError``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import names as N

GAME_KEY = ("PLAYER_ID", "GAME_ID")


def wide_to_long(df: DataFrame, parts: dict[str, dict[str, Column]], key: str = "column") -> DataFrame:
    """One aggregate over all columns, then one output row per entry of ``parts``.

    ``parts`` maps a label to named aggregate expressions. All of them are computed in one pass over
    the data; only the single result row is turned into rows.
    """
    names = list(next(iter(parts.values())))
    wide = df.agg(*[
        F.struct(F.lit(label).alias(key), *[expressions[name].alias(name) for name in names]).alias(f"_{i}")
        for i, (label, expressions) in enumerate(parts.items())
    ])
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(parts))])))


def missing_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


# ---------------------------------------------------------------------------------- reports
def profile_summary(
    df: DataFrame, entity: str = "PLAYER_ID", season: str = "SEASON", date: str = "GAME_DATE"
) -> DataFrame:
    """Rows, distinct entities, distinct seasons and the date range."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(entity).alias("players"),
        F.count_distinct(season).alias("seasons"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str] = GAME_KEY) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def duplicate_keys(df: DataFrame, keys: Sequence[str] = GAME_KEY) -> DataFrame:
    """Number of duplicated key groups, and of the rows beyond the first of each group."""
    return duplicate_groups(df, keys).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column. Without a list, the time-series features of the frame."""
    chosen = N.time_series_columns(df) if columns is None else list(columns)
    return wide_to_long(df, {column: {"null_count": missing_count(column)} for column in chosen})


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and share of the columns that have any."""
    chosen = df.columns if columns is None else list(columns)
    share = lambda c: F.try_divide(missing_count(c), F.count(F.lit(1)))
    parts = {c: {"missing_count": missing_count(c), "missing_pct": share(c)} for c in chosen}
    return wide_to_long(df, parts).filter(F.col("missing_count") > 0)


def selected_ranges(df: DataFrame, columns: Sequence[str] = fv.RANGE_COLUMNS) -> DataFrame:
    """Min, max and average of those of the named columns that exist."""
    present = [column for column in columns if column in df.columns]
    return wide_to_long(df, {
        column: {
            "min": F.min(column).cast("double"),
            "max": F.max(column).cast("double"),
            "avg": F.avg(column),
        }
        for column in present
    })


def merge_report(
    before: DataFrame,
    lookup: DataFrame,
    merged: DataFrame,
    entity: str = "PLAYER_ID",
    keys: Sequence[str] = GAME_KEY,
    metadata: Sequence[str] | None = None,
) -> DataFrame:
    """(metric, value): sizes before and after, entities on both sides, lost ones, duplicates, missing metadata."""
    chosen = [c for c in lookup.columns if c != entity] if metadata is None else list(metadata)
    rows = F.count(F.lit(1))
    return _metrics([
        (before, {"input_rows": rows, "input_columns": F.max(F.lit(len(before.columns))),
                  "players_in_features": F.count_distinct(entity)}),
        (lookup, {"lookup_rows": rows, "players_in_lookup": F.count_distinct(entity)}),
        (merged, {"merged_rows": rows, "merged_columns": F.max(F.lit(len(merged.columns)))}
         | {f"missing_{column}": missing_count(column) for column in chosen}),
        (missing_entities(before, lookup, entity), {"missing_players": rows}),
        (duplicate_groups(merged, keys), {"duplicate_keys": F.sum(F.col("rows") - 1)}),
    ])


def full_feature_report(
    base: DataFrame,
    full: DataFrame,
    columns: Sequence[str] = fv.IMPORTANT_COLUMNS,
    keys: Sequence[str] = GAME_KEY,
) -> DataFrame:
    """(metric, value): row and column counts before and after, duplicates, NULLs of the important columns."""
    present = [column for column in columns if column in full.columns]
    rows = F.count(F.lit(1))
    return _metrics([
        (base, {"base_rows": rows, "base_columns": F.max(F.lit(len(base.columns)))}),
        (full, {"full_rows": rows, "full_columns": F.max(F.lit(len(full.columns))),
                "new_columns": F.max(F.lit(len(full.columns) - len(base.columns)))}
         | {f"missing_{column}": missing_count(column) for column in present}),
        (duplicate_groups(full, keys), {"duplicate_keys": F.sum(F.col("rows") - 1)}),
    ])


def _metrics(parts: Sequence[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """One aggregate per frame, stacked as (metric, value)."""
    stacked = [
        wide_to_long(df, {
            name: {"value": F.coalesce(value.cast("long"), F.lit(0).cast("long"))} for name, value in metrics.items()
        }, key="metric")
        for df, metrics in parts
    ]
    return reduce(DataFrame.unionByName, stacked)


def missing_entities(facts: DataFrame, lookup: DataFrame, entity: str = "PLAYER_ID") -> DataFrame:
    """Entities that occur in the facts but not in the lookup."""
    return facts.select(entity).distinct().join(lookup.select(entity), entity, "left_anti")


def unmapped_codes(
    df: DataFrame, code: str = "opponent_abbreviation", mapped: str = "opponent_team_id"
) -> DataFrame:
    """Distinct codes for which the lookup found no id."""
    return df.filter(F.col(mapped).isNull() & F.col(code).isNotNull()).select(code).distinct()


# ---------------------------------------------------------------------------------- checks
def require_columns(df: DataFrame, columns: Sequence[str], what: str = "columns") -> None:
    absent = [column for column in columns if column not in df.columns]
    if absent:
        raise ValueError(f"Missing {what}: {absent}")


def unique_by(df: DataFrame, keys: Sequence[str], name: str = "lookup") -> DataFrame:
    """The frame with one row per key; a key that occurs twice raises when its row is computed.

    One aggregate per key, combined before the shuffle, in place of a check that runs by itself.
    """
    others = [column for column in df.columns if column not in keys]
    shown = F.concat_ws(", ", *[F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("NULL")) for key in keys])
    message = F.concat(F.lit(f"{name} has more than one row for {', '.join(keys)} "), shown)
    one = df.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(
        F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others])).alias("_row"))
    checked = F.when(F.col("_rows") == 1, F.col("_row")).otherwise(F.raise_error(message).cast(one.schema["_row"].dataType))
    return one.withColumn("_row", checked).select(*[
        F.col(f"`{column}`") if column in keys else F.col(f"_row.`{column}`").alias(column) for column in df.columns])


def require_unique(df: DataFrame, keys: Sequence[str], name: str = "lookup") -> None:
    """The many-to-one contract of a lookup join."""
    offending = duplicate_groups(df, keys).limit(5).collect()
    if offending:
        values = [tuple(row[key] for key in keys) for row in offending]
        raise ValueError(f"{name} has more than one row for {', '.join(keys)}, e.g. {values}")


def require_no_duplicates(df: DataFrame, keys: Sequence[str] = GAME_KEY) -> None:
    if not duplicate_groups(df, keys).isEmpty():
        raise ValueError(f"Duplicate {' + '.join(keys)} rows.")


def require_same_rowcount(before: DataFrame, after: DataFrame) -> None:
    counts = before.count(), after.count()
    if counts[0] != counts[1]:
        raise ValueError(f"Row count changed from {counts[0]} to {counts[1]}.")


def require_entities(facts: DataFrame, lookup: DataFrame, entity: str = "PLAYER_ID") -> None:
    absent = missing_entities(facts, lookup, entity).orderBy(entity).limit(10).collect()
    if absent:
        raise ValueError(f"Missing metadata for {entity} values: {[row[0] for row in absent]}")


class UnmappedCodes(ValueError):
    """Codes without an id; ``codes`` is the frame of all of them."""

    def __init__(self, codes: DataFrame, count: int, examples: Sequence[str]):
        super().__init__(f"{count} codes have no id, e.g. {list(examples)}; see the exception's 'codes' for all.")
        self.codes, self.count = codes, count


def require_mapped_codes(
    df: DataFrame, code: str = "opponent_abbreviation", mapped: str = "opponent_team_id"
) -> None:
    """Every row needs a mapped id; a row without a code counts as unmapped as well."""
    codes = df.filter(F.col(mapped).isNull()).select(code).distinct()
    found = codes.agg(F.count(F.lit(1)).alias("count"), F.min(code).alias("first"), F.max(code).alias("last")).first()
    if found["count"]:
        raise UnmappedCodes(codes, found["count"], sorted({c for c in (found["first"], found["last"]) if c is not None}))
