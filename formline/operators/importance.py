"""Feature importance: gain, share, rank and family per target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.functions import columns as C
from formline.operators.ranking import rank_features

SCORE_SCHEMA = "target string, feature string, gain double"


def importance_table(scores: DataFrame, features: Sequence[str], model: str) -> DataFrame:
    """Every feature for every target of ``scores`` (target, feature, gain); an absent feature has gain 0.

    ``features`` is the feature list of a model, so the table is as large as a schema times the targets.
    """
    totals = scores.groupBy("target").agg(F.sum("gain").alias("_total"))
    listed = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.lit(i).alias("ordinal")) for i, name in enumerate(features)
    ])
    grid = totals.select("target", "_total", F.inline(listed))
    gain = F.coalesce(F.col("gain"), F.lit(0.0))
    table = grid.join(scores, ["target", "feature"], "left").select(
        F.lit(model).alias("model"),
        "target",
        "feature",
        C.feature_family("feature").alias("feature_family"),
        gain.alias("gain"),
        F.when(F.col("_total") == 0, 0.0).otherwise(gain / F.col("_total")).alias("gain_share"),
        "ordinal",
    )
    return rank_features(table).drop("ordinal")


def gain_share(scores: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Total gain per target and each feature's share of it; 0 where the total is 0."""
    totals = scores.groupBy(*by).agg(F.sum("gain").alias("total_gain"))
    share = F.when(F.col("total_gain") == 0, 0.0).otherwise(F.col("gain") / F.col("total_gain"))
    return scores.join(totals, list(by)).withColumn("gain_share", share)


def family_summary(importance: DataFrame) -> DataFrame:
    return importance.groupBy("model", "target", "feature_family").agg(F.sum("gain_share").alias("gain_share"))


def sorted_family_summary(importance: DataFrame) -> DataFrame:
    return family_summary(importance).orderBy(F.col("target"), F.col("gain_share").desc(), "feature_family")


def family_extremes(pivoted: DataFrame, family: str = "time_series") -> DataFrame:
    """How many targets owe more than half to the family, and the targets with the largest and smallest share."""
    share, place = F.col(family), F.struct(F.col(family), F.col("target"))
    return pivoted.agg(
        F.count_if(share > 0.5).alias("majority_targets"),
        F.count(F.lit(1)).alias("targets"),
        F.max_by("target", place).alias("strongest_target"),
        F.max(share).alias("strongest_share"),
        F.min_by("target", place).alias("weakest_target"),
        F.min(share).alias("weakest_share"),
    )


def top_features(importance: DataFrame, target: str = fv.PRIMARY_TARGET, k: int = 20) -> DataFrame:
    return importance.filter((F.col("target") == target) & (F.col("rank") <= k)).orderBy("rank")
