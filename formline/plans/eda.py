"""All tables of the exploratory analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline import fixed_values as fv
from formline.operators import checks, correlation, profile

# Rows of the reports that show the strongest entries only.
SHOWN = 30


def eda_profile(
    features: DataFrame, targets: Sequence[str] = fv.TARGETS, engineered: Sequence[str] = fv.ENGINEERED_COLUMNS
) -> dict[str, DataFrame]:
    """Summary, missing values, distributions, correlations, outliers and collinear pairs.

    Every entry reads the table; keep or write it before asking for all of them.
    """
    shown = [column for column in engineered if column in features.columns]
    targets = [target for target in targets if target in features.columns]
    tables = {
        "summary": checks.profile_summary(features),
        "missing": checks.missing_summary(features),
        "target_summary": profile.describe_columns(features, targets),
        "feature_summary": profile.describe_columns(features, shown),
        "target_correlations": correlation.target_correlations(features, targets),
        "outliers": profile.outlier_summary(features),
        "target_boxes": profile.box_stats(features, targets),
        "collinear_pairs": correlation.collinear_pairs(features),
    }
    tables |= {
        "top_missing": tables["missing"].orderBy(F.col("missing_pct").desc(), "column").limit(SHOWN),
        "top_target_correlations": correlation.top_pairs(tables["target_correlations"], SHOWN),
        "top_outliers": tables["outliers"].orderBy(F.col("outlier_pct").desc(), "column").limit(SHOWN),
        "top_collinear_pairs": correlation.top_pairs(tables["collinear_pairs"], SHOWN),
    }
    tables |= {f"histogram_{target}": profile.histogram(features, target, 50) for target in targets}
    return tables | {f"histogram_{column}": profile.histogram(features, column, 40) for column in shown}
