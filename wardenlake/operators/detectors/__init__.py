"""Anomaly detectors over an array column of features.

Every detector adds ``score`` and ``pred`` (1 normal, -1 anomaly); low scores are
abnormal, as in the decision functions of the classic library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outliers(scored: DataFrame) -> DataFrame:
    """Anomalies only, the most abnormal first."""
    return scored.filter(F.col("pred") == -1).orderBy("score")


def outlier_share(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.col("pred") == -1, 1).otherwise(0)).alias("outliers"),
    )


def with_original_columns(scored: DataFrame, original: DataFrame, keys) -> DataFrame:
    """Reattach the columns of the original records by their natural key."""
    extra = [c for c in original.columns if c in keys or c not in scored.columns]
    return scored.join(original.select(*extra), list(keys))
