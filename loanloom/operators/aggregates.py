"""Counts and class shares. All of them stay in the plan as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions import share_percent


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key. Counts are combined before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def class_share(
    df: DataFrame, label: str, positive: int = 1, name: str = "positive_percent"
) -> DataFrame:
    """Percent of rows in the positive class, one scan."""
    return df.agg(share_percent(F.col(label) == positive).alias(name))


def balancing_ratio(df: DataFrame, label: str, name: str = "balancing_ratio") -> DataFrame:
    """``(rows - rows of class 0) / rows`` as one row, one scan; null for an empty table."""
    rows = F.count(F.lit(1))
    return df.agg(
        F.try_divide(
            (rows - F.count_if(F.col(label) == 0)).cast("double"), rows.cast("double")
        ).alias(name)
    )
