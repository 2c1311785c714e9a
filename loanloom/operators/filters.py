"""Filters against a constant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _comparable(df: DataFrame, column: str, value) -> Column:
    # A number is never compared with text: Spark would cast every text and abort on a
    # bad one. '1.0' equals 1 and '1.5' differs from it, as in SQL. Columns of any numeric
    # type stay bare, so the filter reaches the scan.
    if isinstance(df.schema[column].dataType, StringType) and not isinstance(value, str):
        return F.col(column).try_cast("double")
    return F.col(column)


def where_not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose value differs from the constant. Null, or text that is no number, drops."""
    return df.where(_comparable(df, column, value) != F.lit(value))


def where_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose value equals the constant."""
    return df.where(_comparable(df, column, value) == F.lit(value))
