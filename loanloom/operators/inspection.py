"""Schemas and first looks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NumericType


def describe(spark: SparkSession, name: str) -> DataFrame:
    """``(col_name, data_type, comment)`` of a view or table."""
    return spark.sql("describe identifier(:name)", args={"name": name})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    """Columns that need cleaning before they can be model features."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """Any ``rows`` rows; which ones is up to the scan."""
    return df.limit(rows)


def first_value(df: DataFrame, column: str):
    """The column's value in the first row; None for an empty table."""
    row = df.select(column).first()
    return None if row is None else row[0]
