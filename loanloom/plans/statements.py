"""SQL over registered views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL in this session."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(
    spark: SparkSession, statement: str, args: dict | None = None, **tables: DataFrame
) -> DataFrame:
    """One SQL statement.

    Values go in as ``:name`` markers, DataFrames as ``{name}``; text is never pasted.
    """
    return spark.sql(statement, args=args, **tables)
