"""CSV in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    sep: str = ",",
    header: bool = True,
    corrupt_column: str | None = None,
    **options,
) -> DataFrame:
    """Scan CSV files.

    Pass ``schema``: without it Spark reads the whole input once more to infer types, and
    one stray text row turns a numeric column into text. With ``corrupt_column`` the
    schema gets one more column that holds the raw line of rows that do not fit.
    """
    reader = spark.read.options(header=header, sep=sep, **options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt_column:
        schema = StructType([*schema.fields]).add(corrupt_column, StringType())
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt_column)
    return reader.schema(schema).csv(path)


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    mode: str = "errorifexists",
    **options,
) -> None:
    """Write CSV files; blanks at either end of a text are kept.

    Null and empty text both read back as null. To tell them apart write and read with the
    same ``nullValue`` option, for example ``\\N``.
    """
    df.write.mode(mode).options(
        header=header,
        sep=sep,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        **options,
    ).csv(path)


def csv_view(
    spark: SparkSession, name: str, path: str, sep: str = ",", header: bool = True
) -> DataFrame:
    """SQL form of :func:`read_csv` with inferred types; the view stays in the session."""
    spark.sql(
        "create or replace temporary view identifier(:name) using csv "
        "options (path :path, sep :sep, header :header, inferSchema true)",
        args={"name": name, "path": path, "sep": sep, "header": str(header).lower()},
    )
    return spark.table(name)
