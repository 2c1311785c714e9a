"""Managed tables in the session catalog, through SQL with parameter markers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def create_table_as(
    df: DataFrame,
    database: str,
    table: str,
    fmt: str = "parquet",
    location: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Create the database if needed, create the table from ``df``, drop an older one.

    ``location`` is the folder of the database, taken only when the database is new.
    With ``path`` the files go to that empty folder and outlive the table's entry.
    """
    if not re.fullmatch(r"[A-Za-z][\w.]*", fmt):
        raise ValueError(f"not a format name: {fmt!r}")
    spark = df.sparkSession
    ensure_database(spark, database, location)
    name = f"{database}.{table}"
    # the new table is made first: a failing query leaves the old one as it was
    fresh = f"{name}__new_{uuid.uuid4().hex}"
    at, args = ("", {"t": fresh}) if path is None else ("location :path", {"t": fresh, "path": path})
    try:
        spark.sql(
            f"create table identifier(:t) using {fmt} {at} as select * from {{rows}}", args=args, rows=df
        )
    except BaseException:
        spark.sql("drop table if exists identifier(:t)", args={"t": fresh})
        raise
    return _take_the_place(spark, fresh, name)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    if location:
        spark.sql(
            "create database if not exists identifier(:db) location :location",
            args={"db": database, "location": location},
        )
    else:
        spark.sql("create database if not exists identifier(:db)", args={"db": database})


def _take_the_place(spark: SparkSession, fresh: str, name: str) -> DataFrame:
    def quoted(full):
        return ".".join("`" + part.replace("`", "``") + "`" for part in full.split("."))

    spark.sql("drop table if exists identifier(:t)", args={"t": name})
    spark.sql(f"alter table {quoted(fresh)} rename to {quoted(name)}")
    return spark.table(name)


def create_bucketed_table(
    df: DataFrame,
    database: str,
    table: str,
    bucket_by: Sequence[str],
    buckets: int,
    sort_by: Sequence[str] = (),
    location: str | None = None,
) -> DataFrame:
    """A managed table whose rows are stored by a hash of ``bucket_by``, sorted inside.

    Tables with the same keys and number of buckets join, and group by the keys, without an
    exchange: the shuffle is paid once, here. Rows are brought together by the same hash first, so each
    bucket is one file, not one per task. A key that holds a third of the rows is one
    bucket and stays so: bucket by a key of many values, and choose ``buckets`` so that one holds
    some hundred MB. The older table stays until the new one is written.
    """
    spark = df.sparkSession
    ensure_database(spark, database, location)
    name = f"{database}.{table}"
    fresh = f"{name}__new_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *bucket_by).write.format("parquet").bucketBy(buckets, *bucket_by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    try:
        writer.saveAsTable(fresh)
    except BaseException:
        spark.sql("drop table if exists identifier(:t)", args={"t": fresh})
        raise
    return _take_the_place(spark, fresh, name)


def insert_overwrite(df: DataFrame, name: str) -> DataFrame:
    """Replace the rows of an existing table; columns are matched by name, not position."""
    spark = df.sparkSession
    spark.sql(
        "insert overwrite table identifier(:t) by name select * from {rows}",
        args={"t": name},
        rows=df,
    )
    return spark.table(name)
