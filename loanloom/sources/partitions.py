"""Replacing single partitions of a folder table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.sources.files import Folders

_NULL = "__HIVE_DEFAULT_PARTITION__"


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders ``a=1/b=2`` of a partitioned table, relative to it, from listings alone."""
    files, level = Folders(spark, path), [""]
    for _ in range(depth):
        level = [f"{p}/{c}".lstrip("/") for p in level for c in files.children(f"{path}/{p}".rstrip("/")) if "=" in c]
    return level


def partition_values(folder: str) -> tuple[str | None, ...]:
    """The values in a partition folder's name, as text; null for the default partition."""
    values = [unquote(part.split("=", 1)[1]) for part in folder.split("/")]
    return tuple(None if v == _NULL else v for v in values)


def _matching(df: DataFrame, folders: list[str], by: Sequence[str], condition: str) -> list[str]:
    """Those of ``folders`` whose values, in the types of ``df``, meet the condition."""
    if not folders:
        return []
    spark = df.sparkSession
    text = spark.createDataFrame(
        [(f, *partition_values(f)) for f in folders], ", ".join(["folder string", *[f"`{c}` string" for c in by]])
    )
    typed = text.select("folder", *[F.col(c).cast(df.schema[c].dataType).alias(c) for c in by])
    return [r.folder for r in typed.where(condition).collect()]


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    condition: str | None = None,
    fmt: str = "parquet",
) -> list[str]:
    """Replace partitions of the table at ``path`` by the rows of ``df``; returns their folders.

    Without ``condition`` the partitions that ``df`` has rows for are replaced. With one, SQL
    over the partition columns, all partitions that meet it are: those without new rows become
    empty, and a row outside of it stops the job before anything is changed. No other
    partition is touched, its files keep their names.

    The new rows are written beside the table and moved in folder by folder, one rename out and one
    in; if a move fails, all are undone. A plan may read the partitions that it replaces. If the driver is lost between
    the moves, the older folders are in ``<path>/_replaced-.../old``. A reader at that time may see
    some partitions old and some new.
    """
    spark, by, base = df.sparkSession, list(partition_by), path.rstrip("/")
    files = Folders(spark, base)
    area = f"{base}/_replaced-{uuid.uuid4().hex}"
    if condition is not None:
        inside = F.coalesce(F.expr(condition), F.lit(False))
        first = df.schema[by[0]].dataType
        wrong = F.raise_error(F.concat(F.lit(f"row outside of {condition}: "), F.to_json(F.struct(*by)))).cast(first)
        df = df.withColumn(by[0], F.when(inside, F.col(by[0])).otherwise(wrong))
    moved: list[tuple[str, str]] = []
    try:
        df.write.format(fmt).partitionBy(*by).save(f"{area}/new")
        new = partition_folders(spark, f"{area}/new", len(by))
        old = partition_folders(spark, base, len(by))
        gone = [f for f in old if f in set(new)] if condition is None else _matching(df, old, by, condition)
        for folder in sorted({*new, *gone}):
            if folder in gone:
                files.move(f"{base}/{folder}", f"{area}/old/{folder}")
                moved.append((f"{area}/old/{folder}", f"{base}/{folder}"))
            if folder in new:
                files.move(f"{area}/new/{folder}", f"{base}/{folder}")
                moved.append((f"{base}/{folder}", f"{area}/new/{folder}"))
    except BaseException:
        for now, before in reversed(moved):
            files.move(now, before)
        files.delete(area)
        raise
    files.delete(area)
    spark.catalog.refreshByPath(base)
    return sorted({*new, *gone})
