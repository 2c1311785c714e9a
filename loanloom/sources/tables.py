"""Tables kept as a folder of files, Parquet unless another format is named."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Scan a path table.

    For a partitioned table pass the schema it was written with: Spark otherwise infers
    the type of the partition column from folder names (``'01'`` becomes 1). Null and
    empty text share one folder and both read back as null.
    """
    reader = spark.read.format(fmt)
    if schema is None:
        return reader.load(path)
    return reader.schema(schema).load(path).select(*schema.names)


def table_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """SQL form of :func:`read_table`."""
    if not re.fullmatch(r"[A-Za-z][\w.]*", fmt):
        raise ValueError(f"not a format name: {fmt!r}")
    spark.sql(
        f"create or replace temporary view identifier(:name) using {fmt} options (path :path)",
        args={"name": name, "path": path},
    )
    return spark.table(name)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 0,
) -> None:
    """Replace, append to, or create a path table.

    A folder of files is replaced by writing the new rows beside it, then swapping the two
    by renames. So a plan may read the table it replaces, and after a failed write the old
    table is still there. A stop between the two renames leaves the old rows in the folder
    ``<path>__old-...``. Transactional formats, and the dynamic overwrite of single
    partitions, replace by their own means.
    """
    spark = df.sparkSession
    dynamic = partition_by and spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    staged = mode == "overwrite" and fmt in {"parquet", "orc", "csv", "json", "text"} and not dynamic
    base = path.rstrip("/")
    target = f"{base}__new-{uuid.uuid4().hex}" if staged else path
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if not staged:
        writer.save(target)
        return
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(target).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer.save(target)
        old = folder(f"{base}__old-{uuid.uuid4().hex}")
        replaced = files.exists(folder(base))
        if replaced and not files.rename(folder(base), old):
            raise OSError(f"{path} cannot be moved aside")
        if not files.rename(folder(target), folder(base)):
            if replaced:
                files.rename(old, folder(base))
            raise OSError(f"the new rows cannot be moved to {path}")
    except BaseException:
        files.delete(folder(target), True)
        raise
    if replaced:
        files.delete(old, True)
    spark.catalog.refreshByPath(base)


def spread(df: DataFrame, *columns: str, parts: int | None = None, salt: int = 1) -> DataFrame:
    """Bring rows of equal ``columns`` together before a partitioned write.

    By default this asks for a rebalance: rows are hashed on the columns, then adaptive
    execution merges small pieces and splits oversized ones, so a key with a third of all
    rows becomes many files of advisory size, not one endless task. With ``parts`` it is a
    plain hash repartition; ``salt`` then divides every key over that many pieces.
    """
    if parts is None and salt == 1:
        return df.hint("rebalance", *columns)
    keys = [F.col(c) for c in columns]
    if salt > 1:
        keys.append(F.pmod(F.xxhash64(*df.columns), F.lit(salt)))
    return df.repartition(parts, *keys) if parts else df.repartition(*keys)


def required_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null per required column, in one pass that reads only these columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def enforce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order, or an error.

    Missing, extra and wrongly typed columns are found on the plan, before any row is
    read. A null in a column declared non-null stops the job at that row: the guard is
    part of the same scan, so the write needs no second pass.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    problems = [f"missing column {n}" for n in wanted if n not in found]
    problems += [f"unexpected column {n}" for n in found if n not in wanted]
    problems += [
        f"column {n} is {found[n].simpleString()}, expected {t.simpleString()}"
        for n, t in wanted.items()
        if n in found and found[n] != t
    ]
    if problems:
        raise ValueError("; ".join(problems))
    return df.select(
        *[
            F.col(f.name)
            if f.nullable
            else F.when(
                F.col(f.name).isNull(), F.raise_error(F.lit(f"null in required column {f.name}"))
            )
            .otherwise(F.col(f.name))
            .alias(f.name)
            for f in schema.fields
        ]
    )


def write_enforced(
    df: DataFrame,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    **options,
) -> None:
    """Write only if every row meets ``schema``.

    The guard is part of the write job itself: a failed job commits no file, and a table
    that was to be replaced stays as it was.
    """
    write_table(enforce_schema(df, schema), path, fmt=fmt, mode=mode, **options)
