"""Landing of new and changed files only, with a ledger of what has been landed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.session import materialize
from loanloom.sources.files import Folders, beside

LEDGER = "source_file string, size bigint, changed timestamp, landing bigint"
#: What the manifest reports, under the names of the ledger.
_VERSION = ("source_file", "size", "changed")


def file_versions(spark: SparkSession, folder: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Path, address, size and change time of every file; no file is opened.

    ``source_file`` is the name that rows read from the file carry in ``_metadata.file_path``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select(
        "path",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("changed"),
    )


def _committed(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in Folders(spark, table).children(f"{table}/ledger"))


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """Every file version that was ever landed, and in which landing."""
    if not _committed(spark, table):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{table}/ledger")


def current_versions(spark: SparkSession, table: str) -> DataFrame:
    """The last landed version of each file."""
    rows = ledger(spark, table)
    last = F.max_by(F.struct("size", "changed"), "landing")
    return rows.groupBy("source_file").agg(F.max("landing").alias("landing"), last.alias("v")).select(
        "source_file", "v.size", "v.changed", "landing"
    )


def pending(
    spark: SparkSession, folder: str, table: str, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """Files of ``folder`` that the ledger does not know in their present version."""
    found = file_versions(spark, folder, glob, recursive)
    return found.join(current_versions(spark, table), list(_VERSION), "left_anti")


def land_new(
    spark: SparkSession,
    folder: str,
    table: str,
    read: Callable[[list[str]], DataFrame],
    glob: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """Land the files that are new or have changed; returns their ledger rows.

    ``read`` gets their paths and returns their rows from a file source; every row is stored with
    ``source_file``. The rows go to ``<table>/rows/landing=n`` first; then the ledger entry of the
    landing appears by one rename. That rename is the commit: rows without a ledger entry
    are never read, and the next landing replaces them. So a landing that stops anywhere is
    repeated whole, and no row is there twice. A file whose size or change time differs is landed
    again, and its older rows are no longer read. Rows of a file that is gone stay.

    One writer at a time. The listing is joined with the ledger on the cluster; the driver gets the paths
    of the pending files, which a scan of them would hold as well.
    """
    files = Folders(spark, table)
    done = _committed(spark, table)
    number = done[-1] + 1 if done else 1
    wanted = materialize(pending(spark, folder, table, glob, recursive), "pending")
    paths = [r.path for r in wanted.select("path").collect()]
    entry = wanted.select(*_VERSION, F.lit(number).cast("long").alias("landing"))
    if not paths:
        return entry
    rows = read(paths)
    if "source_file" in rows.columns:
        raise ValueError("the rows already have a column source_file")
    rows = rows.select("*", F.col("_metadata.file_path").alias("source_file"))
    rows.write.mode("overwrite").parquet(f"{table}/rows/landing={number}")
    target = f"{table}/ledger/landing={number}"
    staged = beside(target, "entry")
    entry.drop("landing").write.parquet(staged)
    files.move(staged, target)
    return entry


def landed_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all committed landings, each file in its last version.

    Adds ``source_file`` and ``landing``. Only the outdated versions are joined, to be left out; where
    no file ever changed that side is empty.
    """
    done = _committed(spark, table)
    if not done:
        raise ValueError(f"nothing has been landed in {table}")
    # Schemas of later landings may have grown; only committed folders are named
    rows = spark.read.option("mergeSchema", True).option("basePath", f"{table}/rows").parquet(
        *[f"{table}/rows/landing={n}" for n in done]
    ).withColumn("landing", F.col("landing").cast("long"))
    now = current_versions(spark, table).select("source_file", F.col("landing").alias("now"))
    outdated = ledger(spark, table).join(now, "source_file").where("landing < now").select("source_file", "landing")
    return rows.join(outdated, ["source_file", "landing"], "left_anti")
