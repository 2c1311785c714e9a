"""Which files a dataset consists of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """Path, name, size and change time of every file; file contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("size"),
        "modificationTime",
    )
