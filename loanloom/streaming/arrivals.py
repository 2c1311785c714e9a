"""Clean CSV files as they arrive, with the same operators as the batch flow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def csv_arrivals(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    max_files: int | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Stream of the CSV files in a folder; a stream never infers its schema.

    With ``corrupt_column`` the raw line of a row that does not fit is kept there.
    """
    if corrupt_column:
        schema = StructType([*schema.fields]).add(corrupt_column, "string")
    reader = spark.readStream.schema(schema).options(header=header, sep=sep)
    if corrupt_column:
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt_column)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def append_to_table(
    arrivals: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Process everything that has arrived, then stop; the next run picks up what is new.

    Row-wise cleaning needs no state and no shuffle. The checkpoint and the sink's commit
    log make a repeated or interrupted run write every file's rows exactly once.
    """
    return (
        arrivals.transform(transform)
        .writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
