"""Writes that keep violating rows aside instead of stopping."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanloom.sources.files import Folders, beside
from loanloom.sources.tables import enforce_schema

#: The partition of the rows that violate nothing.
GOOD = "none"


def violations(schema: StructType, rules: Mapping[str, str | Column] | None = None) -> Column:
    """What is wrong with a row: names of the rules it breaks, joined; ``none`` if nothing is.

    A null in a column declared non-null breaks ``<column> is null``. A rule is broken when its
    condition is false or unknown.
    """
    found = [F.when(F.col(f.name).isNull(), F.lit(f"{f.name} is null")) for f in schema if not f.nullable]
    for name, rule in (rules or {}).items():
        condition = F.expr(rule) if isinstance(rule, str) else rule
        found.append(F.when(~F.coalesce(condition, F.lit(False)), F.lit(name)))
    return F.coalesce(F.nullif(F.concat_ws("; ", *found), F.lit("")), F.lit(GOOD))


def all_nullable(schema: StructType) -> StructType:
    out = StructType.fromJson(schema.jsonValue())
    for field in out:
        field.nullable = True
    return out


def write_or_quarantine(
    df: DataFrame,
    path: str,
    quarantine: str,
    schema: StructType,
    rules: Mapping[str, str | Column] | None = None,
    batch: str | None = None,
) -> dict[str, int]:
    """Replace the table at ``path`` by the rows that keep to ``schema`` and ``rules``.

    The other rows go, whole, to the table at ``quarantine``, which has the partition columns
    ``batch`` and ``violation``; those of a batch named before replace it. Returns how many rows
    were read, written and put aside, from the footers of the files just written: metrics observed in
    the write left later plans of the session with functions that could not be sent to executors.

    Missing, extra and wrongly typed columns are still an error on the plan, as in
    :func:`enforce_schema`. One scan and one write do it all: rows are written into a folder per
    violation, and the folders are then moved to either table, the quarantine first, so that a stop
    between the moves loses no bad row. There is one folder per combination of broken rules.
    """
    spark, batch = df.sparkSession, batch or uuid.uuid4().hex
    mark = "violation"
    if mark in df.columns or "batch" in df.columns:
        raise ValueError("columns named violation or batch are those of the quarantine")
    nullable = all_nullable(schema)
    rows = enforce_schema(df, nullable).withColumn(mark, violations(schema, rules))
    base, aside = path.rstrip("/"), f"{quarantine.rstrip('/')}/batch={batch}"
    files = Folders(spark, base)
    staged, old = beside(base, "new"), beside(base, "old")
    try:
        rows.write.partitionBy(mark).parquet(staged)
        folders = files.children(staged)
        told = _counts(spark, staged, mark) if folders else {"read": 0, "written": 0, "quarantined": 0}
        good = f"{staged}/{mark}={GOOD}"
        if not files.exists(good):
            spark.createDataFrame([], nullable).write.parquet(good)
        files.delete(aside)
        for folder in folders:
            if folder != f"{mark}={GOOD}":
                files.move(f"{staged}/{folder}", f"{aside}/{folder}")
        replaced = files.exists(base)
        if replaced:
            files.move(base, old)
        try:
            files.move(good, base)
        except OSError:
            if replaced:
                files.move(old, base)
            raise
        files.delete(old)
    finally:
        files.delete(staged)
    spark.catalog.refreshByPath(base)
    return told


def _counts(spark: SparkSession, staged: str, mark: str) -> dict[str, int]:
    """Rows per kind in a written folder: its partition column alone, so only file footers are read."""
    read, written = spark.read.parquet(staged).agg(F.count(F.lit(1)), F.count_if(F.col(mark) == GOOD)).first()
    return {"read": read, "written": written, "quarantined": read - written}


def read_quarantine(spark: SparkSession, quarantine: str, schema: StructType) -> DataFrame:
    """All rows that were put aside, with ``batch`` and ``violation``; empty if there never were any."""
    full = all_nullable(schema).add("batch", "string").add("violation", "string")
    if not Folders(spark, quarantine).children(quarantine):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(quarantine)
