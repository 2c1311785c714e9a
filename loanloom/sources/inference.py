"""Which types the texts of a table would bear, with what stands against a better one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From narrow to wide. A type holds all values of an earlier one in its own branch.
TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean", "string")
BRANCHES = {
    "number": ("int", "bigint", "double"), "time": ("date", "timestamp"), "boolean": ("boolean",), "string": ("string",)
}


def narrowest(value: Column) -> Column:
    """The narrowest of :data:`TYPES` that a text can be read as; null for null and blank texts."""
    text = F.trim(value)
    number = text.rlike(r"^[+-]?[0-9]+$")
    day = text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    moment = text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]")
    return (
        F.when(value.isNull() | (text == ""), F.lit(None).cast("string"))
        .when(number & text.try_cast("int").isNotNull(), "int")
        .when(number & text.try_cast("bigint").isNotNull(), "bigint")
        .when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), "double")
        .when(day & text.try_cast("date").isNotNull(), "date")
        .when(moment & text.try_cast("timestamp").isNotNull(), "timestamp")
        .when(F.lower(text).isin("true", "false"), "boolean")
        .otherwise("string")
    )


def inferred_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per text column: the type that holds all its values, and the type of most of them.

    Returns ``column_name``, ``inferred`` (the narrowest type of all values: numbers join to the
    widest number, dates and times to timestamp, anything else to text; null without values),
    ``likely`` (the join of the branch that most values belong to), ``values``, ``misfits`` (values outside of that
    branch) and ``first_misfit`` (the first of them in reading order). Where ``inferred`` is string and
    ``likely`` is not, a few stray texts would have made the column text.

    One pass over the table, without sampling: the cells are counted by column and type, combined before the
    shuffle, with the first text of each type; what follows has a row per column and type.
    """
    columns = list(columns or [f.name for f in df.schema if f.dataType.simpleString() == "string"])
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column_name string, inferred string, likely string, values long, misfits long, first_misfit string"
        )
    spark = df.sparkSession
    cells = df.select(
        F.monotonically_increasing_id().alias("place"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])).alias("cell"),
    ).select("place", "cell.c", "cell.v")
    kinds = cells.withColumn("t", narrowest(F.col("v"))).where("t is not null").groupBy("c", "t").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("place", "v")).alias("first")
    )
    # from here on there are as many rows as columns times types
    branch = F.coalesce(*[F.when(F.col("t").isin(*ts), F.lit(b)) for b, ts in BRANCHES.items()])
    rank = F.array_position(F.array(*map(F.lit, TYPES)), F.col("t"))
    per_branch = kinds.withColumns({"branch": branch, "rank": rank}).groupBy("c", "branch").agg(
        F.sum("n").alias("n"), F.max_by("t", "rank").alias("widest"), F.min("first").alias("first")
    )
    # text wins no tie: a typed branch as large is named first
    order = F.array_position(F.array(*map(F.lit, BRANCHES)), F.col("branch"))
    reports = per_branch.groupBy("c").agg(
        F.collect_list(F.struct((-F.col("n")).alias("minus"), order.alias("o"), "widest", "first")).alias("bs")
    ).withColumn("bs", F.array_sort("bs"))
    others = F.slice("bs", 2, len(BRANCHES))
    named = spark.createDataFrame([(c,) for c in columns], "column_name string")
    return named.join(
        reports.select(
            F.col("c").alias("column_name"),
            F.when(F.size("bs") == 1, F.col("bs")[0]["widest"]).otherwise("string").alias("inferred"),
            F.col("bs")[0]["widest"].alias("likely"),
            F.aggregate("bs", F.lit(0).cast("long"), lambda s, b: s - b["minus"]).alias("values"),
            F.aggregate(others, F.lit(0).cast("long"), lambda s, b: s - b["minus"]).alias("misfits"),
            F.array_min(F.transform(others, lambda b: b["first"]))["v"].alias("first_misfit"),
        ),
        "column_name", "left",
    ).na.fill(0, ["values", "misfits"])
