"""A loan-shaped table derived from the star-schema tables, for tests and benchmarks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per order, borrower data from customer and nation.

    Whether customer or nation is broadcast is left to Spark, which knows their size;
    a customer with very many orders is split by the adaptive skew join.
    """
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    cust, balance = F.col("c_custkey"), F.col("c_acctbal")

    def text(column):
        return column.cast("string")

    term = (
        F.when(key % 97 == 0, F.lit(None))
        .when(key % 101 == 0, "months")
        .when(key % 3 == 0, " 60 months")
        .otherwise(" 36 months")
    )
    int_rate = F.when(
        key % 89 != 0,
        F.concat(
            text(5 + F.col("o_custkey") % 20), F.lit("."), F.lpad(text(key % 100), 2, "0"), F.lit("%")
        ),
    )
    grade_no = F.substring("o_orderpriority", 1, 1).try_cast("int")
    emp_length = (
        F.when(key % 11 == 0, "n/a")
        .when(key % 11 == 10, "10+ years")
        .otherwise(F.concat(text(key % 11), F.lit(" years")))
    )
    revol_util = F.when(
        key % 71 != 0, F.concat(text(cust % 100), F.lit("."), text(key % 10), F.lit("%"))
    )
    collections = (
        F.when(key % 997 == 0, F.lit(None))
        .when((price > 350000) & (key % 19 == 0), 1 + key % 3)
        .otherwise(0)
    )
    rows = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == cust)
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        key.alias("loan_id"),
        F.floor(price / 12.0).cast("int").alias("loan_amnt"),
        term.alias("term"),
        int_rate.alias("int_rate"),
        (price / 432.0).alias("installment"),
        F.substr(F.lit("ABCDE"), grade_no, F.lit(1)).alias("grade"),
        emp_length.alias("emp_length"),
        (balance * 10.0).alias("annual_inc"),
        F.col("n_name").alias("addr_state"),
        F.when(key % 53 != 0, (cust % 400) / 10.0).alias("dti"),
        (key % 4).cast("int").alias("delinq_2yrs"),
        (cust % 6).cast("int").alias("inq_last_6mths"),
        F.when(key % 2 != 0, (key % 80).cast("int")).alias("mths_since_last_delinq"),
        F.floor(F.abs(balance)).cast("int").alias("revol_bal"),
        revol_util.alias("revol_util"),
        (price / 24.0).alias("out_prncp"),
        (price / 20.0).alias("total_pymnt"),
        (price / 30.0).alias("total_rec_prncp"),
        (price / 60.0).alias("total_rec_int"),
        collections.cast("int").alias("collections_12_mths_ex_med"),
    )


def pack_csv_archives(df: DataFrame, folder: str, sep: str = ",") -> None:
    """Write ``df`` as zipped CSV, one archive per task, for the landing query and its tests.

    Every task writes under its own attempt name and renames at the end, so a repeated
    task replaces its archive and never adds a second one.
    """
    folder = re.sub(r"^file:/+", "/", folder)
    header = sep.join(df.columns)
    line = F.to_csv(
        F.struct(*df.columns),
        {"sep": sep, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"},
    )

    def pack(batches):
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        name = f"{base}/part-{task.partitionId():05d}.zip"
        attempt = f"{base}/_part-{task.partitionId():05d}-{task.taskAttemptId()}"
        rows = 0
        with where.open_output_stream(attempt) as out, zipfile.ZipFile(
            out, "w", zipfile.ZIP_DEFLATED
        ) as z, z.open("loans.csv", "w", force_zip64=True) as raw, io.TextIOWrapper(
            raw, "utf-8", newline="\n"
        ) as text:
            text.write(header + "\n")
            for batch in batches:
                lines = batch["line"].to_pylist()
                text.write("".join(f"{line}\n" for line in lines))
                rows += len(lines)
        where.move(attempt, name)
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64())})

    packed = df.select(line.alias("line")).mapInArrow(pack, "rows bigint")
    packed.agg(F.sum("rows")).first()
