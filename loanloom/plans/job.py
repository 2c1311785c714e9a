"""The whole loan flow as one job: CSV to table, counts, two classifiers.

``spark-submit loanloom/plans/job.py --csv PATH --base PATH`` does what an analyst would do
step by step; :func:`run` is the same for callers that have a session.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanloom.operators.aggregates import class_share, row_count
from loanloom.operators.evaluation import area_under_roc, precision_by_label, score_rows
from loanloom.operators.models import save_model
from loanloom.plans import loans as plan
from loanloom.session import home_folder, materialize
from loanloom.sources import read_csv, read_table, write_table


@dataclass
class LoanReport:
    """What the flow leaves behind: paths, models, and its result tables, stored under ``home``."""

    table_path: str
    tree_path: str
    tree: Model
    logistic: Model
    counts: DataFrame
    collections_by_state: DataFrame
    positive_percent: DataFrame
    tree_predictions: DataFrame
    logistic_predictions: DataFrame
    training_precision: DataFrame
    area_under_roc: DataFrame
    unreadable: DataFrame


CORRUPT = "_corrupt_record"


def run(
    spark: SparkSession, csv: str, home: str, schema: StructType | None = None, fmt: str = "parquet"
) -> LoanReport:
    """Run the flow on ``csv``; tables, results and models go under ``home``.

    Without ``schema`` it is inferred first. CSV lines that do not fit the schema are stored whole in ``corrupt_lines``, and
    ``unreadable`` counts them and the texts without a number in the unit columns. Both
    stay out of the loan table and of the results.
    """
    schema = schema or read_csv(spark, csv).schema  # inferred once
    raw = materialize(read_csv(spark, csv, schema=schema, corrupt_column=CORRUPT), "csv")
    bad = raw.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    raw = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    keep = tuple(c for c in ("loan_id",) if c in raw.columns)
    table_path, tree_path = f"{home}loans", f"{home}tree"
    write_table(plan.clean(raw, keep), table_path, fmt=fmt)

    def stored(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{home}{name}", fmt=fmt)
        return read_table(spark, f"{home}{name}", fmt=fmt, schema=df.schema)

    corrupt = stored("corrupt_lines", bad)
    lines = row_count(corrupt, "rows").select(F.lit("corrupt lines").alias("what"), "rows")
    unreadable = stored(
        "unreadable", lines.union(plan.unreadable_units(raw).select("column_name", "failed_rows"))
    )
    loans = read_table(spark, table_path, fmt=fmt)
    rows = materialize(plan.features(loans, keep), "features")
    tree, tree_predictions = plan.fit_tree(rows)
    save_model(tree, tree_path)
    logistic, _, test = plan.fit_logistic(rows)
    save_model(logistic, f"{home}logistic")
    training = score_rows(logistic.summary.predictions, "label", "classWeight")
    named = [c for c in ("loan_id",) if c in rows.columns]
    scored = stored(
        "logistic_predictions", score_rows(logistic.transform(test), *named, "label", "classWeight")
    )
    return LoanReport(
        table_path=table_path,
        tree_path=tree_path,
        tree=tree,
        logistic=logistic,
        counts=stored("counts", row_count(loans, "loans").select(
            "loans", row_count(plan.with_collections(loans)).scalar().alias("with_collections")
        )),
        collections_by_state=stored("collections_by_state", plan.collections_by_state(loans)),
        positive_percent=stored("positive_percent", class_share(rows, "label")),
        tree_predictions=stored("tree_predictions", score_rows(tree_predictions, *named, "label")),
        logistic_predictions=scored,
        training_precision=stored("training_precision", precision_by_label(training, weight="classWeight")),
        area_under_roc=stored("area_under_roc", area_under_roc(scored)),
        unreadable=unreadable,
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--csv", required=True, help="CSV file or folder")
    parser.add_argument("--base", required=True, help="folder above the user's own folder")
    parser.add_argument("--schema", help="column list such as 'loan_amnt int, term string'")
    parser.add_argument("--format", default="parquet", help="table format")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("loans").getOrCreate()
    schema = StructType.fromDDL(options.schema) if options.schema else None
    report = run(
        spark, options.csv, home_folder(spark, options.base), schema=schema, fmt=options.format
    )
    for name in (
        "counts", "collections_by_state", "positive_percent", "training_precision", "area_under_roc", "unreadable"
    ):
        table = getattr(report, name)
        print(name, *table.columns, sep="\t")
        for row in table.toLocalIterator():
            print("", *row, sep="\t")


if __name__ == "__main__":
    main()
