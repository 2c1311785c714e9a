from __future__ import annotations

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from loanloom import sources
from loanloom.operators.models import load_model
from loanloom.plans import job
from loanloom.plans import loans as plan
from loanloom.plans.fixture import loans

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("keyed", [True, False])
def test_whole_flow(spark, folder, keyed):
    raw = loans(spark, SF)
    raw = raw if keyed else raw.drop("loan_id")
    sources.write_csv(raw, f"{folder}/csv")
    report = job.run(spark, f"{folder}/csv", f"{folder}/home/")
    assert tuple(report.counts.first()) == (15_000, 216)
    assert report.collections_by_state.count() == 25
    assert report.positive_percent.first()[0] == pytest.approx(1.4236, abs=1e-4)
    assert report.area_under_roc.first()[0] > 0.8
    precision = {r.prediction: r.precision for r in report.training_precision.collect()}
    assert precision[1] > 0.6
    stored = sources.read_table(spark, report.table_path)
    assert set(stored.columns) == set(plan.clean(raw).columns) | ({"loan_id"} if keyed else set())
    loaded = load_model("tree", report.tree_path)
    assert loaded.toDebugString.split("\n")[1:] == report.tree.toDebugString.split("\n")[1:]


def test_job_stores_results_and_counts_what_it_cannot_read(spark, folder):
    # more than 60 groups, a broken line, a rate without a number
    raw = loans(spark, SF).withColumn("addr_state", F.concat("addr_state", F.lit("/"), F.col("loan_id") % 40))
    sources.write_csv(raw.coalesce(1), f"{folder}/csv")
    with open(f"{folder}/csv/extra.csv", "w") as f:
        f.write(",".join(raw.columns) + "\nnot a number,x,y\n")
    report = job.run(spark, f"{folder}/csv", f"{folder}/home/", schema=raw.schema)
    found = {r.what: r.rows for r in report.unreadable.collect()}
    assert found["corrupt lines"] == 1 and found["newTerm"] > 0
    by_state = sources.read_table(spark, f"{folder}/home/collections_by_state")
    assert by_state.count() > 60 and by_state.agg(F.sum("count")).first()[0] == 216
    assert sources.read_table(spark, f"{folder}/home/corrupt_lines").count() == 1
    for name in ("counts", "training_precision", "area_under_roc", "tree_predictions", "logistic_predictions"):
        assert sources.read_table(spark, f"{folder}/home/{name}").count() > 0


def test_job_counts_corrupt_lines_without_a_schema(spark, folder):
    raw = loans(spark, SF)
    sources.write_csv(raw.coalesce(1), f"{folder}/csv")
    with open(f"{folder}/csv/extra.csv", "w") as f:
        f.write(",".join(raw.columns) + "\n1\n")  # too few fields
    report = job.run(spark, f"{folder}/csv", f"{folder}/home/")
    found = {r.what: r.rows for r in report.unreadable.collect()}
    assert found["corrupt lines"] == 1 and report.counts.first().loans == 15_000
    assert sources.read_table(spark, f"{folder}/home/corrupt_lines").count() == 1


def test_job_has_a_command_line():
    done = subprocess.run(
        [sys.executable, "-m", "loanloom.plans.job", "--help"], capture_output=True, text=True,
        cwd=job.__file__.rsplit("/loanloom/", 1)[0], timeout=60,
    )
    assert done.returncode == 0 and "--csv" in done.stdout
