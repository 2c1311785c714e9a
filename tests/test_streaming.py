from __future__ import annotations

import shutil

from pyspark.sql import functions as F

from loanloom import sources
from loanloom.plans import loans as plan
from loanloom.plans.fixture import loans
from loanloom.streaming.arrivals import append_to_table, csv_arrivals

SF = "/root/testdata/sf0.001"


def test_files_that_arrive_later_are_added_once(spark, folder):
    raw = loans(spark, SF)
    sources.write_csv(raw.where("loan_id < 600").coalesce(2), f"{folder}/a")
    sources.write_csv(raw.where("loan_id >= 600").coalesce(2), f"{folder}/b")

    def run():
        arrivals = csv_arrivals(spark, f"{folder}/in", raw.schema, max_files=1)
        query = append_to_table(
            arrivals, lambda df: plan.clean(df, ("loan_id",)), f"{folder}/out", f"{folder}/progress"
        )
        query.awaitTermination()
        return sources.read_table(spark, f"{folder}/out")

    shutil.copytree(f"{folder}/a", f"{folder}/in")
    assert run().count() == raw.where("loan_id < 600").count()
    assert run().count() == raw.where("loan_id < 600").count()
    shutil.copytree(f"{folder}/b", f"{folder}/in", dirs_exist_ok=True)
    out = run()
    want = plan.clean(raw, ("loan_id",)).select(*out.columns)
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    assert out.where(F.col("newTerm").isNotNull()).count() > 0
