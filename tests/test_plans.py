"""The plans behind the operators: what is read, what is shuffled, what never runs in Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from loanloom import sources
from loanloom.operators import aggregates, evaluation, features
from loanloom.plans import loans as plan
from loanloom.plans.fixture import loans
from loanloom.session import materialize

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def raw(spark):
    return materialize(loans(spark, SF), "raw")


@pytest.fixture(scope="module")
def cleaned(raw):
    return materialize(plan.clean(raw, keep=("loan_id",)), "cleaned")


def test_state_count_reads_two_columns_and_pushes_the_filter(cleaned):
    text = plan_of(plan.collections_by_state(cleaned))
    assert "ReadSchema: struct<addr_state:string,collections_12_mths_ex_med:int>" in text
    assert re.search(r"PushedFilters: \[.*Not\(EqualTo\(collections_12_mths_ex_med,0\)\)", text)
    assert text.count("partial_count(1)") >= 1 and text.count("hashpartitioning(addr_state") >= 1


def test_flagship_reaches_the_scan_through_cleaning(raw):
    text = plan_of(plan.collections_by_state(plan.clean(raw)))
    assert "ReadSchema: struct<addr_state:string,collections_12_mths_ex_med:int>" in text


def test_sql_and_dataframe_forms_have_the_same_plan(cleaned):
    def shape(df):
        return re.sub(r"#\d+L?|id=#\d+|plan_id=\d+", "", plan_of(df))

    assert shape(plan.collections_by_state(cleaned)) == shape(plan.collections_by_state_sql(cleaned))


def test_cleaning_is_one_projection_without_shuffle(raw):
    text = plan_of(plan.clean(raw))
    tree = text[: text.index("(1)")] if "(1)" in text else text
    assert "Exchange" not in text
    assert len(re.findall(r"\bProject \(\d+\)", tree or text)) <= 1


def test_class_ratio_is_one_scan(cleaned):
    rows = plan.features(cleaned)
    tree = plan_of(aggregates.balancing_ratio(rows, "label")).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    tree = plan_of(aggregates.class_share(rows, "label")).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1


def test_weights_use_a_scalar_subquery_not_a_join(cleaned):
    text = plan_of(features.weigh_classes(plan.features(cleaned)))
    assert "Subquery" in text
    assert "Join" not in text and "Cartesian" not in text


def test_partition_filter_prunes_folders(spark, cleaned, folder):
    sources.write_table(
        sources.spread(cleaned, "addr_state"), f"{folder}/p", partition_by=["addr_state"]
    )
    table = sources.read_table(spark, f"{folder}/p", schema=cleaned.schema)
    text = plan_of(table.where(F.col("addr_state") == "NATION_7").select("loan_id"))
    assert re.search(r"PartitionFilters: \[.*addr_state.* = NATION_7", text)
    assert "ReadSchema: struct<loan_id:bigint>" in text


def test_split_is_a_filter_without_shuffle_or_sort(cleaned):
    text = plan_of(plan.train_test(plan.features(cleaned))[0])
    assert "Exchange" not in text and "Sort" not in text


def test_auroc_has_no_join_and_one_scan(cleaned):
    scores = plan.features(cleaned).select(F.col("loan_amnt").cast("double").alias("score"), "label")
    text = plan_of(evaluation.area_under_roc(scores))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "Join" not in text
    # scores are shuffled once to meet and once to their range, which a sketch has cut; only the
    # totals per range and the sketches go to a single task
    assert text.count("Arguments: hashpartitioning") == 2 and "rangepartitioning" not in text
    assert text.count("Arguments: SinglePartition") == 2


def test_auroc_takes_borders_from_sketches_per_task(cleaned):
    scores = plan.features(cleaned).select(F.col("loan_amnt").cast("double").alias("score"), "label")
    tree, _, subqueries = plan_of(evaluation.area_under_roc(scores)).partition("===== Subqueries =====")
    assert "approx_percentile" in subqueries and "hashpartitioning" not in subqueries
    assert tree.count("Window") and "approx_percentile" not in tree.split("Scan parquet")[0]


def test_enforcement_is_in_the_same_scan(cleaned):
    schema = cleaned.sparkSession.createDataFrame([], cleaned.schema).schema
    schema["loan_id"].nullable = False
    text = plan_of(sources.enforce_schema(cleaned, schema))
    assert text.split("\n\n")[0].count("Scan parquet") == 1 and "Exchange" not in text


def test_manifest_never_reads_contents(spark):
    text = plan_of(sources.manifest(spark, SF, glob="*.parquet"))
    assert "content" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_zipped_csv_parses_each_line_once(spark, folder):
    from loanloom.plans.fixture import pack_csv_archives

    df = spark.range(5).select("id", F.lit("a").alias("t"))
    pack_csv_archives(df, folder)
    read = sources.read_zipped_csv(spark, folder, df.schema)
    optimized = read._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_csv") == 1


@pytest.mark.parametrize(
    "name",
    ["etl_clean", "loans_by_state", "class_weights", "hash_split", "auroc_exact",
     "precision_by_label", "collections_text_filter", "feature_vectors"],
)
def test_no_python_in_hot_paths(spark, name):
    import __spark_entry__ as entry

    text = plan_of(entry.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text
