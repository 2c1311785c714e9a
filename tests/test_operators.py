from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loanloom.operators import aggregates, features, filters, inspection, models
from loanloom.plans import loans as plan
from loanloom.plans.fixture import loans
from loanloom.plans.statements import register, run_sql
from loanloom.session import home_folder, materialize, scratch_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def states(spark):
    return spark.createDataFrame(
        [(None, 1), ("", 0), ("CA", 2), ("CA", 0), ("CA", 1), ("NY", None)],
        "addr_state string, collections int",
    )


@pytest.fixture(scope="module")
def loan_rows(spark):
    return materialize(plan.clean(loans(spark, SF), keep=("loan_id",)), "loan-rows")


@pytest.fixture(scope="module")
def feature_rows(loan_rows):
    return materialize(plan.features(loan_rows), "feature-rows")


# --- filters ---


def test_not_equal_drops_null(states):
    assert filters.where_not_equal(states, "collections", 0).count() == 3


def test_equal(states):
    assert filters.where_equal(states, "collections", 0).count() == 2
    assert filters.where_equal(states, "addr_state", "CA").count() == 3


def test_number_against_text_column(spark):
    df = spark.createDataFrame([("0",), ("2",), ("x",), (None,), ("1.5",)], "c string")
    assert [r.c for r in filters.where_not_equal(df, "c", 0).collect()] == ["2", "1.5"]
    assert [r.c for r in filters.where_not_equal(df, "c", 0.0).collect()] == ["2", "1.5"]
    assert [r.c for r in filters.where_equal(df, "c", "x").collect()] == ["x"]


# --- aggregates ---


def test_group_count_has_null_and_empty_groups(states):
    got = {r.addr_state: r["count"] for r in aggregates.group_count(states, "addr_state").collect()}
    assert got == {None: 1, "": 1, "CA": 3, "NY": 1}


def test_aggregates_of_an_empty_table(states):
    empty = states.limit(0)
    assert aggregates.row_count(empty).first()[0] == 0
    assert aggregates.group_count(empty, "addr_state").collect() == []
    assert aggregates.class_share(empty, "collections").first()[0] is None
    assert aggregates.balancing_ratio(empty, "collections").first()[0] is None


def test_class_share_and_ratio(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    assert aggregates.class_share(df, "label").first()[0] == 25.0
    assert aggregates.balancing_ratio(df, "label").first()[0] == 0.25


# --- inspection ---


def test_describe_and_column_kinds(spark, states):
    register(states, "states_view")
    got = [(r.col_name, r.data_type) for r in inspection.describe(spark, "states_view").collect()]
    assert got == [("addr_state", "string"), ("collections", "int")]
    assert inspection.numeric_columns(states) == ["collections"]
    assert inspection.non_numeric_columns(states) == ["addr_state"]


def test_preview_and_first_value(spark, states):
    assert inspection.preview(states, 4).count() == 4
    assert inspection.first_value(spark.range(5, 8), "id") == 5
    assert inspection.first_value(states.limit(0), "addr_state") is None
    user = run_sql(spark, "select current_user() as user")
    assert inspection.first_value(user, "user")


# --- SQL ---


def test_sql_values_are_never_pasted(spark, states):
    bad = "x' or '1' = '1"
    got = run_sql(spark, "select * from {s} where addr_state = :v", {"v": bad}, s=states)
    assert got.count() == 0


def test_sql_takes_one_statement(spark):
    with pytest.raises(AnalysisException):
        run_sql(spark, "select 1; select 2")


def test_sql_and_dataframe_forms_agree(spark, loan_rows):
    raw = loans(spark, SF)
    sql = plan.clean_sql(raw, keep=("loan_id",)).select(*loan_rows.columns)
    assert sql.exceptAll(loan_rows).count() == 0 and loan_rows.exceptAll(sql).count() == 0
    by_state = plan.collections_by_state(loan_rows)
    by_state_sql = plan.collections_by_state_sql(loan_rows)
    assert sorted(map(tuple, by_state.collect())) == sorted(map(tuple, by_state_sql.collect()))


# --- cleaning ---


def test_cleaning_keeps_every_row_and_gives_nineteen_columns(spark):
    raw = loans(spark, SF)
    cleaned = plan.clean(raw)
    assert len(cleaned.columns) == 19
    assert {"term", "int_rate", "revol_util"}.isdisjoint(cleaned.columns)
    assert cleaned.count() == raw.count()
    term = plan.clean_term(raw)
    assert len(term.columns) == 19 and "int_rate" in term.columns
    assert term.schema["newTerm"].dataType.simpleString() == "int"


# --- features ---


def test_feature_rows_drop_any_null_but_not_in_kept_columns(spark):
    df = spark.createDataFrame(
        [(None, 0, 1.0, 2.0), ("a", None, 1.0, 2.0), ("b", 2, None, 2.0), ("c", 2, 1.0, None), ("d", 2, 1.0, 2.0)],
        "k string, c int, a double, b double",
    )
    got = features.feature_rows(df, "c", ["a", "b"], keep=["k"]).collect()
    assert [tuple(r) for r in got] == [(None, 0, 1.0, 2.0), ("d", 1, 1.0, 2.0)]


def test_weights_give_both_classes_the_same_total(feature_rows):
    totals = {
        r.label: r.total
        for r in features.weigh_classes(feature_rows)
        .groupBy("label").agg(F.sum("classWeight").alias("total")).collect()
    }
    assert set(totals) == {0, 1}
    assert totals[0] == pytest.approx(totals[1], rel=1e-9)


def test_ratio_can_come_from_the_training_part(feature_rows):
    train, _ = plan.train_test(feature_rows)
    ratio = aggregates.balancing_ratio(train, "label").first()[0]
    weights = features.weigh_classes(feature_rows, ratio_from=train)
    got = {r.label: r.w for r in weights.groupBy("label").agg(F.max("classWeight").alias("w")).collect()}
    assert got == {0: ratio, 1: 1.0 - ratio}


def test_key_split_is_whole_disjoint_and_stable(feature_rows):
    def keys(df):
        return {r.loan_id for r in df.select("loan_id").collect()}

    train, test = plan.train_test(feature_rows)
    assert keys(train) | keys(test) == keys(feature_rows)
    assert not keys(train) & keys(test)
    again, _ = plan.train_test(feature_rows.repartition(13))
    assert keys(again) == keys(train)
    assert 0.65 < len(keys(train)) / feature_rows.count() < 0.75


def test_key_split_keeps_rows_with_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(10)], "k bigint, v int")
    a, b = features.key_split(df, ["k"], 0.5, seed=3)
    assert a.count() + b.count() == 10


def test_random_split_is_whole(feature_rows):
    parts = features.random_split(feature_rows, [0.7, 0.3], 784)
    assert sum(p.count() for p in parts) == feature_rows.count()


def test_random_split_stays_when_the_layout_changes(spark):
    left = spark.range(20_000).withColumnRenamed("id", "k")
    df = left.join(left.withColumn("v", F.col("k") * 2), "k")
    train, test = features.random_split(df, [0.7, 0.3], 5)
    first = {r.k for r in train.collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        second = {r.k for r in test.collect()}
        joined = train.join(test.select("k"), "k").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert joined == 0 and not first & second and len(first) + len(second) == 20_000
    assert 0.67 < len(first) / 20_000 < 0.73


def test_one_class_is_rejected(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0)], "label int, x double")
    with pytest.raises(ValueError, match="one class only"):
        models.require_two_classes(df)
    vectors = features.assemble(features.weigh_classes(df), ["x"], keep=["classWeight"])
    with pytest.raises(ValueError, match="one class only"):
        models.fit(models.logistic_regression(), vectors)


def test_assembler_rejects_or_skips_nulls(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None)], "label int, x double")
    assert features.assemble(df, ["x"], handle_invalid="skip").count() == 1
    with pytest.raises(Exception):
        features.assemble(df, ["x"]).collect()


def test_split_without_loan_number_keeps_copies_together(spark):
    raw = materialize(loans(spark, SF), "raw")
    rows = plan.features(plan.clean(raw.unionAll(raw)), keep=())
    train, test = plan.train_test(rows)
    assert train.count() + test.count() == rows.count()
    assert train.intersect(test).count() == 0


# --- session ---


def test_scratch_folder_comes_from_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(f"{base}/x-")


def test_home_folder_names_the_user(spark):
    user = spark.sql("select current_user()").first()[0]
    assert home_folder(spark, "/base/") == f"/base/{user}/"
