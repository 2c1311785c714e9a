"""Exact stratified splits, trees as expressions, and the flow from raw columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loanloom.operators import evaluation, features, models, stratified, tree_rules
from loanloom.operators.cleaning import UnitRule
from loanloom.operators.flow_stages import (
    BinaryLabel, ClassWeigher, ClassWeigherModel, CompleteRows, UnitParser, raw_flow,
)
from tests.test_plans import plan_of

# --- stratified split -----------------------------------------------------------------------


@pytest.mark.parametrize("fraction,seed", [(0.7, 1), (0.5, 2), (0.0, 3), (1.0, 4), (0.999, 5)])
def test_class_counts_are_exact(spark, fraction, seed):
    sizes = {0: 9_000, 1: 137, 2: 1, None: 50}
    rows = [(i, c) for c, n in sizes.items() for i in range(n)]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "i int, label int").repartition(5)
    first, second = stratified.stratified_split(df, "label", fraction, seed)
    got = {r.label: r["count"] for r in first.groupBy("label").count().collect()}
    assert got == {c: k for c, n in sizes.items() if (k := int(n * fraction + 1e-9))}
    assert first.unionByName(second).exceptAll(df).count() == 0 and first.count() + second.count() == len(rows)
    assert first.columns == df.columns


def test_split_is_random_and_follows_its_seed(spark):
    df = spark.range(4000).selectExpr("id", "id % 2 as label").repartition(3)
    parts = [
        {r.id for r in stratified.stratified_split(df, "label", 0.5, seed)[0].collect()} for seed in (1, 1, 2)
    ]
    assert parts[0] == parts[1] != parts[2]
    assert 700 < len(parts[0] & parts[2]) < 1300
    low = sum(i < 2000 for i in parts[0])
    assert 900 < low < 1100


def test_repeated_rows_an_empty_table_and_text_classes(spark):
    same = spark.createDataFrame([("a", 1)] * 501, "c string, __key int")
    first, second = stratified.stratified_split(same, "c", 0.3)
    assert (first.count(), second.count()) == (150, 351) and first.columns == ["c", "__key"]
    first, second = stratified.stratified_split(same.limit(0), "c")
    assert first.count() == second.count() == 0
    with pytest.raises(ValueError, match="classes"):
        stratified.stratified_split(spark.range(20), "id", most_classes=10)
    with pytest.raises(ValueError, match="fraction"):
        stratified.stratified_split(same, "c", 1.5)


def test_split_sorts_nothing(spark):
    df = spark.range(1000).selectExpr("id", "id % 2 as label")
    for part in stratified.stratified_split(df, "label"):
        text = plan_of(part)
        assert "Sort" not in text and "hashpartitioning" not in text and "BroadcastHashJoin" in text


# --- trees as expressions ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(3000):
        x, y, z = rnd.random() * 10, rnd.randrange(5), rnd.gauss(0, 1)
        label = int((x > 4) ^ (y == 2)) if rnd.random() < 0.9 else rnd.randrange(3)
        rows.append((i, x, y, z, 7, label))
    return spark.createDataFrame(rows, "i int, x double, y int, z double, same int, label int")


NAMES = ["x", "y", "z", "same"]


@pytest.mark.parametrize("params", [{}, {"maxDepth": 0}, {"maxDepth": 9, "minInstancesPerNode": 3}, {"impurity": "entropy"}])
def test_rules_equal_the_model(spark, numbers, folder, params):
    vectors = features.assemble(numbers, NAMES, keep=["i"])
    model = models.fit(models.decision_tree(**params), vectors)
    models.save_model(model, f"{folder}/tree")
    scored = evaluation.score_rows(model.transform(vectors), "i")
    ruled = tree_rules.score_by_rules(numbers, f"{folder}/tree", NAMES).select("i", "score", "prediction")
    assert ruled.exceptAll(scored).count() == 0 and ruled.count() == 3000


def test_rules_with_categories(spark, folder):
    from pyspark.ml.feature import VectorIndexer

    rnd = random.Random(9)
    rows = [(i, rnd.randrange(6), rnd.random(), 0) for i in range(800)]
    rows = [(i, c, x, int(c in (1, 4)) if x < 0.9 else 1) for i, c, x, _ in rows]
    df = spark.createDataFrame(rows, "i int, c int, x double, label int")
    vectors = features.assemble(df, ["c", "x"], keep=["i"])
    indexed = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=8).fit(vectors).transform(vectors)
    model = models.decision_tree(features="indexed").fit(indexed)
    models.save_model(model, f"{folder}/tree")
    want = evaluation.score_rows(model.transform(indexed), "i")
    got = tree_rules.score_by_rules(df, f"{folder}/tree", ["c", "x"]).select("i", "score", "prediction")
    assert got.exceptAll(want).count() == 0


def test_rules_read_only_what_the_tree_asks_and_bear_nulls(spark, numbers, folder):
    vectors = features.assemble(numbers, NAMES)
    model = models.fit(models.decision_tree(maxDepth=1), vectors)
    models.save_model(model, f"{folder}/tree")
    numbers.write.parquet(f"{folder}/rows")
    ruled = tree_rules.score_by_rules(spark.read.parquet(f"{folder}/rows"), f"{folder}/tree", NAMES)
    text = plan_of(ruled.select("prediction"))
    used = tree_rules.used_features(tree_rules.tree_nodes(spark, f"{folder}/tree"), NAMES)
    assert len(used) == 1 and f"ReadSchema: struct<{used[0]}:" in text
    assert "Python" not in text and "UDF" not in text
    empty = numbers.limit(1).withColumn(used[0], F.lit(None).cast("double"))
    row = tree_rules.score_by_rules(empty, f"{folder}/tree", NAMES).first()
    assert row.score is None and row.prediction is None


# --- the flow from raw columns ------------------------------------------------------------------

RULES = [UnitRule("term", "months", " ", 1, "int"), UnitRule("rate", "percent", "%", 0, "double")]


@pytest.fixture(scope="module")
def raw(spark):
    rnd, rows = random.Random(6), []
    for i in range(600):
        rate = rnd.random() * 20
        rows.append((i, rnd.choice([" 36 months", " 60 months", "months", None]), f"{rate:.2f}%", int(rate + rnd.gauss(0, 3) > 14)))
    return spark.createDataFrame(rows, "i int, term string, rate string, late int")


def test_a_saved_flow_scores_raw_rows(spark, raw, folder):
    flow = raw_flow(RULES, "late", ["months", "percent"], models.logistic_regression())
    model = flow.fit(raw)
    models.save_model(model, f"{folder}/flow")
    loaded = models.load_model("flow", f"{folder}/flow")
    before = evaluation.score_rows(model.transform(raw), "i", "classWeight")
    after = evaluation.score_rows(loaded.transform(raw), "i", "classWeight")
    assert before.count() == raw.where("term like ' %'").count() > 0
    assert before.exceptAll(after).count() == 0
    bare = loaded.transform(raw.select("i", "rate", "term"))
    assert evaluation.score_rows(bare, "i").exceptAll(before.select("i", "score", "prediction")).count() == 0
    assert "classWeight" not in bare.columns


def test_the_flow_equals_its_steps(spark, raw):
    model = raw_flow(RULES, "late", ["months", "percent"], models.logistic_regression()).fit(raw)
    from loanloom.operators.cleaning import parse_units

    rows = features.feature_rows(parse_units(raw, RULES), "late", ["months", "percent"], keep=["i"])
    vectors = features.assemble(features.weigh_classes(rows), ["months", "percent"], keep=["i", "classWeight"])
    own = models.fit(models.logistic_regression(), vectors)
    a = evaluation.score_rows(model.transform(raw), "i").withColumnRenamed("score", "a")
    b = evaluation.score_rows(own.transform(vectors), "i")
    assert a.join(b, "i").where(F.abs(F.col("a") - F.col("score")) > 1e-9).count() == 0
    assert a.count() == b.count()


def test_the_ratio_comes_from_the_training_rows(spark, raw):
    rows = BinaryLabel(source="late").transform(raw)
    weigher = ClassWeigher().fit(rows.where("i < 100"))
    share = rows.where("i < 100").agg(F.avg("label")).first()[0]
    assert weigher.value_of("ratio") == pytest.approx(share)
    got = {(r.label, round(r.classWeight, 9)) for r in weigher.transform(rows).collect()}
    assert got == {(0, round(share, 9)), (1, round(1 - share, 9))}
    with pytest.raises(ValueError, match="one class only"):
        ClassWeigher().fit(rows.where("label = 0"))


def test_stages_keep_their_parameters(spark, folder):
    parser = UnitParser.of(RULES[1])
    parser.write().overwrite().save(f"{folder}/p")
    loaded = UnitParser.load(f"{folder}/p")
    assert [loaded.value_of(n) for n in ("source", "target", "sep", "index", "dtype")] == ["rate", "percent", "%", 0, "double"]
    complete = CompleteRows(columns=["a", "gone"])
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert complete.transform(df).count() == 1
    weigher = ClassWeigherModel(label="l", weight="w", ratio=0.25)
    weigher.write().overwrite().save(f"{folder}/w")
    assert ClassWeigherModel.load(f"{folder}/w").value_of("ratio") == 0.25


def test_scoring_is_one_scan(spark, raw, folder):
    model = raw_flow(RULES, "late", ["months", "percent"], models.decision_tree()).fit(raw)
    raw.write.parquet(f"{folder}/raw")
    text = plan_of(model.transform(spark.read.parquet(f"{folder}/raw")))
    assert text.split("\n\n")[0].count("Scan parquet") == 1 and "Exchange" not in text and "Python" not in text


# --- conditions of the optimum ------------------------------------------------------------------


@pytest.mark.parametrize("reg,mix", [(0.02, 0.8), (0.1, 0.0), (0.3, 1.0)])
def test_optimality_holds_at_the_optimum_only(spark, raw, reg, mix):
    from loanloom.operators.cleaning import parse_units

    rows = features.feature_rows(parse_units(raw, RULES), "late", ["months", "percent"])
    vectors = features.assemble(features.weigh_classes(rows), ["months", "percent"], keep=["classWeight"])
    fit = lambda **p: models.fit(models.logistic_regression(regParam=reg, elasticNetParam=mix, **p), vectors)
    done = models.optimality(fit(maxIter=300, tol=1e-12), vectors, reg, mix)
    assert max(r.gap for r in done.collect()) < 1e-5
    if reg < 0.3:
        early = models.optimality(fit(maxIter=1), vectors, reg, mix)
        assert max(r.gap for r in early.collect()) > 1e-4
