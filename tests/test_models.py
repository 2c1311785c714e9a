from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanloom.operators import evaluation, features, models
from loanloom.plans import loans as plan
from loanloom.plans.fixture import loans
from loanloom.session import materialize


@pytest.fixture(scope="module")
def separable(spark):
    """Two clusters with a little overlap, 5 % positive."""
    rng = random.Random(7)
    rows = [
        (i, int(i % 20 == 0), rng.gauss(3.0 if i % 20 == 0 else 0.0, 1.0), rng.gauss(0.0, 1.0))
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "id bigint, label int, x double, y double")
    weighted = features.weigh_classes(df)
    return materialize(features.assemble(weighted, ["x", "y"], keep=["id", "classWeight"]), "sep")


@pytest.fixture(scope="module")
def parts(separable):
    return features.key_split(separable, ["id"], 0.7, 784)


@pytest.fixture(scope="module")
def tree(parts):
    return models.fit(models.decision_tree(), parts[0])


@pytest.fixture(scope="module")
def logistic(parts):
    return models.fit(models.logistic_regression(), parts[0])


def brute_force_auroc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    won = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return won / (len(pos) * len(neg))


def auroc(spark, rows, **kw):
    df = spark.createDataFrame(rows, "score double, label int")
    return evaluation.area_under_roc(df, **kw).first()[0]


@pytest.mark.parametrize(
    "rows",
    [
        [(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)],
        [(0.9, 0), (0.8, 0), (0.2, 1), (0.1, 1)],
        [(0.5, 0), (0.5, 1), (0.5, 1)],
        [(0.1, 0), (0.4, 1), (0.4, 0), (0.4, 0), (0.7, 1), (0.7, 0), (0.9, 1)],
        [(0.3, 1), (0.6, 1)],
    ],
    ids=["perfect", "reversed", "all equal", "ties", "one class"],
)
def test_auroc_of_hand_rows(spark, rows):
    assert auroc(spark, rows, parts=3) == brute_force_auroc(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(st.integers(-5, 30).map(lambda i: i / 8), st.integers(0, 1)), min_size=1, max_size=80
    ),
    parts=st.integers(1, 9),
)
def test_auroc_equals_pair_counting(spark, rows, parts):
    want = brute_force_auroc(rows)
    got = auroc(spark, rows, parts=parts)
    assert got is None if want is None else got == pytest.approx(want, abs=1e-12)


def test_auroc_leaves_out_rows_without_score_or_label(spark):
    rows = [(0.1, 0), (0.9, 1), (None, 1), (0.95, None)]
    assert auroc(spark, rows) == 1.0


def test_score_ranges_follow_the_scores(spark):
    odd = [float("nan"), float("-inf"), float("inf"), -0.0, 1e308, 5e-324]
    scores = spark.createDataFrame([(s,) for s in odd + [i / 7 for i in range(500)]], "s double")
    for parts in (1, 2, 3, 8, 33):
        found = evaluation.score_ranges(scores, scores, parts).orderBy("s").collect()
        order = [r.part for r in found]
        assert len(found) == scores.count() and order == sorted(order) and order[-1] < parts
        sizes = [order.count(p) for p in range(parts)]
        assert max(sizes) <= 2 * len(found) / parts
    alike = scores.select(F.lit(0.5).alias("s"))
    assert {r.part for r in evaluation.score_ranges(alike, alike, 8).collect()} == {0}
    assert evaluation.score_ranges(scores.limit(0), scores.limit(0), 8).collect() == []


def test_auroc_with_a_hot_score(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, 0.5).otherwise(F.col("id") / 60_000).alias("score"),
        F.expr("cast(id % 7 = 0 or id > 50000 as int)").alias("label"),
    )
    rows = [tuple(r) for r in df.groupBy("score", "label").count().collect()]
    order = sorted({s for s, _, _ in rows})
    pos = {s: 0 for s in order}
    neg = {s: 0 for s in order}
    for s, y, n in rows:
        (pos if y else neg)[s] += n
    below, won2 = 0, 0
    for s in order:
        won2 += pos[s] * (2 * below + neg[s])
        below += neg[s]
    want = won2 / (2 * sum(pos.values()) * sum(neg.values()))
    assert evaluation.area_under_roc(df, parts=16).first()[0] == pytest.approx(want, rel=1e-12)


def test_tree_defaults():
    dt = models.decision_tree()
    assert (dt.getMaxDepth(), dt.getMaxBins(), dt.getImpurity(), dt.getSeed()) == (5, 32, "gini", 1028)


def test_logistic_parameters():
    lr = models.logistic_regression()
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam()) == (100, 0.0, 0.0)
    assert lr.getThreshold() == 0.5 and lr.getStandardization() and lr.getWeightCol() == "classWeight"
    enet = models.logistic_regression(weight=None, maxIter=10, regParam=0.3, elasticNetParam=0.8)
    assert (enet.getMaxIter(), enet.getRegParam(), enet.getElasticNetParam()) == (10, 0.3, 0.8)
    assert not enet.isSet("weightCol")


def test_tree_finds_the_clusters(tree, parts):
    scored = evaluation.score_rows(tree.transform(parts[1]), "label")
    precision = {r.prediction: r.precision for r in evaluation.precision_by_label(scored).collect()}
    assert precision[0] > 0.95 and precision[1] > 0.6


def test_scored_columns(tree, parts):
    out = tree.transform(parts[1])
    assert {"rawPrediction", "probability", "prediction"} <= set(out.columns)


def test_tree_saved_and_loaded_scores_the_same(tree, parts, folder):
    for _ in range(2):  # the second save replaces the first
        models.save_model(tree, f"{folder}/tree")
    loaded = models.load_model("tree", f"{folder}/tree")
    cols = ["id", "prediction", vector_to_array("probability").alias("p")]
    before, after = tree.transform(parts[1]).select(cols), loaded.transform(parts[1]).select(cols)
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_fits_are_repeatable_and_persist_changes_nothing(parts, tree, logistic):
    again = models.fit(models.decision_tree(), parts[0], persist=False)
    assert again.toDebugString.split("\n")[1:] == tree.toDebugString.split("\n")[1:]
    other = models.fit(models.logistic_regression(), parts[0], persist=False)
    assert list(other.coefficients) == pytest.approx(list(logistic.coefficients), rel=1e-6)
    assert not parts[0].is_cached


def test_logistic_meets_the_score_equations(logistic, parts):
    """At the optimum of an unregularised fit the weighted residuals sum to 0 for every feature."""
    p = vector_to_array("probability")[1]
    x = vector_to_array("features")
    residual = F.col("classWeight") * (F.col("label") - p)
    sums = logistic.transform(parts[0]).agg(
        F.sum(residual), F.sum(residual * x[0]), F.sum(residual * x[1]), F.sum("classWeight")
    ).first()
    for s in sums[:3]:
        assert abs(s) / sums[3] < 1e-4


def test_summary_precision_equals_the_weighted_table_form(logistic):
    summary = logistic.summary
    scored = evaluation.score_rows(summary.predictions, "label", "classWeight")
    rows = evaluation.precision_by_label(scored, weight="classWeight").collect()
    got = {r.prediction: r.precision for r in rows}
    want = dict(zip((int(v) for v in summary.labels), summary.precisionByLabel))
    assert got == pytest.approx(want, rel=1e-9)


def test_evaluation_of_the_test_part(logistic, parts):
    result = logistic.evaluate(parts[1])
    assert result.predictions.count() == parts[1].count()
    binned = evaluation.area_under_roc_binned(result.predictions)
    exact = evaluation.area_under_roc(evaluation.score_rows(result.predictions, "label")).first()[0]
    assert binned == pytest.approx(exact, abs=2e-3)
    every_point = evaluation.area_under_roc_binned(result.predictions, bins=0)
    assert every_point == pytest.approx(exact, abs=1e-9)


def test_area_does_not_depend_on_class_weights(logistic, parts):
    result = logistic.evaluate(parts[1])
    assert result.areaUnderROC == pytest.approx(
        evaluation.area_under_roc_binned(result.predictions), abs=1e-3
    )


def test_confusion_and_precision_agree(spark):
    rows = [(0, 0)] * 5 + [(1, 0)] * 2 + [(0, 1)] + [(1, 1)] * 3
    df = spark.createDataFrame(rows, "label int, prediction int")
    counts = {(r.label, r.prediction): r.rows for r in evaluation.confusion(df).collect()}
    assert counts == {(0, 0): 5, (1, 0): 2, (0, 1): 1, (1, 1): 3}
    precision = {r.prediction: r.precision for r in evaluation.precision_by_label(df).collect()}
    assert precision == pytest.approx({0: 5 / 7, 1: 3 / 4})


def test_precision_of_a_class_never_predicted_is_zero(spark):
    df = spark.createDataFrame([(0, 0)] * 5 + [(1, 0)] + [(2, None), (None, 0)], "label int, prediction int")
    precision = {r.prediction: r.precision for r in evaluation.precision_by_label(df).collect()}
    assert precision == pytest.approx({0: 5 / 7, 1: 0.0, 2: 0.0})
    assert evaluation.precision_by_label(df.limit(0)).count() == 0


def test_roc_curve_has_every_point(spark):
    rows = [(1, 0.9, 2.0), (0, 0.8, 1.0), (1, 0.8, 1.0), (0, 0.3, 4.0), (1, 0.1, 1.0), (None, 0.5, 1.0), (1, None, 1.0)]
    df = spark.createDataFrame(rows, "label int, score double, w double")
    got = sorted((r.fpr, r.tpr) for r in evaluation.roc_curve(df, parts=3).collect())
    want = [(0, 0), (0, 1 / 3), (0.5, 2 / 3), (1, 2 / 3), (1, 1)]
    assert [x for p in got for x in p] == pytest.approx([x for p in want for x in p])
    weighted = sorted((r.fpr, r.tpr) for r in evaluation.roc_curve(df, weight="w").collect())
    want = [(0, 0), (0, 0.5), (0.2, 0.75), (1, 0.75), (1, 1)]
    assert [x for p in weighted for x in p] == pytest.approx([x for p in want for x in p])
    many = spark.range(5000).selectExpr("cast(id % 2 as int) as label", "cast(id as double) as score")
    assert evaluation.roc_curve(many).count() == 5001


def test_precision_equals_the_model_summary(spark):
    rows = [(i % 5 == 0, float(i % 7), float(i % 3)) for i in range(300)]
    df = spark.createDataFrame([(int(a), x, y) for a, x, y in rows], "label int, x double, y double")
    vectors = features.assemble(features.weigh_classes(df), ["x", "y"], keep=["classWeight"])
    model = models.fit(models.logistic_regression(), vectors)
    scored = evaluation.score_rows(model.summary.predictions, "label", "classWeight")
    got = {r.prediction: r.precision for r in evaluation.precision_by_label(scored, weight="classWeight").collect()}
    assert [got[i] for i in (0, 1)] == pytest.approx(list(model.summary.precisionByLabel))


def test_saved_flow_is_loaded(spark, folder):
    df = spark.createDataFrame([(i % 2, float(i), 1.0) for i in range(40)], "label int, x double, classWeight double")
    model = models.fit(models.flow(["x"], models.logistic_regression()), df)
    models.save_model(model, f"{folder}/flow")
    again = models.load_model("flow", f"{folder}/flow").transform(df)
    assert [r.prediction for r in again.collect()] == [r.prediction for r in model.transform(df).collect()]


def test_unweighted_tree_on_rare_collections_says_never(spark):
    """The imbalance lesson: without weights the tree gains nothing from predicting the rare class."""
    rows = materialize(plan.features(plan.clean(loans(spark, "/root/testdata/sf0.01"), ("loan_id",))), "f")
    _, scored = plan.fit_tree(rows)
    share = scored.agg(F.avg((F.col("prediction") == 0).cast("int"))).first()[0]
    assert share > 0.98


def test_fit_on_an_unsaved_plan(spark):
    rows = plan.features(plan.clean(loans(spark, "/root/testdata/sf0.001"), ("loan_id",)))
    _, scored = plan.fit_tree(rows)
    assert scored.count() == plan.train_test(rows)[1].count()


def test_flow_is_one_saved_unit(spark, folder):
    rng = random.Random(1)
    df = spark.createDataFrame(
        [(int(i % 4 == 0), rng.gauss(2.0 * (i % 4 == 0), 1.0), rng.random()) for i in range(400)],
        "label int, x double, y double",
    )
    model = models.fit(models.flow(["x", "y"], models.logistic_regression(weight=None)), df)
    models.save_model(model, f"{folder}/flow")
    loaded = PipelineModel.load(f"{folder}/flow")
    a = model.transform(df).select("x", vector_to_array("probability")[1].alias("p"))
    b = loaded.transform(df).select("x", vector_to_array("probability")[1].alias("p"))
    assert a.exceptAll(b).count() == 0
