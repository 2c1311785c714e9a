"""Quality of a scored table."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.session import materialize

#: Accuracy of the sketch per border: a range's share of the scores is off by a tenth at most.
SKETCH_ACCURACY = 20


def score_rows(predictions: DataFrame, *keep: str) -> DataFrame:
    """Flat scored table: ``keep`` columns, probability of class 1, predicted class."""
    return predictions.select(
        *keep,
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, predicted class)."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("rows"))


def precision_by_label(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """Per class the share of the rows predicted as it (or of their weight) that carry its label.

    Every class found in either column has a row; one that is never predicted has 0.0. The rows
    are counted by label and prediction first; only these few counts are then dealt to the
    classes, each to its prediction, and to its label's with nothing. A null class has no row.
    """
    mass = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    kind = df.schema[prediction].dataType
    counts = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.sum(mass).alias("mass"))
    hit = F.when(F.col("l") == F.col("p"), F.col("mass")).otherwise(F.lit(0.0))
    predicted = F.struct(F.col("p").alias("c"), hit.alias("hit"), F.col("mass").alias("mass"))
    labelled = F.struct(F.col("l").cast(kind).alias("c"), F.lit(0.0).alias("hit"), F.lit(0.0).alias("mass"))
    classes = counts.select(F.explode(F.array(predicted, labelled)).alias("x")).select("x.*")
    return classes.where("c is not null").groupBy(F.col("c").alias(prediction)).agg(
        F.coalesce(F.try_divide(F.sum("hit"), F.sum("mass")), F.lit(0.0)).alias("precision")
    )


def area_under_roc_binned(
    predictions: DataFrame, label: str = "label", raw: str = "rawPrediction", bins: int = 0
) -> float:
    """Spark's evaluator: unweighted, every point of the curve, or thinned to ``bins`` points."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=bins
    )
    return evaluator.evaluate(predictions)


def score_ranges(per_score: DataFrame, scores: DataFrame, parts: int) -> DataFrame:
    """``per_score`` with ``part``, the number of the score's range; ranges are in score order.

    The ``parts - 1`` borders come from one mergeable quantile sketch over ``scores`` (column
    ``s``), a scalar subquery that stays inside the plan: a sketch per task, no sampling job and
    no shuffle by range. A range has at most as many distinct scores as rows, so its share of
    the rows bounds it. Any sorted borders are right, the sketch only decides how even the
    ranges are. A score's range is the number of borders below it, found by binary steps.
    """
    if parts < 2:
        return per_score.withColumn("part", F.lit(0))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    borders = scores.agg(
        F.sort_array(F.approx_percentile("s", shares, SKETCH_ACCURACY * parts)).alias("b")
    ).scalar()
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((parts - 1).bit_length()))])
    part = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get("__b", at + step - 1) < F.col("s"), at + step).otherwise(at)
    )
    return per_score.withColumn("__b", borders).withColumn("part", part).drop("__b")


def area_under_roc(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    parts: int | None = None,
    name: str = "area_under_roc",
) -> DataFrame:
    """Exact area under the ROC curve as one row; ties count half, null if a class is missing.

    It is the share of (positive, negative) pairs ranked the right way, from running
    counts over the sorted scores. Rows collapse to one per distinct score first, so a
    score shared by many rows is no hot spot. Scores are then cut into contiguous ranges
    (:func:`score_ranges`), each summed on its own: the scores are shuffled twice, and only
    the totals per range (``parts`` rows) meet in one place.
    Rows without score or label cannot be ranked and are left out.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    one, zero = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    rows = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    per_score = (
        rows.groupBy(F.col(score).alias("s"))
        .agg(one.cast("double").alias("pos"), zero.cast("double").alias("neg"))
    )
    ranged = score_ranges(per_score, rows.select(F.col(score).alias("s")), parts)
    below = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        ranged.withColumn("neg_below", F.coalesce(F.sum("neg").over(below), F.lit(0.0)))
        .groupBy("part")
        .agg(
            # twice the number of won pairs inside the range, so that halves stay whole
            F.sum(F.col("pos") * (2 * F.col("neg_below") + F.col("neg"))).alias("won2"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
        )
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    joined = inside.withColumn("neg_before", F.coalesce(F.sum("neg").over(earlier), F.lit(0.0)))
    won2 = F.sum(F.col("won2") + 2 * F.col("pos") * F.col("neg_before"))
    return joined.agg(
        F.try_divide(won2, 2 * F.sum("pos") * F.sum("neg")).alias(name)
    )


def roc_curve(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    weight: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """The whole ROC curve: ``fpr`` and ``tpr`` at every distinct score, and the origin.

    Scores collapse to one row each and are cut into contiguous ranges; a range only needs
    the totals of those above it, of which there are ``parts``. Rows without score or label
    are left out. With one class missing its rate is null.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mass = F.lit(1.0) if weight is None else F.col(weight).cast("double")

    def of(value):
        return F.sum(F.when(F.col(label) == value, mass).otherwise(F.lit(0.0)))

    rows = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    per_score = (
        rows.groupBy(F.col(score).alias("s"))
        .agg(of(1).alias("pos"), of(0).alias("neg"))
    )
    stored = materialize(per_score, "scores")
    ranged = score_ranges(stored, stored, parts)
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = ranged.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        "part",
        *[F.coalesce(F.sum(c).over(above), F.lit(0.0)).alias(f"{c}_above") for c in "pn"],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in "pn"],
    )
    upto = Window.partitionBy("part").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    points = ranged.join(totals, "part").select(
        F.try_divide(F.col("n_above") + F.sum("neg").over(upto), "n_all").alias("fpr"),
        F.try_divide(F.col("p_above") + F.sum("pos").over(upto), "p_all").alias("tpr"),
    )
    return points.union(spark.createDataFrame([(0.0, 0.0)], "fpr double, tpr double"))
