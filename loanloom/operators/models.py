"""Binary classifiers on assembled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_CLASSES = {
    "tree": DecisionTreeClassificationModel,
    "logistic": LogisticRegressionModel,
    "flow": PipelineModel,
}


def decision_tree(
    label: str = "label", features: str = "features", seed: int = 1028, **params
) -> DecisionTreeClassifier:
    """Unweighted tree with Spark's defaults; ``params`` go to the estimator."""
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=seed, **params)


def logistic_regression(
    label: str = "label", features: str = "features", weight: str | None = "classWeight", **params
) -> LogisticRegression:
    """Logistic regression, weighted by class unless ``weight`` is None.

    On a wide cluster raise ``aggregationDepth``: gradients of all tasks are then summed in
    more tree levels instead of at the driver.
    """
    if weight is not None:
        params["weightCol"] = weight
    return LogisticRegression(labelCol=label, featuresCol=features, **params)


def require_two_classes(df: DataFrame, label: str = "label") -> None:
    """Reject training rows of a single class: every class weight would be 0."""
    zero, other = df.agg(
        F.count_if(F.col(label) == 0), F.count_if(F.col(label) != 0)
    ).first()
    if not zero or not other:
        raise ValueError(f"one class only: {zero} rows of class 0, {other} of any other class")


def fit(estimator: Estimator, df: DataFrame, label: str = "label", persist: bool = True) -> Model:
    """Check the label, then fit.

    An estimator passes over its input several times before it has its own compact blocks
    in memory, and every pass repeats the plan behind the input, class ratio included.
    ``persist`` computes the input once, spills to disk what memory cannot hold, and is
    released afterwards; blocks of a lost executor are computed again. Switch it off for
    stored features far beyond the memory of the cluster, where re-reading columns is
    cheaper than spilling vectors.
    """
    if persist:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        require_two_classes(df, label)
        return estimator.fit(df)
    finally:
        if persist:
            df.unpersist()


def optimality(
    model: LogisticRegressionModel,
    df: DataFrame,
    reg: float,
    mix: float,
    label: str = "label",
    features: str = "features",
    weight: str = "classWeight",
) -> DataFrame:
    """How far each coefficient is from satisfying the conditions of the optimum, one row per feature.

    With coefficients scaled by the features' standard deviations, the weighted mean gradient of the
    loss plus ``reg * (1 - mix)`` times the coefficient must be ``reg * mix`` against the coefficient's
    sign, or at most that where the coefficient is 0. ``gap`` is what is missing; ``coefficient`` is the scaled
    one. One aggregate over the rows, whose result has a number per feature.
    """
    size = model.numFeatures
    x, w = vector_to_array(features), F.col(weight).cast("double")
    flat = model.transform(df).select(
        w.alias("w"), x.alias("x"), (vector_to_array("probability")[1] - F.col(label)).alias("e")
    )
    values = [F.col("x")[j] for j in range(size)]
    total = F.sum("w")
    sums = flat.agg(
        total.alias("n"),
        F.array(*[F.sum(F.col("w") * F.col("e") * v) / total for v in values]).alias("gradient"),
        F.array(*[F.sum(F.col("w") * v) / total for v in values]).alias("mean"),
        F.array(*[F.sum(F.col("w") * v * v) / total for v in values]).alias("square"),
        F.sum(F.col("w") * F.col("w")).alias("n2"),
    ).first()
    rows = []
    for j, coefficient in enumerate(model.coefficients.toArray().tolist()):
        variance = (sums.square[j] - sums.mean[j] ** 2) * sums.n / (sums.n - sums.n2 / sums.n)
        deviation = max(variance, 0.0) ** 0.5
        scaled = coefficient * deviation
        slope = (sums.gradient[j] / deviation if deviation else 0.0) + reg * (1 - mix) * scaled
        if scaled:
            gap = abs(slope + reg * mix * (1 if scaled > 0 else -1))
        else:
            gap = max(0.0, abs(slope) - reg * mix)
        rows.append((j, scaled, gap))
    return df.sparkSession.createDataFrame(rows, "feature int, coefficient double, gap double")


def flow(features: Sequence[str], estimator: Estimator, output: str = "features") -> Pipeline:
    """Assembly and training as one unit that is saved, loaded and applied together."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=output)
    return Pipeline(stages=[assembler, estimator])


def save_model(model: Model, path: str) -> None:
    """Write the model folder, replacing an older one."""
    model.write().overwrite().save(path)


def load_model(kind: str, path: str) -> Model:
    """Read a model folder; ``kind`` is ``tree``, ``logistic`` or ``flow``."""
    return MODEL_CLASSES[kind].load(path)
