"""Cleaning, labelling and weighting as stages of a saved flow.

With these a fitted flow takes raw columns: one folder holds all that happens to a row between
the file it came from and its score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions import binary_label, class_weight, unit_value
from loanloom.operators.aggregates import balancing_ratio
from loanloom.operators.cleaning import UnitRule


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Parameters are set by keyword and saved with the stage."""

    def value_of(self, name: str):
        return self.getOrDefault(self.getParam(name))


class UnitParser(_Stage, Transformer):
    """Adds one number column parsed from a unit text such as ``"7.5%"``; the text stays."""

    source = _param("source", "text column", TypeConverters.toString)
    target = _param("target", "number column", TypeConverters.toString)
    sep = _param("sep", "text between the items", TypeConverters.toString)
    index = _param("index", "item that holds the number, from 0", TypeConverters.toInt)
    dtype = _param("dtype", "type of the number", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, source=None, target=None, sep=None, index=None, dtype=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, rule: UnitRule) -> UnitParser:
        return cls(source=rule.source, target=rule.target, sep=rule.sep, index=rule.index, dtype=rule.dtype)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = unit_value(self.value_of("source"), self.value_of("sep"), self.value_of("index"), self.value_of("dtype"))
        return dataset.withColumn(self.value_of("target"), value)


class BinaryLabel(_Stage, Transformer):
    """Adds the 0/1 label of a count column, where the table has that column.

    Rows to be scored need no label: without the source column nothing is added.
    """

    source = _param("source", "count column", TypeConverters.toString)
    label = _param("label", "label column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, source=None, label=None):
        super().__init__()
        self._setDefault(label="label")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.value_of("source") not in dataset.columns:
            return dataset
        return dataset.withColumn(self.value_of("label"), binary_label(self.value_of("source")))


class CompleteRows(_Stage, Transformer):
    """Leaves out rows with a null in one of the columns; those the table lacks do not count."""

    columns = _param("columns", "columns that must be known", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.na.drop("any", subset=[c for c in self.value_of("columns") if c in dataset.columns])


class ClassWeigher(_Stage, Estimator):
    """Learns the balancing ratio of the rows that it is fitted on, the training rows."""

    label = _param("label", "label column", TypeConverters.toString)
    weight = _param("weight", "weight column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, label=None, weight=None):
        super().__init__()
        self._setDefault(label="label", weight="classWeight")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ClassWeigherModel:
        ratio = balancing_ratio(dataset, self.value_of("label")).first()[0]
        if ratio is None or ratio in (0, 1):
            raise ValueError("one class only: every class weight would be 0")
        return ClassWeigherModel(label=self.value_of("label"), weight=self.value_of("weight"), ratio=float(ratio))


class ClassWeigherModel(_Stage, Model):
    """Adds the class weight by a ratio learned earlier; rows without a label column stay as they are."""

    label = _param("label", "label column", TypeConverters.toString)
    weight = _param("weight", "weight column", TypeConverters.toString)
    ratio = _param("ratio", "share of rows that are not of class 0", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, label=None, weight=None, ratio=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.value_of("label") not in dataset.columns:
            return dataset
        return dataset.withColumn(self.value_of("weight"), class_weight(self.value_of("label"), F.lit(self.value_of("ratio"))))


def raw_flow(
    rules: Sequence[UnitRule], label_source: str, features: Sequence[str], estimator: Estimator, label: str = "label"
) -> Pipeline:
    """From raw columns to scores as one unit: parsing, label, complete rows, weights, assembly, fit.

    Fitting and scoring are projections and filters on one scan; the only job before the fit
    itself is the balancing ratio. A saved flow scores tables without the label's source too.
    """
    return Pipeline(stages=[
        *[UnitParser.of(r) for r in rules],
        BinaryLabel(source=label_source, label=label),
        CompleteRows(columns=[label, *features]),
        ClassWeigher(label=label),
        VectorAssembler(inputCols=list(features), outputCol="features"),
        estimator,
    ])
