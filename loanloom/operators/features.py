"""From a cleaned table to weighted, split, assembled training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions import binary_label, class_weight, hash_bucket
from loanloom.functions.splits import BUCKETS
from loanloom.operators.aggregates import balancing_ratio
from loanloom.session import materialize


def feature_rows(
    df: DataFrame,
    label_source: str,
    features: Sequence[str],
    label: str = "label",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Label and features of the rows in which none of them is null.

    An unknown label source gives a null label and so drops the row: unknown is not
    class 0. ``keep`` columns ride along and may be null.
    """
    columns = df.select(*keep, binary_label(label_source).alias(label), *features)
    return columns.na.drop("any", subset=[label, *features])


def weigh_classes(
    df: DataFrame,
    label: str = "label",
    weight: str = "classWeight",
    ratio_from: DataFrame | None = None,
) -> DataFrame:
    """Add the class weight. The ratio comes from ``ratio_from``, by default from ``df`` itself.

    The ratio is a scalar subquery: Spark computes the one number first and puts it in
    the projection as a constant. To keep test rows out of it pass the training part.
    """
    source = df if ratio_from is None else ratio_from
    ratio = balancing_ratio(source, label).scalar()
    return df.withColumn(weight, class_weight(label, ratio))


def assemble(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    output: str = "features",
    keep: Sequence[str] = (),
    handle_invalid: str = "error",
) -> DataFrame:
    """One vector column from numeric columns; keeps label, vector and ``keep``."""
    assembler = VectorAssembler(
        inputCols=list(features), outputCol=output, handleInvalid=handle_invalid
    )
    return assembler.transform(df).select(*keep, label, output)


def random_split(df: DataFrame, fractions: Sequence[float], seed: int) -> list[DataFrame]:
    """Disjoint random parts that together hold every row once.

    One random number per row is stored with it in the shared folder, and the parts are
    filters on the stored rows: they stay what they are however often, and in whatever
    layout, they are read. Fractions are taken relative to their sum.
    """
    number = "__part"
    while number in df.columns:
        number += "_"
    stored = materialize(df.withColumn(number, F.rand(seed)), "split")
    total, parts, low = float(sum(fractions)), [], 0.0
    for k, fraction in enumerate(fractions):
        high = low + fraction / total
        inside = F.col(number) >= low
        if k < len(fractions) - 1:
            inside &= F.col(number) < high
        parts.append(stored.where(inside).drop(number))
        low = high
    return parts


def key_split(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int, portable: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Two parts by a hash of the key: same rows after any repartition, retry or re-read.

    No sort and no shuffle, unlike the random split, which sorts every partition.
    """
    first = hash_bucket(*keys, seed=seed, portable=portable) < F.lit(round(fraction * BUCKETS))
    return df.where(first), df.where(~first)
