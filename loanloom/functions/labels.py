"""Class labels and class weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def binary_label(source: str | Column) -> Column:
    """1 for any count but zero, 0 for zero, null for an unknown count.

    The count is compared as a double: fractions, values beyond ``int`` and text such as
    ``'1.0'`` keep their meaning, and no other number than zero becomes zero. Text that is no number is unknown.
    """
    source = F.col(source) if isinstance(source, str) else source
    number = source.try_cast("double")
    return F.when(number != 0, F.lit(1)).when(number == 0, F.lit(0))


def class_weight(label: str | Column, ratio: Column) -> Column:
    """``1 - ratio`` for rows of a non-zero class, ``ratio`` for the rest.

    With ``ratio`` = share of non-zero rows both classes get the same total weight.
    """
    label = F.col(label) if isinstance(label, str) else label
    return F.when(label != 0, F.lit(1.0) - ratio).otherwise(ratio)
