"""Shares over a whole table in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share_percent(condition: Column) -> Column:
    """Percent of all rows that meet the condition; null for an empty table."""
    return F.try_divide(F.count_if(condition) * F.lit(100.0), F.count(F.lit(1)))
