"""Turn unit strings of a table into typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions import parse_failed, unit_value


@dataclass(frozen=True)
class UnitRule:
    """``target`` = item ``index`` of ``source`` cut at ``sep``, as ``dtype``."""

    source: str
    target: str
    sep: str
    index: int
    dtype: str

    def column(self):
        return unit_value(self.source, self.sep, self.index, self.dtype)


def parse_units(df: DataFrame, rules: Sequence[UnitRule], keep: Sequence[str] = ()) -> DataFrame:
    """Add every rule's target and drop its source, unless the source is listed in ``keep``.

    One projection for all rules, no shuffle, no row is lost.
    """
    parsed = df.withColumns({r.target: r.column() for r in rules})
    return parsed.drop(*[r.source for r in rules if r.source not in keep])


def parse_failures(df: DataFrame, rules: Sequence[UnitRule]) -> DataFrame:
    """Rows per target where the source had text but no value came out, in one pass."""
    counts = df.agg(
        *[F.count_if(parse_failed(r.source, r.column())).alias(r.target) for r in rules]
    )
    return counts.unpivot([], [r.target for r in rules], "column_name", "failed_rows")
