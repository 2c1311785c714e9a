"""Numbers hidden in text such as ``" 36 months"`` or ``"7.5%"``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_item(source: str | Column, sep: str, index: int) -> Column:
    """0-based item of the text cut at the literal separator; null when there is no such item."""
    source = F.col(source) if isinstance(source, str) else source
    return F.get(F.split(source, re.escape(sep)), F.lit(index))


def unit_value(source: str | Column, sep: str, index: int, dtype: str) -> Column:
    """Typed item of the text; null when the item is missing or is no ``dtype``.

    Never aborts a job on a bad row. Pair it with :func:`parse_failed` to see how many
    rows were unreadable.
    """
    return split_item(source, sep, index).try_cast(dtype)


def parse_failed(source: str | Column, parsed: Column) -> Column:
    """True where there was text but no value came out of it."""
    source = F.col(source) if isinstance(source, str) else source
    return source.isNotNull() & parsed.isNull()
