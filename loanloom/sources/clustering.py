"""Tables laid out so that filters on any of several columns skip most row groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from loanloom.sources.tables import write_table


def ordinal(column: str, dtype: DataType) -> Column:
    """The values of a column in their order, as a double or, of text, as its first letters."""
    c = F.col(column)
    if isinstance(dtype, StringType):
        return F.substring(c, 1, 64)
    if isinstance(dtype, TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dtype, TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, BooleanType):
        return c.cast("int").cast("double")
    if isinstance(dtype, NumericType):
        return c.cast("double")
    raise ValueError(f"{column}: {dtype.simpleString()} has no order to cluster by")


def quantile_borders(
    df: DataFrame, columns: Sequence[str], bits: int, accuracy: int = 10_000, texts: int = 100_000
) -> list[list]:
    """Borders between ``2 ** bits`` about equal parts of each column, all of them in order.

    Numbers and times go through one sketch aggregate. There is none for text: its borders come from
    about ``texts`` rows drawn at random. Borders only decide on the layout, never on the rows.
    """
    parts = 2**bits
    values = {c: ordinal(c, df.schema[c].dataType) for c in columns}
    text = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    shares = [i / parts for i in range(1, parts)]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.percentile_approx(v, shares, accuracy).alias(f"b{columns.index(c)}") for c, v in values.items() if c not in text],
    ).first()
    # a value that many rows share is a border several times, so its number is its place among all rows
    borders = {c: sorted(row[f"b{i}"] or []) for i, c in enumerate(columns) if c not in text}
    if text:
        drawn = df.select(*[values[c].alias(c) for c in text]).sample(min(1.0, texts / max(1, row.n)), seed=7).collect()
        for c in text:
            found = sorted((r[c] for r in drawn if r[c] is not None), key=lambda v: v.encode("utf-8", "surrogatepass"))
            borders[c] = [found[len(found) * i // parts] for i in range(1, parts)] if found else []
    return [borders[c] for c in columns]


def part_number(value: Column, borders: Sequence, kind: str) -> Column:
    """How many borders are at or below the value; searched by sixteens, then one by one."""

    def array(items: Sequence) -> Column:
        return F.array(*map(F.lit, items)).cast(f"array<{kind}>")

    coarse, every = array(borders[15::16]), array(borders)
    first = F.size(F.filter(coarse, lambda b: b <= value)) * 16
    return first + F.size(F.filter(F.slice(every, first + 1, F.lit(15)), lambda b: b <= value))


def z_key(df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "z") -> DataFrame:
    """Adds the interleaved bits of each column's quantile number; nulls count as the last part.

    Quantiles, not values, are interleaved, so skewed columns spread as well as even ones: a value
    that a third of the rows share is one part, and the other columns order its rows.
    """
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("bits times columns must be 1 to 62")
    kinds = ["string" if isinstance(df.schema[c].dataType, StringType) else "double" for c in columns]
    values = [ordinal(c, df.schema[c].dataType) for c in columns]
    key = F.lit(0).cast("long")
    for i, borders in enumerate(quantile_borders(df, columns, bits)):
        number = F.when(values[i].isNull(), F.lit(2**bits - 1)).otherwise(part_number(values[i], borders, kinds[i]))
        # bit b of the number goes to bit b * columns: looked up, not computed anew for every row
        spread = [sum((n >> b & 1) << b * len(columns) for b in range(bits)) for n in range(2**bits)]
        key = key + F.get(F.array(*map(F.lit, spread)).cast("array<long>"), number) * 2 ** (len(columns) - 1 - i)
    return df.withColumn(name, key)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], parts: int, bits: int = 8, **options
) -> None:
    """Write a table in Z-order of ``columns``: files and row groups hold small boxes of them.

    The rows are cut by ranges of the Z key into ``parts`` files and sorted inside each, so the
    smallest and largest values kept for every row group are close together in all columns, and
    a filter on one or several of them skips the others' row groups. Rows of one key are dealt by a
    hash of the row, so a hot combination of values does not end in one task.
    """
    key = "__z"
    while key in df.columns:
        key += "_"
    keyed = z_key(df, columns, bits, key)
    hashed = F.xxhash64(*df.columns)
    laid = keyed.repartitionByRange(parts, F.col(key), hashed).sortWithinPartitions(key, hashed).drop(key)
    write_table(laid, path, **options)
