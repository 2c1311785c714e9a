"""Random splits with exact class counts, without sorting the rows."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.session import materialize

#: Bits of the random key that each pass over the keys settles.
_STEP = 10
_BITS = 64


def _cut_points(keys: DataFrame, label: str, key: str, quota: dict) -> dict:
    """Per class the key up to which exactly ``quota`` rows lie, by refining a histogram.

    The first pass counts the classes by the top bits of the key. Every further pass looks
    only at the one bin of each class in which its quota ends, by the next bits. A pass brings
    ``2 ** 10`` counts per class to the driver at most; about log(rows) / log(1024) passes are needed.
    """
    spark, kind = keys.sparkSession, keys.schema[label].dataType.simpleString()
    cut = {c: None for c, n in quota.items() if n == 0}
    open_ = {c: (0, n) for c, n in quota.items() if n}  # class: (prefix, rows still to take)
    shift = _BITS
    while open_:
        if shift < _BITS:
            bins = spark.createDataFrame(
                [(c, prefix) for c, (prefix, _) in open_.items()], f"__class {kind}, __prefix long"
            )
            inside = F.col(label).eqNullSafe(F.col("__class")) & (F.shiftright(key, shift) == F.col("__prefix"))
            rows = keys.join(F.broadcast(bins), inside, "left_semi")
        else:
            rows = keys
        shift = max(0, shift - _STEP)
        counted = rows.select(F.col(label).alias("class"), F.shiftright(key, shift).alias("bin"), F.col(key).alias("key"))
        found: dict = {}
        for c, *part in counted.groupBy("class", "bin").agg(F.count(F.lit(1)), F.max("key")).collect():
            if c in open_:
                found.setdefault(c, []).append(part)
        following = {}
        for c, (_, left) in open_.items():
            for number, n, last in sorted(found[c]):
                if n < left:
                    left -= n
                elif n == left:
                    cut[c] = last
                    break
                else:
                    following[c] = (number, left)
                    break
        open_ = following
    return cut


def stratified_split(
    df: DataFrame, label: str = "label", fraction: float = 0.7, seed: int = 0, most_classes: int = 10_000
) -> tuple[DataFrame, DataFrame]:
    """Two random parts; the first has exactly ``floor(n * fraction)`` rows of each class of n rows.

    A plain random split leaves the count of a rare class to chance. Here each row gets a random key,
    stored with it, and a class's part are its rows up to the key at its quota, found by
    counting, not by sorting: no row is moved, and a class that holds nearly all rows is no
    hot spot. Keys never tie: they are a one-to-one scramble of row numbers. A null label is a class of its own.
    The parts are filters on the stored rows and stay what they are. More than ``most_classes``
    classes are an error, as the driver holds counts of each.
    """
    spark = df.sparkSession
    number, key = "__number", "__key"
    while {number, key} & set(df.columns):
        number, key = number + "_", key + "_"
    if {"__class", "__last"} & set(df.columns):
        raise ValueError("columns named __class or __last are needed for the split")
    # xxhash64 of one long is a bijection, also on top of another hash
    stored = materialize(
        df.withColumn(number, F.monotonically_increasing_id()).withColumn(key, F.xxhash64(F.lit(seed), number)).drop(number),
        "stratified",
    )
    sizes = {r[0]: r[1] for r in stored.groupBy(label).count().limit(most_classes + 1).collect()}
    if len(sizes) > most_classes:
        raise ValueError(f"{label} has more than {most_classes} classes")
    share = Fraction(str(fraction))
    if not 0 <= share <= 1:
        raise ValueError("fraction must be between 0 and 1")
    quota = {c: int(n * share) for c, n in sizes.items()}
    cut = _cut_points(stored.select(label, key), label, key, quota)
    kind = stored.schema[label].dataType.simpleString()
    # one row per class, at most ``most_classes``: a size that is checked, so no row has to move
    cuts = F.broadcast(spark.createDataFrame([(c, last) for c, last in cut.items()], f"__class {kind}, __last long"))
    first = F.col(label).eqNullSafe(F.col("__class")) & (F.col(key) <= F.col("__last"))
    return (
        stored.join(cuts, first, "left_semi").drop(key),
        stored.join(cuts, first, "left_anti").drop(key),
    )
