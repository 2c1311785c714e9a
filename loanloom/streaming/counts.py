"""Group counts kept up to date over arriving rows, exact after repeated batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanloom.sources.files import Folders, beside


def _entries(spark: SparkSession, state: str) -> tuple[int, list[int]]:
    """The batch up to which counts are merged (-1 for none), and the later batches."""
    names = Folders(spark, state).children(state)
    merged = max((int(n.split("=")[1]) for n in names if n.startswith("upto=")), default=-1)
    return merged, sorted(b for n in names if n.startswith("batch=") and (b := int(n.split("=")[1])) > merged)


def _put(counts: DataFrame, target: str) -> None:
    """Write a folder beside its place and move it there: it appears whole or not at all."""
    files, staged = Folders(counts.sparkSession, target), beside(target, "new")
    counts.write.parquet(staged)
    files.delete(target)
    files.move(staged, target)


def merge_batch(counts: DataFrame, state: str, batch: int, keys: Sequence[str], compact_after: int = 100) -> None:
    """Record one batch's partial counts. Recording it again changes nothing.

    A batch is a folder named by its number, the ledger of what has been counted: a repeated batch
    replaces its own folder, and one that has been merged already is passed over. After
    ``compact_after`` batches their counts become one folder ``upto=<batch>``; folders up to it no longer
    count from the moment that it appears, so a stop in between counts nothing twice.
    """
    spark = counts.sparkSession
    merged, later = _entries(spark, state)
    if batch <= merged:
        return
    _put(counts, f"{state}/batch={batch}")
    later = sorted({*later, batch})
    if len(later) >= compact_after:
        compact(spark, state, keys)


def compact(spark: SparkSession, state: str, keys: Sequence[str]) -> None:
    """Make one folder of all batches, then delete them."""
    merged, later = _entries(spark, state)
    if not later:
        return
    _put(current_counts(spark, state, keys), f"{state}/upto={later[-1]}")
    files = Folders(spark, state)
    for name in files.children(state):
        if name != f"upto={later[-1]}" and int(name.split("=")[1]) <= later[-1]:
            files.delete(f"{state}/{name}")


def current_counts(spark: SparkSession, state: str, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per key over all batches so far: a sum over a few small folders."""
    merged, later = _entries(spark, state)
    folders = ([f"upto={merged}"] if merged >= 0 else []) + [f"batch={b}" for b in later]
    if not folders:
        raise ValueError(f"nothing has been counted in {state}")
    rows = spark.read.parquet(*[f"{state}/{f}" for f in folders])
    return rows.groupBy(*keys).agg(F.sum(name).alias(name))


def keep_counts(
    arrivals: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    state: str,
    checkpoint: str,
    compact_after: int = 100,
) -> StreamingQuery:
    """Count rows per key over everything that arrives, then stop; the next run goes on.

    Each micro-batch is counted on its own, combined before the shuffle, and merged by its number, so
    the counts are those of every row once, also when a batch is run again after a failure. No
    state grows in memory; what is stored is one row per key and batch.
    """

    def count(rows: DataFrame, batch: int) -> None:
        counts = transform(rows).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
        merge_batch(counts, state, batch, keys, compact_after)

    return (
        arrivals.writeStream.foreachBatch(count)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
