"""Importance resampling: draw the documents that look most like a target collection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.session import materialize

#: A-Z as a-z; every byte below 0x80 that is neither letter nor digit as a blank.
TABLE = bytes(arrays.LOWER[i] if arrays.PLAIN[arrays.LOWER[i]] else 0x20 for i in range(256))
#: Bytes of a text whose words are held as objects at one time.
BLOCK = 1 << 20


def _blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in order, about ``BLOCK`` bytes at a time."""
    plain = text.translate(TABLE)
    at = 0
    while at < len(plain):
        stop = at + BLOCK
        if stop < len(plain):
            stop = plain.find(b" ", stop)
            stop = len(plain) if stop < 0 else stop
        yield plain[at:stop].split()
        at = stop


def features(text: bytes, longest: int) -> Iterator[tuple[int, list[int]]]:
    """Number of words and the crc32 of every run of 1 to ``longest`` words, block by block.

    A run's checksum goes on from that of the run one word shorter, over a blank and the
    next word. Runs that reach into the next block are made there.
    """
    carry: list[bytes] = []
    for words in _blocks(text):
        all_words = carry + words
        spaced = [b" " + w for w in all_words] if longest > 1 else []
        seeds, out = list(map(crc32, all_words)), []
        for length in range(1, longest + 1):
            if length > 1:
                seeds = list(map(crc32, spaced[length - 1 :], seeds))
            # runs that end among the words carried over were counted with the block before
            out += seeds[max(0, len(carry) - length + 1) :]
        yield len(words), out
        carry = all_words[-(longest - 1) :] if longest > 1 else []


def _texts(batch: pa.RecordBatch, column: int):
    for value in batch.column(column):
        raw = value.as_buffer()
        yield b"" if raw is None else raw.to_pybytes()


def _counts(batches, longest, buckets):
    total, counter = np.zeros(buckets, np.int64), Counter()

    def fold():
        if counter:
            codes = np.fromiter(counter.keys(), np.int64, len(counter))
            np.add.at(total, codes % buckets, np.fromiter(counter.values(), np.int64, len(counter)))
            counter.clear()

    for batch in batches:
        for text in _texts(batch, 0):
            for _, codes in features(text, longest):
                counter.update(codes)
                if len(counter) > 200_000:
                    fold()
    fold()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text_column: str, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts per bucket. Each task sends one row per bucket at most."""
    counted = texts.select(F.col(text_column).cast("string").alias("text")).mapInArrow(
        partial(_counts, longest=longest, buckets=buckets), "bucket long, n long"
    )
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in target and source."""
    from math import floor, log

    size, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([
        floor(1000 * log((t + 1) * (all_source + size) / ((s + 1) * (all_target + size))))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def _weights(batches, gain, longest):
    for batch in arrays.pieces(batches, "text", 1 << 22):
        rows = []
        for text in _texts(batch, batch.num_columns - 1):
            n_words = n_features = weight = 0
            for words, codes in features(text, longest):
                n_words += words
                n_features += len(codes)
                weight += int(gain[np.array(codes, np.int64) % len(gain)].sum())
            rows.append((n_words, n_features, weight))
        found = np.array(rows, np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *(pa.array(c) for c in found.T)],
            [*batch.schema.names[:-1], "n_words", "n_features", "weight"],
        )


def noise(id_column: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[Column], rank: str = "rank", parts: int | None = None) -> DataFrame:
    """Adds the place (from 1) of every row in the whole order, without one task for all rows.

    Rows are cut into contiguous ranges, stored, and numbered inside each range; only one count per
    range meets in one place. Ends of the order must make it total, or equal rows get any order.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(
        rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    here = Window.partitionBy("__part").orderBy(*order)
    return cut.join(counts, "__part").withColumn(
        rank, (F.row_number().over(here) + F.col("__before")).cast("long")
    ).drop("__part", "__before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    longest: int = 2,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 0,
) -> DataFrame:
    """Draw ``percent`` of the documents, those that look like ``target`` first; a row per document.

    Returns the id, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (from 1 in drawing
    order; null for documents not drawn).

    Words are runs of ASCII letters, digits and bytes above 0x7F, A-Z as a-z. Features are all
    runs of 1 to ``longest`` words, hashed into ``buckets`` by crc32, and counted over all texts of either
    table. A document weighs the sum of its features' gains; Gumbel noise from a hash of ``seed``
    and the id is added, so that the highest scores are a sample without replacement with
    probabilities in proportion to the exponentials of the weights. Of the documents with
    ``least_words`` words or more, ``percent`` (rounded down) are drawn, ties to the smaller id,
    null last, then by reading order.

    A document is one row of five numbers after the scan; the order is cut into ranges and
    no task sees all of it. Null text has no words: weight 0, never drawn while ``least_words`` is
    above 0. Equal ids share their noise. Texts of any length are held as words 1 MB at a time.
    Other columns are not read. An empty ``docs`` gives no rows; an empty target has gains from
    smoothing alone.
    """
    gain = gains(
        bucket_counts(docs, text_column, longest, buckets), bucket_counts(target, target_column, longest, buckets)
    )
    source = docs.select(
        F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"),
        F.col(text_column).cast("string").alias("text"),
    )
    kind = source.schema["id"].dataType.simpleString()
    weighed = source.mapInArrow(
        partial(_weights, gain=gain, longest=longest),
        f"id {kind}, row long, n_words long, n_features long, weight long",
    )
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scored")
    able = F.col("n_words") >= least_words
    draw = (able_rows := scored.where(able)).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    placed = ranked(able_rows, order).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select(
        F.col("id").alias(id_column), "n_words", "n_features", "weight", "score", "rank"
    )
