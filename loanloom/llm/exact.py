"""Exact deduplication by merging sorted runs of digests along a tree of partitions."""

from __future__ import annotations

import heapq
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.session import materialize

#: The white space that counts as one blank.
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"

#: Digests that one merge takes on average; a node with more has more digest ranges.
RUN = 1 << 16


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, " ")


def digests(docs: DataFrame, id_column: str, text_column: str, row: Column) -> DataFrame:
    """A row per document: row number, id, partition, digest and verifier of its text."""
    return docs.select(
        row.alias("row"), F.spark_partition_id().alias("node"),
        F.col(id_column).alias("id"), normalised(text_column).alias("text"),
    ).select(
        "row", "node", "id", F.unhex(F.sha2("text", 256)).alias("digest"),
        F.struct(F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("hash")).alias("verifier"),
    )


def _order(value):
    """``value`` as Python compares it the way Spark orders it: nulls first, NaN last."""
    if isinstance(value, dict):
        return tuple(map(_order, value.values()))
    if value is None:
        return (False,)
    return (True, value != value, value if value == value else 0)


def _merge(key: tuple, table: pa.Table, ranges: int) -> pa.Table:
    """The runs of one receiver and digest range as one run, cut at the borders of ``ranges`` ranges.

    A multiway merge by digest. Of equal digests whose verifiers agree the smallest identifier
    stays with the sum of the sizes; a digest with several verifiers keeps an entry for each.
    """
    runs = table["run"].combine_chunks()
    entries, ends = runs.flatten(), np.cumsum(runs.value_lengths().to_numpy(zero_copy_only=False))
    digest, verifier, least, sizes = (entries.field(n) for n in ("digest", "verifier", "least", "size"))
    names, weights = digest.to_pylist(), sizes.to_pylist()
    streams = [zip(names[a:b], range(a, b)) for a, b in zip([0, *ends[:-1]], ends)]
    chosen, total, cut, last = [], [], [], None
    for name, same in groupby(heapq.merge(*streams), key=itemgetter(0)):
        at = int.from_bytes(name[:4]) * ranges >> 32
        if at != last:
            cut.append((at, len(chosen)))
            last = at
        places = [i for _, i in same]
        if len(places) == 1:
            chosen.append(places[0])
            total.append(weights[places[0]])
            continue
        texts = {}
        for i in places:
            texts.setdefault(_order(verifier[i].as_py()), []).append(i)
        for _, alike in sorted(texts.items()):
            chosen.append(min(alike, key=lambda i: _order(least[i].as_py())))
            total.append(sum(weights[i] for i in alike))
    kept = entries.take(pa.array(chosen, pa.int64()))
    columns = [pa.array(total, pa.int64()) if f.name == "size" else kept.field(f.name) for f in kept.type]
    run = pa.StructArray.from_arrays(columns, fields=list(kept.type))
    offsets = pa.array([first for _, first in cut] + [len(chosen)], pa.int32())
    return pa.table({
        "node": pa.array([key[0].as_py()] * len(cut), pa.int32()),
        "range": pa.array([at for at, _ in cut], pa.int64()),
        "run": pa.ListArray.from_arrays(offsets, run, type=pa.list_(runs.type.value_field)),
    })


def _merging(ranges: int):
    return lambda key, table: _merge(key, table, ranges)


def tree_merge(found: DataFrame, fan: int = 8, run: int = RUN) -> DataFrame:
    """``digest``, ``verifier``, ``least`` and ``size`` of every distinct text of ``found``.

    Every partition (``node``) starts with a sorted run of its distinct digests. In each round
    ``fan`` neighbouring nodes become one: they send their runs, a row each, to the
    first of them, which merges them in order (:func:`_merge`); after log(nodes) rounds node 0
    has all. A node's digests lie in as many ranges as keep a merge at about ``run``
    entries: senders cut their runs at the borders, so receivers of late rounds are many tasks.
    Digests are evenly spread, and equal ones are one entry per sender.
    """
    rows, nodes = found.agg(F.count(F.lit(1)), F.max("node") + 1).first()
    nodes = nodes or 1
    levels, width = 1, fan
    while width < nodes:
        levels, width = levels + 1, width * fan

    def ranges(level: int) -> int:
        """Digest ranges of a receiver in this round; the first four bytes tell them apart."""
        return min(1 << 32, max(1, rows * fan ** min(level, levels) // (max(nodes, width // fan) * run)))

    # a struct orders null first: the flag puts it last
    identifier = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    prefix = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    leaves = found.groupBy("node", "digest", "verifier").agg(
        F.min(identifier).alias("least"), F.count(F.lit(1)).alias("size")
    )
    runs = leaves.groupBy("node", F.shiftright(prefix * ranges(1), 32).alias("range")).agg(
        F.sort_array(F.collect_list(F.struct("digest", "verifier", "least", "size"))).alias("run")
    )
    for level in range(1, levels + 1):
        received = runs.withColumn("node", F.floor(F.col("node") / F.lit(fan)).cast("int"))
        runs = received.groupBy("node", "range").applyInArrow(_merging(ranges(level + 1)), received.schema)
        if level % 4 == 0 and level < levels:  # a lost executor replays four rounds at most
            runs = materialize(runs, "runs")
    return runs.select(F.inline("run"))


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fan: int = 8, run: int = RUN
) -> DataFrame:
    """Which document stays of each group of equal texts; a row per document.

    Returns the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``. Texts are
    equal when they are identical after every run of ASCII white space has become one
    blank; SHA-256 finds them, length and a second hash verify. The smallest id stays,
    null after all others; of rows that share it the first read. Null text is empty.
    Other columns are not read. An empty table gives no rows. See :func:`tree_merge` for
    ``fan`` and ``run``.
    """
    return _groups(
        digests(docs, id_column, text_column, F.monotonically_increasing_id()), fan, run
    ).select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", "text_sha256"
    )


def _groups(found: DataFrame, fan: int, run: int) -> DataFrame:
    found = materialize(found, "digests")
    merged = tree_merge(found, fan, run)
    # a hot text has one merged row and many documents: the adaptive join splits these
    return found.join(merged, ["digest", "verifier"]).select(
        "row", "id", F.col("least.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("least.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fan: int = 8, run: int = RUN
) -> DataFrame:
    """``docs`` without the later copies of a text; all columns, see :func:`exact_groups`.

    The rows are stored once with a number each, so that rows which share an id, or have
    none, are told apart.
    """
    number = "__row"
    while number in docs.columns:
        number += "_"
    stored = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = digests(stored, id_column, text_column, F.col(number))
    dropped = _groups(found, fan, run).where(~F.col("kept")).select(F.col("row").alias(number))
    return stored.join(dropped, number, "left_anti").drop(number)
