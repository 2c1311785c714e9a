"""Near-duplicate documents by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.arrays import U64
from loanloom.llm.graph import connected_components
from loanloom.session import materialize


def sketch(items: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a non-empty set of 64-bit hashes, every one filled.

    In round i < size each item falls into a hashed bin with value i + u, u in [0, 1); in
    round size + b all items fall into bin b. A bin keeps its smallest value, so only
    bins that are still empty can change in a later round, and 2 * size rounds fill all.
    Two sets agree in a coordinate with probability equal to their Jaccard similarity,
    and the share of equal coordinates is concentrated around it.
    """
    out = np.full(size, np.iinfo(np.int64).max, np.int64)
    at_once = max(1, 3000 // len(items))
    for first in range(0, size, at_once):
        turn = np.arange(first, min(first + at_once, size), dtype=U64)
        h = arrays.mix(items[None, :] ^ arrays.mix(turn * U64(0x9E3779B97F4A7C15) + U64(1))[:, None])
        value = ((h & U64(0xFFFFFFFF)) | (turn << U64(32))[:, None]).astype(np.int64)
        np.minimum.at(out, ((h >> U64(33)) % U64(size)).astype(np.int64).ravel(), value.ravel())
        if out.max() < np.iinfo(np.int64).max:
            return out
    for b in np.flatnonzero(out == np.iinfo(np.int64).max):
        h = arrays.mix(items ^ arrays.mix(np.array([size + b], U64))[0])
        out[b] = int((h & U64(0xFFFFFFFF)).min()) | (size + int(b)) << 32
    return out


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of neighbouring coordinates; the band's number is part of it."""
    cells = arrays.mix(coordinates.astype(U64)).reshape(bands, -1)
    key = np.arange(bands, dtype=U64)
    for column in cells.T:
        key = arrays.mix(key * U64(0x9E3779B97F4A7C15) + column)
    return key


def _class(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _sketches(batches, text, width, bands, rows):
    for batch in arrays.pieces(batches, text):
        sets = arrays.shingles(batch.column(batch.schema.get_field_index(text)), width)
        keys = [band_keys(sketch(s, bands * rows), bands).view(np.int64) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(i) for i, n in enumerate(batch.schema.names) if n != text],
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_class(s) for s in sets], pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            ["row", "id", "n", "class", "keys"],
        )


def _sets(batches, text, width):
    for batch in arrays.pieces(batches, text):
        sets = arrays.shingles(batch.column(batch.schema.get_field_index(text)), width)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_class(s) for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            ["class", "items"],
        )


def _pairs(met: DataFrame) -> DataFrame:
    """Different pairs (a, b) of classes with the components that they are in."""
    turned = F.col("node") > F.col("pivot")
    return met.select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"),
        F.when(turned, F.col("home")).otherwise(F.col("component")).alias("ca"),
        F.when(turned, F.col("component")).otherwise(F.col("home")).alias("cb"),
    ).distinct()


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows: int = 6,
    pivot_rounds: int = 3,
) -> DataFrame:
    """Components of documents whose shingle sets are ``percent`` similar or more.

    Returns a row per document: the id, ``n_shingles``, ``component_id`` (smallest id that
    links reach, its own included) and ``kept`` (the id is the component's). Shingles are
    ``width`` words, A-Z as a-z, of the whole text.

    1. Documents of equal sets are one class; only classes are compared.
    2. Each class gets a sketch of ``bands * rows`` coordinates. Classes that share a band
       are candidates: at similarity s a pair is missed with probability
       ``(1 - s**rows)**bands``, 5e-6 at 0.8 and less above.
    3. In a bucket, each member is verified on full sets against one pivot; links carry the
       smaller component's name two steps on. Members that are still in different components
       meet another pivot. After ``pivot_rounds`` the classes in buckets that still hold
       several components are joined by the rarest shingles of each, as many as similar sets
       cannot all differ in. A pair inside one component cannot change the result, so no
       candidate link is lost, and a group of copies costs rows in proportion to its size.
    4. Union-find over all links gives the components.

    Null text is empty: no shingles, no links. A null id links like any other but is never
    the smallest while the component has another; rows of one id share its result when
    their sets are equal. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = materialize(
        source.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(
            partial(_sketches, text="text", width=width, bands=bands, rows=rows),
            f"row long, id {kind}, n long, class binary, keys array<long>",
        ),
        "sketches",
    )
    classes = materialize(
        signed.where("n > 0")
        .groupBy("class")
        .agg(F.min(F.struct("row", "n", "keys")).alias("first"), F.min("id").alias("low"))
        .select("class", "low", F.col("first.row").alias("node"), "first.n", "first.keys"),
        "classes",
    )
    entries = classes.select("node", "n", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("pivot"))
    buckets = materialize(
        entries.join(shared.where("m > 1").select("key"), "key").select("key", "node", "n"), "buckets"
    )
    wanted = classes.join(buckets.select("node").distinct(), "node").select("low", "class", "node")
    items = materialize(
        source.join(wanted.select("low").distinct(), F.col("id").eqNullSafe(F.col("low")), "left_semi")
        .select("text")
        .mapInArrow(partial(_sets, text="text", width=width), "class binary, items array<long>")
        .groupBy("class")
        .agg(F.first("items").alias("items"))
        .join(wanted.select("class", "node"), "class")
        .select("node", "items"),
        "sets",
    )

    def linked(pairs: DataFrame) -> DataFrame:
        left = items.select(F.col("node").alias("a"), F.col("items").alias("x"))
        right = items.select(F.col("node").alias("b"), F.col("items").alias("y"))
        common = F.size(F.array_intersect("x", "y"))
        rows_ = pairs.join(left, "a").join(right, "b").withColumn("common", common)
        union = F.size("x") + F.size("y") - F.col("common")
        return rows_.where(100 * F.col("common") >= percent * union).select("a", "b", "ca", "cb")

    def fits(size: str, other: str):
        # |A & B| >= s |A u B| needs |A & B| >= s (|A| + |B|) / (1 + s)
        return (100 + percent) * F.least(size, other) >= percent * (F.col("n") + F.col("pivot_n"))

    def merged(left: DataFrame, fresh: DataFrame) -> DataFrame:
        """The entries under the names that links between components give, two steps along them."""
        step = fresh.groupBy(F.greatest("ca", "cb").alias("component")).agg(F.min(F.least("ca", "cb")).alias("to"))
        next_ = step.select(F.col("component").alias("to"), F.col("to").alias("further"))
        names = step.join(next_, "to", "left").select("component", F.coalesce("further", "to").alias("to"))
        mapped = left.join(names, "component", "left").select(
            "key", "node", "n", F.coalesce("to", "component").alias("component")
        )
        several = mapped.groupBy("key").agg(
            F.min("component").alias("c0"), F.max("component").alias("c1")
        ).where("c0 < c1").select("key")
        return materialize(mapped.join(several, "key"), "open")

    links = checked = spark.createDataFrame([], "a long, b long")
    current = buckets.withColumn("component", F.col("node"))
    for turn in range(pivot_rounds):
        order = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
        pivots = current.groupBy("key").agg(
            F.min(F.struct(order.alias("o"), "node", "n", "component")).alias("p")
        ).select(
            "key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"),
            F.col("p.component").alias("home"),
        )
        # the pivot leaves its bucket: whoever could be linked with it has met it now
        met = materialize(current.join(pivots, "key").where("node <> pivot"), "met")
        apart = met.where((F.col("component") != F.col("home")) & fits("n", "pivot_n"))
        pairs = materialize(_pairs(apart).join(checked, ["a", "b"], "left_anti"), "pairs")
        fresh = materialize(linked(pairs), "links")
        checked, links = checked.union(pairs.select("a", "b")), links.union(fresh.select("a", "b"))
        current = merged(met.select("key", "node", "n", "component"), fresh)
        if current.isEmpty():
            break
    else:
        # Two sets that are similar enough share one of their first shingles, when both are in
        # one order, rarest first: |A & B| >= s |A|, so not all of the first |A| - s |A| + 1 can be
        # outside B. Shingles of one open class lead to nothing and only count as places.
        nodes = current.groupBy("node").agg(F.first("n").alias("n"), F.first("component").alias("component"))
        mine = nodes.join(items, "node").select("node", "n", "component", F.explode("items").alias("item"))
        spread = mine.groupBy("item").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        of_node = Window.partitionBy("node")
        place = F.col("n") - F.count(F.lit(1)).over(of_node) + F.row_number().over(of_node.orderBy("m", "item"))
        first = materialize(
            mine.join(spread, "item").withColumn("place", place)
            .where(F.col("place") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1)
            .select("item", "node", "n", "component", (F.col("n") - F.col("place") + 1).alias("left")),
            "shared",
        )
        other = first.select(
            "item", F.col("node").alias("pivot"), F.col("n").alias("pivot_n"),
            F.col("component").alias("home"), F.col("left").alias("pivot_left"),
        )
        # at the first shingle that both have, what is left of the shorter rest bounds their common part
        enough = (100 + percent) * F.least("left", "pivot_left") >= percent * (F.col("n") + F.col("pivot_n"))
        met = first.join(other, "item").where(
            (F.col("node") > F.col("pivot")) & (F.col("component") != F.col("home")) & fits("n", "pivot_n") & enough
        )
        pairs = materialize(_pairs(met).join(checked, ["a", "b"], "left_anti"), "pairs")
        links = links.union(materialize(linked(pairs), "links").select("a", "b"))
    found = materialize(connected_components(links), "components")

    named = classes.select("class", "node", "low").join(found, "node", "left").select(
        "class", "low", F.coalesce("component", "node").alias("component")
    )
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "component").select("class", "component_id")
    rest = signed.where("n = 0").select(
        "id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id")
    )
    joined = signed.where("n > 0").select("id", "n", "class").join(named, "class", "left").select(
        "id", F.col("n").alias("n_shingles"), "component_id"
    )
    return joined.union(rest).select(
        F.col("id").alias(id_column), "n_shingles", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component of :func:`near_duplicates`; all columns.

    The smallest id stays, null after all others, then by reading order. The rows are
    stored once with a number each, so rows that share an id are told apart.
    """
    number = "__row"
    while number in docs.columns:
        number += "_"
    stored = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    name = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col(number).alias("row"))
    found = near_duplicates(stored.select(name.alias("name"), F.col(text_column).alias("text")), "name", "text", **options)
    dropped = found.where(~F.col("kept")).select(F.col("name.row").alias(number))
    return stored.join(dropped, number, "left_anti").drop(number)
