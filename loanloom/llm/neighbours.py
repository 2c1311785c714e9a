"""Nearest neighbours by inner product through an inverted multi-index."""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.session import materialize


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def centroids(points: np.ndarray, k: int, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Lloyd's k-means on distinct points; fewer centroids if there are fewer points."""
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    out = points[np.random.default_rng(seed).choice(len(points), k, replace=False)]
    for _ in range(rounds):
        near = _nearest(points, out)
        count = np.bincount(near, minlength=k)
        for d in range(points.shape[1]):
            total = np.bincount(near, weights=points[:, d], minlength=k)
            out[:, d] = np.where(count > 0, total / np.maximum(count, 1), out[:, d])
    return out


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1)[None] - 2 * points @ centres.T, 1)


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, target: int) -> list[int]:
    """Cells in order of summed distance until they hold ``target`` entries.

    ``first`` and ``second`` are a query's distances to the centroids of each half,
    ``sizes[i, j]`` the entries of cell (i, j). A heap holds the frontier of pairs, of
    which each is pushed when its neighbours before it have been taken.
    """
    rows, columns = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    a, b = first[rows].tolist(), second[columns].tolist()
    heap, out, total = [(a[0] + b[0], 0, 0)], [], 0
    taken = [0] * (len(a) + 1)  # how far each row has been taken
    while heap and total < target:
        _, i, j = heapq.heappop(heap)
        taken[i] = j + 1
        size = int(sizes[rows[i], columns[j]])
        if size:
            out.append(rows[i] * len(b) + columns[j])
            total += size
        # a pair enters when the pairs before it in its row and in its column are taken
        if j + 1 < len(b) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and taken[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return out


class Index:
    """Centroids of both halves; a cell is a pair of them."""

    def __init__(self, sample: np.ndarray, k: int):
        self.width, self.half = sample.shape[1], max(1, sample.shape[1] // 2)
        self.first = centroids(sample[:, : self.half], k)
        rest = sample[:, self.half :] if self.width > 1 else np.zeros((len(sample), 1))
        self.second = centroids(rest, k)

    def _halves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = points[:, self.half :] if self.width > 1 else np.zeros((len(points), 1))
        return points[:, : self.half], rest

    def cells(self, points: np.ndarray) -> np.ndarray:
        x, y = self._halves(points)
        return _nearest(x, self.first) * len(self.second) + _nearest(y, self.second)

    def distances(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For a search by inner product, distance is the inner product's negative."""
        x, y = self._halves(points)
        return -x @ self.first.T, -y @ self.second.T


def _assign(batches, index):
    index = index.value
    for batch in batches:
        if batch.num_rows:
            cells = index.cells(_matrix(batch.column(1), index.width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], ["id", "vector", "cell"])


def _probe(batches, plan):
    index, sizes, target, shard_of = plan.value
    for batch in batches:
        if not batch.num_rows:
            continue
        first, second = index.distances(_matrix(batch.column(2), index.width))
        for at in range(batch.num_rows):
            shards: dict[int, list[int]] = {}
            for cell in traverse(first[at], second[at], sizes, target):
                start, parts = shard_of[cell]
                for s in range(start, start + parts):
                    shards.setdefault(s, []).append(cell)
            one = batch.slice(at, 1)
            n = len(shards)
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array([0] * n, pa.int64())) for c in one.columns],
                 pa.array(list(shards), pa.int64()), pa.array(list(shards.values()), pa.list_(pa.int64()))],
                ["query", "own", "vector", "shard", "cells"],
            )


def _rerank(key, entries: pa.Table, queries: pa.Table, width, k, by_row=False):
    none = pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not entries.num_rows or not queries.num_rows:
        return none
    e, q = _matrix(entries["vector"], width), _matrix(queries["vector"], width)
    ids = entries["id"].to_numpy()
    names, cell = np.unique(entries["cell"].to_numpy(), return_inverse=True)
    probes = queries["cells"].combine_chunks()
    visited = probes.flatten().to_numpy()
    row = np.repeat(np.arange(len(q)), np.diff(probes.offsets.to_numpy()))
    place = np.searchsorted(names, visited)
    known = place < len(names)
    known[known] = names[place[known]] == visited[known]
    allowed = np.zeros((len(q), len(names)), bool)
    allowed[row[known], place[known]] = True
    out_q, out_id, out_s = [], [], []
    query, own = queries["query"].to_numpy(), queries["own"].to_numpy()
    with np.errstate(over="ignore"):
        longest = np.linalg.norm(e, axis=1).max()
    for first in range(0, len(q), 256):
        block = slice(first, first + 256)
        rough = q[block] @ e.T
        open_ = allowed[block][:, cell]
        same = own[block][:, None] == ids[None, :]
        if by_row:
            # one row of the query's id and vector is its own; equal ones share a cell and a shard
            mine, taken = np.zeros_like(same), set()
            for i, j in zip(*np.nonzero(same)):
                if i not in taken and (e[j] == q[first + i]).all():
                    mine[i, j] = True
                    taken.add(i)
            same = mine
        open_ &= ~same
        rough[~open_] = -np.inf
        for i in range(len(rough)):
            line = rough[i]
            n = int(open_[i].sum())
            if not n:
                continue
            # all that rounding could put among the k best, then the exact order
            least = np.partition(line, len(line) - k)[len(line) - k] if n > k else -np.inf
            with np.errstate(over="ignore", invalid="ignore"):
                slack = 1e-15 * width * np.linalg.norm(q[first + i]) * longest
                close = ~(line < least - slack)  # also where a sum is too large to tell
            near = np.flatnonzero(open_[i] & close if n > k else open_[i])
            exact = (e[near] * q[first + i]).sum(1)
            order = np.lexsort((ids[near], -exact))[:k]
            out_q.append(np.full(len(order), query[first + i]))
            out_id.append(ids[near][order])
            out_s.append(exact[order])
    if not out_q:
        return none
    return pa.table({"query": np.concatenate(out_q), "id": np.concatenate(out_id), "score": np.concatenate(out_s)})


def usable(vector: str):
    """Not null, not empty, not zero, and every component a finite number."""
    return F.expr(
        f"size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        f" and exists({vector}, x -> x <> 0)"
    )


def search(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 20,
    cells_per_half: int = 64,
    share: float = 0.5,
    sample_rows: int = 20_000,
    shard_rows: int = 8192,
    query_block: int = 1024,
    by_row: bool = False,
) -> DataFrame:
    """``k`` nearest ``vectors`` of each of ``queries`` by inner product, in double precision.

    Returns ``query_id``, ``rank`` (from 1), the id and ``score``. Ties go to the smaller
    id; a query is not its own neighbour: rows of its id are left out, or, ``by_row``, only one row of
    its id and vector. Both tables have the same columns.

    Each half of a vector is quantised by its own ``cells_per_half`` centroids, fitted on
    the ``sample_rows`` vectors with the smallest id hashes; every vector is indexed. A
    query takes centroid pairs by summed distance from a heap until their cells hold
    ``share`` of all distinct vectors, and all entries of these cells are reranked on the
    original vectors. ``share`` is the price of recall: vectors spread almost evenly over
    the sphere need a half for 0.94 of the true neighbours, clustered ones far less.

    Cells lie in shards of about ``shard_rows`` entries. A cell that is larger, such as
    one vector repeated in a third of all rows, is cut into several shards, and copies
    count once towards ``share``. A task holds one shard and ``query_block`` queries at
    most; entries are sent once per block of queries.

    Null or zero vectors, vectors with null or non-finite components, of another length
    than most, or without an id take no part, as queries or as candidates. Rows that share
    an id are candidates each; a repeated query row is answered again. Where a query has
    fewer candidates than ``k``, all come. Empty tables give no rows.
    """
    spark = vectors.sparkSession

    def rows(table: DataFrame) -> DataFrame:
        found = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
        return found.where(F.col("id").isNotNull() & usable("vector"))

    good = rows(vectors)
    width = good.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    empty = spark.createDataFrame([], f"query_id long, rank int, {id_column} long, score double")
    if width is None:
        return empty
    width = width["width"]
    good = good.where(F.size("vector") == width)
    sample = good.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").toPandas()
    index = Index(np.array(sample["vector"].tolist(), float), cells_per_half)
    entries = materialize(
        good.mapInArrow(
            partial(_assign, index=spark.sparkContext.broadcast(index)), "id long, vector array<double>, cell long"
        ).withColumn("same", F.xxhash64("vector")),
        "entries",
    )
    sizes = np.zeros((len(index.first), len(index.second)), np.int64)
    shard_of, shard, filled = {}, 0, 0
    # one row per non-empty cell, of which there are cells_per_half squared at most
    counted = entries.groupBy("cell", "same").agg(F.count(F.lit(1)).alias("n")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("n")
    )
    for r in sorted(counted.collect(), key=lambda r: r.cell):
        sizes[divmod(r.cell, len(index.second))] = r.distinct
        if filled and filled + r.n > shard_rows:
            shard, filled = shard + 1, 0
        parts = -(-r.n // shard_rows)
        shard_of[r.cell] = (shard, parts)
        shard, filled = (shard + parts, 0) if parts > 1 else (shard, filled + r.n)
    target = int(np.ceil(share * sizes.sum())) + k + 1
    placed = spark.createDataFrame(
        [(c, s, p) for c, (s, p) in shard_of.items()], "cell long, first long, parts long"
    )
    asked = rows(queries).where(F.size("vector") == width).select(
        F.monotonically_increasing_id().alias("query"), F.col("id").alias("own"), "vector"
    )
    asked = materialize(asked, "queries")
    blocks = max(1, -(-asked.count() // query_block))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks).cast("long"))
    probes = asked.mapInArrow(
        partial(_probe, plan=spark.sparkContext.broadcast((index, sizes, target, shard_of))),
        "query long, own long, vector array<double>, shard long, cells array<long>",
    ).withColumn("block", block)
    sharded = entries.join(F.broadcast(placed), "cell").select(
        "id", "vector", "cell", (F.col("first") + F.pmod(F.xxhash64("id"), "parts")).alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
    )
    near = (
        sharded.groupBy("shard", "block")
        .cogroup(probes.groupBy("shard", "block"))
        .applyInArrow(
            lambda key, left, right: _rerank(key, left, right, width, k, by_row), "query long, id long, score double"
        )
    )
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    best = near.withColumn("rank", order).where(F.col("rank") <= k)
    return best.join(asked.select("query", "own"), "query").select(
        F.col("own").alias("query_id"), "rank", F.col("id").alias(id_column), "score"
    )
