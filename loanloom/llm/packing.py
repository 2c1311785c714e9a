"""Packing token sequences into windows of fixed length by best-fit decreasing."""

from __future__ import annotations

import os
import unicodedata
import zlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.segments import SegmentEncoder
from loanloom.session import materialize

#: The classes of the tokenizer's split pattern and its contractions.
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


@lru_cache(maxsize=1)
def _classes(limit: int = 0x250) -> np.ndarray:
    """Class of every code point below ``limit`` by its Unicode category."""
    out = np.full(limit, OTHER, np.uint8)
    for code in range(limit):
        kind = unicodedata.category(chr(code))
        if kind[0] in "LN":
            out[code] = LETTER if kind[0] == "L" else NUMBER
        elif chr(code).isspace() and not 0x1C <= code <= 0x1F:
            out[code] = SPACE
    return out


def split_words(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Starts of the words that the byte-level pattern splits texts into.

    ``codes`` holds the code points of all texts end to end, ``at`` where each begins and the
    end. Runs of letters, numbers, white space or other characters; one blank before a run
    other than white space belongs to it; the last character of a white-space run that is
    followed by something stands alone or is that blank; contractions are cut off. Nothing
    crosses the border of two texts.
    """
    kind = _classes()[codes]
    n = len(codes)
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    border = np.zeros(n + 1, bool)
    border[at] = True
    inner = np.flatnonzero(start & ~border[:-1])
    # the last white-space character before another run
    tail = inner[kind[inner - 1] == SPACE] - 1
    start |= border[:-1]
    start[tail] = True
    blank = tail[codes[tail] == 0x20]
    start[blank + 1] = False
    quote = np.flatnonzero(start & (codes == 0x27))
    left = at[np.searchsorted(at, quote, side="right")] - quote  # characters to the text's end
    after = np.concatenate([codes, np.zeros(2, codes.dtype)])
    for word in CONTRACTIONS:
        size = len(word)
        mine = left >= size
        for k in range(1, size):
            mine &= after[quote + k] == ord(word[k])
        hit = quote[mine]
        for k in range(1, size):
            start[hit + k] = False
        end = hit[left[mine] > size] + size
        start[end[kind[end] == LETTER]] = True
    return np.flatnonzero(start)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    encoder = SegmentEncoder(
        lambda texts: [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)]
    )
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    return whole, encoder, special


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and where each text's ids begin.

    A text with a special token's string or a character outside the range whose classes
    are the same in every Unicode version is encoded whole; the ids are the same.
    """
    whole, encoder, special = _tokenizer(path)
    data, at = arrays.flat(texts)
    raw, n, by_hand = data.tobytes(), len(texts), {}
    codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    chars = np.searchsorted(place, at)
    hard = np.searchsorted(chars, np.flatnonzero(codes >= len(_classes())), side="right") - 1
    odd = set(hard.tolist())
    for name in (s.encode() for s in special):
        if name in raw:
            odd |= {i for i in range(n) if name in raw[at[i] : at[i + 1]]}
    if odd:
        for i in sorted(odd):
            text = raw[at[i] : at[i + 1]].decode("utf-8")
            by_hand[i] = np.array(whole.encode(text, add_special_tokens=False).ids, np.int32)
        plain = np.ones(n, bool)
        plain[list(odd)] = False
        data = data[np.repeat(plain, np.diff(at))]
        codes = codes[np.repeat(plain, np.diff(chars))]
        place = np.flatnonzero((data & 0xC0) != 0x80)
        chars = np.concatenate([[0], np.cumsum(np.where(plain, np.diff(chars), 0))])
    if len(codes):
        first = split_words(codes, chars)
        begin = place[first]
        ids, count = encoder(data, begin, np.append(begin[1:], len(data)))
        total = np.concatenate([[0], np.cumsum(count)])
        sizes = np.diff(total[np.searchsorted(first, chars)])
    else:
        ids, sizes = np.zeros(0, np.int32), np.zeros(n, np.int64)
    if by_hand:
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i, found in by_hand.items():
            parts[i] = found
        ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
    return ids, np.concatenate([[0], np.cumsum(sizes)])


def _cut(batches, path, window, end_id, with_ids):
    """Pieces of at most ``window`` ids; ``nth`` counts pieces of a length in this task."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    seen: dict[int, int] = {}
    for batch in arrays.pieces(batches, "text", 1 << 20):
        ids, at = token_ids(batch.column(1), path)
        rows: list[tuple] = []
        for doc, a, b in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            mine = np.append(ids[a:b], end_id).astype("<u4")
            for first in range(0, len(mine), window):
                piece = mine[first : first + window]
                k = seen.get(len(piece), 0)
                seen[len(piece)] = k + 1
                rows.append((doc, first, len(piece), zlib.crc32(piece.tobytes()), len(mine), part, k,
                             piece.astype(np.int32) if with_ids else None))
        columns = list(zip(*rows))
        kinds = [batch.schema.field(0).type, *[pa.int64()] * 6, pa.list_(pa.int32())]
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth", "ids"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class TightestFit:
    """Segment tree over remaining capacities: the smallest open one that is large enough."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, windows: int) -> None:
        at = self.leaves + capacity
        while at:
            self.open[at] += windows
            at //= 2

    def find(self, need: int) -> int | None:
        """Smallest capacity >= ``need`` with an open window."""
        at = self.leaves + need
        if self.open[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: runs ``(length, first, count, sequence, offset, each)``.

    Pieces number ``first`` to ``first + count - 1`` of that length go, ``each`` at a time,
    into consecutive sequences from ``sequence`` on, at ``offset``. Longest pieces come
    first and each takes the tightest open window. Windows that were filled alike stay one
    group, so the work and the number of runs depend on the window, not on the pieces.
    """
    tree, groups, runs, sequences = TightestFit(window), {}, [], 0
    for length in sorted(counts, reverse=True):
        left, done = counts[length], 0
        while left:
            room = tree.find(length)
            if room is None:
                room, each = window, window // length
                windows = -(-left // each)
                first, sequences = sequences, sequences + windows
            else:
                first, windows = groups[room].pop()
                tree.add(room, -windows)
                each = room // length
            full = min(windows, left // each)
            if full:
                runs.append((length, done, full * each, first, window - room, each))
                tree.add(room - each * length, full)
                groups.setdefault(room - each * length, []).append((first, full))
                done, left = done + full * each, left - full * each
                first, windows = first + full, windows - full
            if windows and left:  # fewer pieces than one window takes
                runs.append((length, done, left, first, window - room, left))
                tree.add(room - left * length, 1)
                groups.setdefault(room - left * length, []).append((first, 1))
                first, windows, left = first + 1, windows - 1, 0
            if windows:
                tree.add(room, windows)
                groups.setdefault(room, []).append((first, windows))
    return runs


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 2048,
    end_id: int = 1,
    with_ids: bool = True,
) -> DataFrame:
    """Pack the tokens of all documents into sequences of at most ``window`` tokens.

    Returns a row per piece: the id, ``start`` (tokens of its document before it),
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and, if
    ``with_ids``, the token ``ids``. Every document ends with ``end_id``; one longer than
    a window is cut into full windows and a rest. Offsets have no gap. A sequence is
    padded to the window, or not at all where its length is a power of two.

    Best-fit decreasing looks only at lengths, and pieces of one length are alike: the
    counts per length (``window`` numbers at most) are packed on the driver, exactly as
    all pieces one by one would be, and each piece finds its place by its rank among those
    of its length. No task and no group holds all pieces.

    Null or empty text is the ``end_id`` alone. Ids may be null or repeat: pieces are told
    apart by where they were read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    cut = materialize(
        source.mapInArrow(
            partial(_cut, path=tokenizer, window=window, end_id=end_id, with_ids=with_ids),
            f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
            "part long, nth long, ids array<int>",
        ),
        "pieces",
    )
    # rank of a piece among its length: pieces of earlier parts, then its own number
    by_part = materialize(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    before = by_part.alias("x").select(
        "length", "part",
        (F.expr("sum(n) over (partition by length order by part)") - F.col("n")).alias("before"),
    )
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(
        best_fit_decreasing(counts, window),
        "length long, first long, count long, sequence long, at long, each long",
    )
    nth = F.col("before") + F.col("nth")
    inside = F.col("rank") - F.col("first")
    placed = (
        cut.join(before, ["length", "part"])
        .withColumn("rank", nth)
        .join(F.broadcast(runs), "length")  # a few runs per length, whatever the input
        .where((inside >= 0) & (inside < F.col("count")))
    )
    return placed.select(
        F.col("id").alias(id_column), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(inside / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (inside % F.col("each")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
