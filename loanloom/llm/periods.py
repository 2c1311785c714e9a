"""Passages that repeat themselves: maximal runs of a period in the words of a text.

Internal pattern matching: the words of a text are cut into dyadic blocks, and a block asks
for its next occurrence in the window beside it. The occurrences of a block are an interval of
the suffix array, so the answer is a range successor in a wavelet tree over that array.
Occurrences of a block in a window as long as itself are an arithmetic progression; its
difference is the candidate period, which is then stretched over the whole run and verified.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _classes(first: np.ndarray, text: np.ndarray, place: np.ndarray, left: np.ndarray, most: int):
    """Suffix array by doubling, and the blocks that occur again in their own text.

    ``first`` numbers the words, ``text`` and ``place`` say where each stands, ``left`` how
    many words of its text follow. Returns the places in suffix order, all suffixes of a text
    together, and for each dyadic length the blocks at multiples of half their length: word
    number, length, and the interval of the suffix array with the block's occurrences. Only
    blocks that occur twice are sorted any further.
    """
    n = len(first)
    order = np.argsort(text * (first.max() + 1) + first, kind="stable")
    key = text[order] * (first.max() + 1) + first[order]
    rank, size = np.empty(n, np.int64), np.empty(n, np.int64)
    slots, length = np.arange(n), 1
    blocks = []
    while True:
        # slots of the suffix array that are being sorted, in order, with equal keys side by side
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(head, len(key)))
        rank[order[slots]] = np.repeat(slots[head], count)
        size[order[slots]] = np.repeat(count, count)
        again = np.repeat(count > 1, count)
        slots = slots[again]
        if not len(slots):
            break
        open_ = order[slots]
        block = open_[place[open_] % max(1, length // 2) == 0]
        blocks.append((block, np.full(len(block), length), rank[block], rank[block] + size[block]))
        if length >= most:
            break
        follow = np.full(len(open_), -1)
        inside = left[open_] > length
        follow[inside] = rank[open_[inside] + length]
        key = rank[open_] * (n + 1) + follow + 1
        sort = np.argsort(key, kind="stable")
        order[slots], key = open_[sort], key[sort]
        length *= 2
    joined = [np.concatenate(c) if blocks else np.zeros(0, np.int64) for c in zip(*blocks)] or [np.zeros(0, np.int64)] * 4
    return order, joined


def _levels(values: np.ndarray):
    """Levels of a wavelet tree from the highest bit on: bit, zeros before each place, zeros in all.

    A level is made from the one above and given up when the next is asked for, so the tree
    never stands in memory whole.
    """
    for bit in range(max(1, int(values.max()).bit_length()) - 1, -1, -1):
        zero = (values >> bit) & 1 == 0
        before = np.concatenate([[0], np.cumsum(zero)])
        yield bit, before, int(before[-1])
        values = np.concatenate([values[zero], values[~zero]])


def successors(values: np.ndarray, low: np.ndarray, high: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The smallest of ``values[low:high]`` greater than ``above``, -1 without one; for many ranges."""
    if not len(low):
        return np.zeros(0, np.int64)
    a, b = low.copy(), high.copy()
    count = np.zeros(len(low), np.int64)
    bound = above + 1  # values below it do not count; it may need one bit more than the values
    whole = bound > values.max()
    count[whole] = (b - a)[whole]
    for bit, before, zeros in _levels(values):
        zero_a, zero_b = before[a], before[b]
        one = ((bound >> bit) & 1 == 1) & ~whole
        count[one] += (zero_b - zero_a)[one]
        a = np.where(one, zeros + a - zero_a, zero_a)
        b = np.where(one, zeros + b - zero_b, zero_b)
    found = count < high - low
    a, b, k = low[found], high[found], count[found]
    value = np.zeros(len(a), np.int64)
    for bit, before, zeros in _levels(values):
        zero_a, zero_b = before[a], before[b]
        one = k >= zero_b - zero_a
        k = np.where(one, k - (zero_b - zero_a), k)
        value |= one.astype(np.int64) << bit
        a = np.where(one, zeros + a - zero_a, zero_a)
        b = np.where(one, zeros + b - zero_b, zero_b)
    out = np.full(len(low), -1)
    out[found] = value
    return out


def _agreeing(word: np.ndarray, at: int, other: int, step: int, most: int) -> int:
    """How many of up to ``most`` words from ``at`` and ``other`` on agree, going by ``step``."""
    done, chunk = 0, 64
    while done < most:
        chunk = min(2 * chunk, most - done)
        if step > 0:
            same = word[at + done : at + done + chunk] == word[other + done : other + done + chunk]
        else:
            same = (word[at - done - chunk + 1 : at - done + 1] == word[other - done - chunk + 1 : other - done + 1])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done += chunk
    return done


def find_runs(word: np.ndarray, bounds: np.ndarray, exponent: int = 4, least: int = 6):
    """Runs of every text: first word (counted over all texts), word after the last, period.

    ``word`` numbers the words of all texts, end to end; text t has ``bounds[t]:bounds[t + 1]``.
    A run of period q is at least ``max(least, exponent * q)`` words long, ``exponent`` 4 or more.

    For q there is a dyadic length m with m / 2 < q <= m. Among the first q - 1 words of the run
    stands a multiple of m / 2, and the block of m words there and its copy q words on end
    within 4 * q - 3 words. As the block spans the period once or more, it does not occur
    between the two: the next occurrence is q words on. So no run is missed.
    """
    empty = np.zeros(0, np.int64)
    if exponent < 4:
        raise ValueError("runs of an exponent under 4 can hide from the blocks")
    if len(word) < least:
        return empty, empty, empty
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(word)) - bounds[text]
    left = sizes[text] - place
    order, (block, length, low, high) = _classes(word, text, place, left, int(sizes.max()) // exponent)
    after = successors(place[order], low, high, place[block])
    period = after - place[block]
    good = (after >= 0) & (period <= length)
    begin, period = block[good], period[good]
    end = begin + length[good] + period
    # stretches of one period that share a whole period belong to the same run
    sort = np.lexsort((begin, period))
    begin, end, period = begin[sort], end[sort], period[sort]
    if not len(begin):
        return empty, empty, empty
    shift = period * (len(word) + 1)  # keeps the running maximum inside one period
    reach = np.maximum.accumulate(end + shift) - shift
    fresh = np.ones(len(begin), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (begin[1:] + period[1:] > reach[:-1])
    head = np.flatnonzero(fresh)
    begin, period = begin[head], period[head]
    end = reach[np.append(head[1:], len(fresh)) - 1]
    first, last = bounds[:-1][text[begin]], bounds[1:][text[begin]]
    for _ in range(8):  # most end within a few words; the others are stretched one by one
        more = begin > first
        more[more] = word[begin[more] - 1] == word[begin[more] - 1 + period[more]]
        begin = begin - more
        more = end < last
        more[more] = word[end[more]] == word[end[more] - period[more]]
        end = end + more
    for i in np.flatnonzero((begin > first) | (end < last)).tolist():
        a, b, q = int(begin[i]), int(end[i]), int(period[i])
        begin[i] = a - _agreeing(word, a - 1, a - 1 + q, -1, a - int(first[i]))
        end[i] = b + _agreeing(word, b, b - q, 1, int(last[i]) - b)
    whole = end - begin >= np.maximum(least, exponent * period)
    runs = np.unique(np.stack([begin[whole], period[whole], end[whole]], axis=1), axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def _join(data: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray, texts: int) -> pa.Array:
    """The words of each text joined by one blank."""
    size = end - start + 1
    offsets = np.concatenate([[0], np.cumsum(size)])
    source = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    blank = offsets[1:] - 1
    source[blank] = 0
    joined = data[source] if len(data) else np.zeros(0, np.uint8)
    joined[blank] = 0x20
    bounds = np.searchsorted(owner, np.arange(texts + 1))
    begin, stop = offsets[bounds[:-1]], offsets[bounds[1:]]
    keep = np.ones(len(joined), bool)
    full = stop > begin
    keep[stop[full] - 1] = False  # no blank after the last word
    cut = np.concatenate([[0], np.cumsum(np.where(full, stop - begin - 1, 0))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        texts, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(joined[keep]))
    ).cast(pa.string())


def _runs(batches, exponent, least):
    for batch in arrays.pieces(batches, "text"):
        data, at = arrays.flat(batch.column(1))
        start, end, owner = arrays.words(data, at)
        word, _ = arrays.distinct_spans(data, start, end)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        begin, stop, period = find_runs(word, bounds, exponent, least)
        text = owner[begin]
        change = np.zeros(len(word) + 1, np.int64)
        np.add.at(change, begin + period, 1)
        np.add.at(change, stop, -1)
        kept = np.cumsum(change[:-1]) == 0
        runs = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in (begin - bounds[text], stop - begin, period)],
                ["start", "length", "period"],
            ),
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(np.diff(bounds), pa.int64()), runs,
                _join(data, start[kept], end[kept], owner[kept], batch.num_rows),
            ],
            ["id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    exponent: int = 4,
    least: int = 6,
) -> DataFrame:
    """Runs of repeated words in every whole text; a row per document.

    Returns the id, ``n_words``, ``runs`` (array of start, length and period in words, by
    start, then period) and ``collapsed``: the words that no run repeats, joined by one blank.
    Words stand between ASCII white space. A run is a stretch of words with smallest period q
    (words q apart are identical) of at least ``max(least, exponent * q)`` words, which no word
    beside it continues. A word goes when a run holds it after that run's first q words.

    Each document is looked at by itself in one task, several of them at a time; nothing is
    shuffled, so copies and hot sources cost no more than other rows. A null or empty text, or one without
    words, has no runs and collapses to an empty text. Repeated rows and null ids each give their
    own row. A very long text is one unit of work: it takes about 250 bytes a word. Other
    columns are not read. An empty table gives no rows.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(
        partial(_runs, exponent=exponent, least=least),
        f"id {kind}, n_words long, runs {RUNS}, collapsed string",
    )
    return found.withColumnRenamed("id", id_column)
