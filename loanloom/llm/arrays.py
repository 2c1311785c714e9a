"""Text columns as flat numpy arrays, and hashes over them, for use inside tasks.

A batch of texts becomes one byte array and one offset array; word, shingle and window
hashes are then array operations without a loop over characters or words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Base of the polynomial hash modulo 2**64; odd, so that it has an inverse.
BASE = 0x9E3779B97F4A7C15 | 3
INVERSE = pow(BASE, -1, 1 << 64)


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20):
    """Cut record batches so that ``column`` holds at most ``max_bytes`` in each.

    A single longer text is a piece of its own: texts are never cut here.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        # the sizes alone: a batch is far larger than a piece, and its texts are not copied for them
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0)
        first, total = 0, 0
        for i, size in enumerate(sizes.to_pylist()):
            if total and total + size > max_bytes:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += size
        yield batch.slice(first)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U64(31))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(29))
    x = x * U64(0xA0761D6478BD642F)
    return x ^ (x >> U64(32))


_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        for k, base in enumerate((BASE, INVERSE)):
            new = np.full(size, base, U64)
            new[0] = 1
            _POWERS[k] = np.multiply.accumulate(new)
    return _POWERS[0], _POWERS[1]


@lru_cache(maxsize=2)
def byte_values(fold_case: bool) -> np.ndarray:
    """A scrambled value per byte; with ``fold_case`` A-Z takes that of a-z."""
    codes = np.arange(256, dtype=U64)
    if fold_case:
        codes[65:91] += U64(32)
    return mix((codes + U64(1)) * U64(0x9FB21C651E98DF25))


def prefix_hash(data: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` gives any span's hash from it."""
    power, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(byte_values(fold_case)[data] * power[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span; equal bytes give equal hashes wherever they stand."""
    _, inverse = powers(len(prefix))
    raw = (prefix[end] - prefix[start]) * inverse[start]
    return mix(raw + (end - start).astype(U64) * U64(0x2545F4914F6CDD1D))


def window_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """``span_hash`` of every ``width``-byte string, in order."""
    _, inverse = powers(len(prefix))
    n = len(prefix) - width
    return mix((prefix[width:] - prefix[:n]) * inverse[:n] + U64(width * 0x2545F4914F6CDD1D & 2**64 - 1))


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """``span_hash`` of spans in order of their begin, over a block of ``data`` at a time."""
    out = np.zeros(len(begin), U64)
    at = 0
    while at < len(begin):
        first = int(begin[at])
        stop = max(at + 1, int(np.searchsorted(begin, first + block)))
        last = int(end[at:stop].max())
        out[at:stop] = span_hash(prefix_hash(data[first:last]), begin[at:stop] - first, end[at:stop] - first)
        at = stop
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


#: Bytes below 0x80 other than 0-9 and a-z stand between plain words.
PLAIN = np.ones(256, bool)
PLAIN[:0x30] = PLAIN[0x3A:0x61] = PLAIN[0x7B:0x80] = False
#: A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(
    data: np.ndarray, at: np.ndarray, letters: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than ASCII white space, and its text's number.

    ``letters`` marks the bytes that make a word, where it is something else.
    """
    inside = ~_SPACE[data] if letters is None else letters[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = at[(at > 0) & (at < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(at, start, side="right") - 1


def distinct_spans(
    data: np.ndarray, start: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """A number per span, the same for equal bytes only, and the bytes behind each number."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    if len(start) and np.array_equal(start[1:], end[:-1]):  # without gaps
        joined = data[start[0] : end[-1]]
    else:
        joined = data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
    spans = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(joined))]
    ).dictionary_encode()
    return spans.indices.to_numpy(zero_copy_only=False).astype(np.int64), spans.dictionary


def digests(number: np.ndarray, distinct: pa.LargeBinaryArray) -> np.ndarray:
    """A 64-bit digest of each span's bytes, from :func:`distinct_spans`."""
    raw = b"".join(blake2b(s, digest_size=8).digest() for s in distinct.to_pylist())
    return np.frombuffer(raw, U64)[number]


def shingles(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of ``width``-word shingles of every text, A-Z as a-z.

    A text of fewer words gives one shingle of all its words; without words, none. Words
    are told apart by their bytes and hashed by a digest, so unlike words, however long,
    do not meet by construction.
    """
    data, at = flat(texts)
    data = LOWER[data]
    start, end, owner = words(data, at)
    word = digests(*distinct_spans(data, start, end))
    bounds = np.searchsorted(owner, np.arange(len(at)))
    joined = word.copy()
    for k in range(1, width):
        joined[:-k] = joined[:-k] * U64(0xC2B2AE3D27D4EB4F) + word[k:] if k < len(word) else 0
    joined = mix(joined)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(joined[a : b - width + 1]))
        elif b > a:
            short = np.array([b - a], U64)
            for k in range(a, b):
                short = mix(short * U64(3) + word[k : k + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, U64))
    return out
