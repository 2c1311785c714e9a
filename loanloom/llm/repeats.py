"""Repeated passages by the common-prefix interval tree of an enhanced suffix array."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.arrays import U64
from loanloom.session import materialize

LAST = np.iinfo(np.int64).max
#: Most windows in one stretch; only repetitive text reaches it.
LONGEST = 64
#: Bytes of text whose windows are hashed at once: the arrays stay in a core's cache.
BLOCK = 1 << 16
#: Bytes of text that are stored, asked about and answered together.
PIECE = 4 << 20
#: Answer for a minimiser that has too much different text for one slice.
HEAVY = 2
#: Bytes of text whose minimisers share a bucket, on average.
BUCKET_BYTES = 8 << 20


def _window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def stretches(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser: first byte, end, text number, minimiser and hash.

    The smallest hash of a window's ``gram``-byte strings depends on the window alone, so
    equal windows anywhere have the same one. Windows that overlap mostly share it, and
    such a run is sent as one string of its windows' bytes.
    """
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, U64))
    prefix = arrays.prefix_hash(data)
    low = _window_minimum(arrays.window_hash(prefix, gram), length - gram + 1)
    # a window that begins less than its length before a border is in no text
    cuts = np.unique(at[(at > 0) & (at < len(data))])
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, np.maximum(cuts - length + 1, 0).clip(max=n), 1)
    np.add.at(step, cuts.clip(max=n), -1)
    inside = np.cumsum(step[:n], dtype=np.int32) == 0
    edge = low[1:] != low[:-1]
    edge[cuts[cuts < n] - 1] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge
    begin = np.flatnonzero(first)
    # repetitive text keeps one minimiser for long: cut it
    begin, windows = _cut_long(begin, np.flatnonzero(last) - begin + 1)
    end = begin + windows - 1 + length
    owner = np.searchsorted(at, begin, side="right") - 1
    return begin, end, owner, low[begin], arrays.span_hash(prefix, begin, end)


def _cut_long(begin: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same runs of windows, none of more than ``LONGEST``."""
    if not len(windows) or windows.max() <= LONGEST:
        return begin, windows
    parts = -(-windows // LONGEST)
    part = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(begin, parts) + part * LONGEST, np.minimum(np.repeat(windows, parts) - part * LONGEST, LONGEST)


def gather(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of all spans end to end."""
    size = end - begin
    shift = np.repeat(begin - (np.cumsum(size) - size), size)
    return data[shift + np.arange(len(shift))]


def _zip(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values).tobytes())


def _unzip(packed: list[bytes], kind) -> np.ndarray:
    open_ = zstandard.ZstdDecompressor()
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(open_.decompress(x), kind) for x in packed)])


def _store(batches):
    """Texts end to end in pieces of about ``PIECE`` bytes, with their keys; a longer text is one alone."""
    from pyspark import TaskContext

    name = TaskContext.get().partitionId() << 33
    held, size = [], 0

    def piece():
        texts = pa.Table.from_batches(held).combine_chunks()
        data, at = arrays.flat(texts.column("text").chunk(0))
        key, document = (texts.column(c).to_numpy() for c in ("key", "document"))
        return pa.RecordBatch.from_pydict({
            "piece": [name], "n_bytes": [len(data)], "keys": [_zip(key)], "documents": [_zip(document)],
            "lengths": [_zip(np.diff(at))], "bytes": [_zip(data)],
        })

    for batch in batches:
        for part in arrays.pieces([batch], "text", PIECE):
            more = int(arrays.flat(part.column(2))[1][-1])
            if held and size + more > PIECE:
                yield piece()
                held, size, name = [], 0, name + 1
            held.append(part)
            size += more
    if held:
        yield piece()


class Piece:
    """The texts of one stored piece and the strings of their windows."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        def column(name):
            return batch.column(batch.schema.get_field_index(name))[row].as_py()

        self.column, self.name = column, column("piece")
        self.key, self.document = (_unzip([column(c)], np.int64) for c in ("keys", "documents"))
        self.at = np.concatenate([[0], np.cumsum(_unzip([column("lengths")], np.int64))])
        self.data = _unzip([column("bytes")], np.uint8)

    def strings(self, length: int, gram: int):
        """Begin, end, text number, minimiser and hash of each stretch, about ``BLOCK`` bytes of text at a time."""
        cut = np.append(np.flatnonzero(np.diff(self.at[:-1] // BLOCK, prepend=-1)), len(self.at) - 1)
        found = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, U64)] * 2]
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            first = self.at[a]
            data = self.data[first : self.at[b]]
            begin, end, owner, low, text = stretches(data, self.at[a : b + 1] - first, length, gram)
            found.append((begin + first, end + first, owner + a, low, text))
        return [np.concatenate(c) for c in zip(*found)]

    def shared_strings(self, length: int, gram: int, buckets: int, slices: int):
        """Begin, end, text number, hash, slice and minimiser of those stretches whose minimiser
        other texts have too, by the answers to :func:`_ask`.

        Windows of a heavy minimiser go to slices by their own hash, so that no slice gets all of them.
        """
        found = self.strings(length, gram)
        names, back = np.unique(found[3], return_inverse=True)
        code = np.zeros(len(names), np.uint8)
        answers = sorted((r["bucket"], r["codes"]) for r in self.column("known") or ())
        code[np.argsort(arrays.mix(names) % U64(buckets), kind="stable")] = _unzip([c for _, c in answers], np.uint8)
        code = code[back]
        begin, end, owner, low, text = (x[code > 0] for x in found)
        code = code[code > 0]
        slot = (arrays.mix(low) % U64(slices)).astype(np.int64)
        hot = code == HEAVY
        if hot.any():
            alone = self._by_window(begin[hot], end[hot], owner[hot], low[hot], length, slices)
            begin, end, owner, text, slot, low = (
                np.concatenate([x[~hot], y]) for x, y in zip((begin, end, owner, text, slot, low), alone)
            )
        return begin, end, owner, text, slot, low

    def _by_window(self, begin, end, owner, low, length: int, slices: int):
        """The stretches cut where the slice of a window's own hash changes."""
        start, of = _ranges(begin, end - begin - length + 1)
        slot = (arrays.mix(arrays.hash_spans(self.data, start, start + length)) % U64(slices)).astype(np.int64)
        head = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(slot, prepend=-1) != 0))
        first = start[head]
        stop = first + np.diff(np.append(head, len(start))) - 1 + length
        text = arrays.hash_spans(self.data, first, stop)
        return first, stop, owner[of[head]], text, slot[head], low[of[head]]


def _rows(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            yield Piece(batch, row)


def _ask(batches, length, gram, buckets):
    """Per piece and bucket of minimisers: 32 bits of each, its windows in different strings, and if several texts have it."""
    for piece in _rows(batches):
        begin, end, owner, low, text = piece.strings(length, gram)
        if not len(low):
            continue
        order = np.lexsort((text, low))
        low, text, owner, windows = low[order], text[order], owner[order], (end - begin)[order] - length + 1
        head = np.flatnonzero(np.diff(low, prepend=low[0] - U64(1)))
        windows[1:][(text[1:] == text[:-1]) & (low[1:] == low[:-1])] = 0
        several = np.minimum.reduceat(owner, head) < np.maximum.reduceat(owner, head)
        weight = 2 * np.add.reduceat(windows, head) + several
        mixed = arrays.mix(low[head])
        bucket = (mixed % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        prints, weight, bucket = (mixed >> U64(32)).astype(np.uint32)[order], weight[order], bucket[order]
        cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        spans = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array([piece.name] * len(spans), pa.int64()), "bucket": pa.array(bucket[cut[:-1]]),
            "prints": [_zip(prints[a:b]) for a, b in spans], "weights": [_zip(weight[a:b]) for a, b in spans],
        })


def _answer(table: pa.Table, length: int, slice_bytes: int) -> pa.Table:
    """To every piece: which minimisers stand in one text alone (0), in several, or are heavy."""
    prints = [_unzip([x], np.uint32) for x in table["prints"].to_pylist()]
    weight = _unzip(table["weights"].to_pylist(), np.int64)
    _, back = np.unique(np.concatenate(prints), return_inverse=True)
    several = np.bincount(back) + np.bincount(back, weight & 1) > 1
    windows = np.bincount(back, weight >> 1)
    heavy = several & (windows * length > slice_bytes)
    code = np.where(heavy, HEAVY, several).astype(np.uint8)[back]
    n = table.num_rows
    return pa.table({
        "piece": table["piece"], "bucket": table["bucket"],
        "codes": pa.array([_zip(c) for c in np.split(code, np.cumsum([len(p) for p in prints])[:-1])], pa.binary()),
        "windows": np.array([int(windows[heavy].sum())] + [0] * (n - 1), np.int64),
    })


def _spread(batches, length, gram, buckets, slices):
    """The different shared strings of a piece with their smallest and largest key, per slice."""
    for piece in _rows(batches):
        begin, end, owner, text, slot, low = piece.shared_strings(length, gram, buckets, slices)
        if not len(begin):
            continue
        order = np.lexsort((text, low, slot))  # strings of one minimiser compress well together
        begin, end, owner, text, slot = (x[order] for x in (begin, end, owner, text, slot))
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (slot[1:] != slot[:-1])
        head = np.flatnonzero(new)
        key = piece.key[owner]
        least, most = np.minimum.reduceat(key, head), np.maximum.reduceat(key, head)
        begin, end, slot = begin[head], end[head], slot[head]
        cut = np.append(np.flatnonzero(np.diff(slot, prepend=-1)), len(slot))
        rows = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            columns = (
                gather(piece.data, begin[a:b], end[a:b]), (end - begin)[a:b].astype(np.int32), least[a:b], most[a:b]
            )
            rows.append((int(slot[a]), piece.name, *map(_zip, columns)))
        names = ["slice", "piece", "bytes", "lengths", "least", "most"]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _words(data: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one number, in lexical order; 0 past the stop."""
    out = np.zeros(len(at), U64)
    for k in range(8):
        place = at + k
        byte = np.where(place < stop, data[np.minimum(place, len(data) - 1)].astype(U64) + U64(0), U64(0))
        out = (out << U64(8)) | byte
    return out


def suffix_order(data, start, stop, length, same) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``start`` and its common-prefix lengths (0 below ``length``).

    ``same`` numbers the suffixes by their first ``length`` bytes; suffixes of one number
    are sorted by the bytes that follow, eight at a time while any are alike.
    """
    rank = same.astype(np.int64)
    depth = length
    active = np.arange(len(start))
    while len(active):
        word = _words(data, start[active] + depth, stop[active])
        left = np.minimum(np.maximum(stop[active] - start[active] - depth, 0), 8)
        order = np.lexsort((left, word, rank[active]))
        a = active[order]
        w, l, r = word[order], left[order], rank[a]
        fresh = np.ones(len(a), bool)
        fresh[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1]) | (l[1:] != l[:-1])
        head = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        # ranks stay those of the group's first place among the equal ones
        base = np.ones(len(a), bool)
        base[1:] = r[1:] != r[:-1]
        offset = head[group] - np.flatnonzero(base)[np.cumsum(base) - 1]
        rank[a] = r + offset
        size = np.diff(np.append(head, len(a)))[group]
        active = a[(size > 1) & (l == 8)]
        depth += 8
    order = np.argsort(rank, kind="stable")
    common = np.zeros(len(start), np.int64)
    i = np.flatnonzero(same[order][1:] == same[order][:-1])
    x, y = order[i], order[i + 1]
    depth = np.full(len(i), length)
    live = np.arange(len(i))
    limit = np.minimum(stop[x] - start[x], stop[y] - start[y]) if len(i) else depth
    while len(live):
        more = depth[live] < limit[live]
        live = live[more]
        alike = data[start[x[live]] + depth[live]] == data[start[y[live]] + depth[live]]
        live = live[alike]
        depth[live] += 1
    common[i + 1] = depth
    return order, common


def maximal_intervals(common: np.ndarray, before: np.ndarray) -> list[tuple[int, int, int]]:
    """``(first, last, length)`` of each common-prefix interval that cannot grow left.

    A stack scan over the lengths builds the interval tree; ``before`` is the byte that
    precedes each suffix (in suffix order), negative where it is none and so differs from
    any other. An interval whose suffixes all follow one byte is part of a longer repeat.
    """
    out = []
    mixed = -(10**9)

    def join(a, b):
        return a if a == b and a >= 0 else mixed

    stack: list[list[int]] = []  # length, first, symbol before all its suffixes
    lengths, symbols = common.tolist(), before.tolist()
    for i in range(1, len(lengths) + 1):
        here = lengths[i] if i < len(lengths) else 0
        first, symbol = i - 1, symbols[i - 1]
        while stack and stack[-1][0] > here:
            length, first, seen = stack.pop()
            symbol = join(seen, symbol)
            if symbol < 0:
                out.append((first, i - 1, length))
            if stack and stack[-1][0] >= here:
                stack[-1][2] = join(stack[-1][2], symbol)
                symbol = stack[-1][2]
        if here:
            if stack and stack[-1][0] == here:
                stack[-1][2] = join(stack[-1][2], symbol)
            else:
                stack.append([here, first, symbol])
    return out


class Slice:
    """All strings of one slice, each once, with the smallest and largest key that hold them."""

    def __init__(self, table: pa.Table):
        def column(name, kind):
            return _unzip(table[name].to_pylist(), kind)

        data = column("bytes", np.uint8)
        lengths = [_unzip([x], np.int32).astype(np.int64) for x in table["lengths"].to_pylist()]
        sizes = np.concatenate(lengths)
        end = np.cumsum(sizes)
        self.name, first, back = np.unique(
            arrays.hash_spans(data, end - sizes, end), return_index=True, return_inverse=True
        )
        self.data = gather(data, (end - sizes)[first], end[first])
        self.end = np.cumsum(sizes[first])
        self.begin = self.end - sizes[first]
        self.low, self.high = np.full(len(first), LAST), np.full(len(first), -LAST - 1)
        self.most = column("most", np.int64)
        np.minimum.at(self.low, back, column("least", np.int64))
        np.maximum.at(self.high, back, self.most)
        # each piece's strings, in the order in which it sent them
        self.sent = np.split(back, np.cumsum([len(x) for x in lengths])[:-1])
        self.pieces = table["piece"].to_pylist()

    def replies(self, string: np.ndarray, least: np.ndarray | None = None, **columns: np.ndarray) -> pa.Table:
        """What was found of each string, to every piece that has it.

        With ``least`` only where the piece has the string under a larger key too.
        """
        order = np.argsort(string, kind="stable")
        string = string[order]
        columns = {n: c[order] for n, c in columns.items()}
        if least is not None:
            columns["least"] = least[order]
        rows, at = [], 0
        for piece, mine in zip(self.pieces, self.sent):
            first, last = (np.searchsorted(string, mine, side) for side in ("left", "right"))
            found, of = _ranges(first, last - first)
            if least is not None:
                found = found[columns["least"][found] < self.most[at : at + len(mine)][of]]
            at += len(mine)
            if len(found):
                rows.append((piece, _zip(self.name[string[found]]), *(_zip(c[found]) for c in columns.values())))
        names = ["piece", "string", *columns]
        kinds = [pa.int64(), *[pa.binary()] * (len(names) - 1)]
        return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    def repeats(self, length: int) -> tuple[np.ndarray, ...]:
        """Maximal repeats of different strings: strings and places in suffix order, then
        first, last and length of each interval."""
        size = self.end - self.begin
        windows = size - length + 1
        string = np.repeat(np.arange(len(size)), windows)
        start = np.repeat(self.begin - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        window = arrays.hash_spans(self.data, start, start + length)
        order = np.argsort(window)
        edge = np.ones(len(order), bool)
        edge[1:] = window[order][1:] != window[order][:-1]
        head = np.flatnonzero(edge)
        group = np.cumsum(edge) - 1
        # only windows of several strings in several documents can matter
        several = np.diff(np.append(head, len(order))) > 1
        several &= np.minimum.reduceat(self.low[string[order]], head) < np.maximum.reduceat(
            self.high[string[order]], head
        )
        keep = order[several[group]]
        string, start = string[keep], start[keep]
        same = group[several[group]]
        new = np.diff(same, prepend=-1) != 0
        same = np.flatnonzero(new)[np.cumsum(new) - 1]  # a group's rank is its first place
        places, common = suffix_order(self.data, start, self.end[string], length, same)
        string, start = string[places], start[places]
        inner = start > self.begin[string]
        before = np.where(inner, self.data[np.maximum(start - 1, 0)].astype(np.int64), -1)
        found = maximal_intervals(common, before)
        columns = np.array(found, np.int64).reshape(-1, 3).T
        return string, start - self.begin[string], *columns

    def groups(self, length: int):
        """Members of the repeats across documents, some groups at a time.

        Yields string, place in it, length and group of each. First come the strings that
        several documents hold as a whole, then the intervals. A group is named by the hash
        of its bytes, so equal repeats have one name and others differ, in whatever slice.
        """
        raw = self.data.tobytes()

        def named(begin, size):
            spans = zip(begin.tolist(), (begin + size).tolist())
            digests = b"".join(hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in spans)
            return np.frombuffer(digests, np.int64)

        whole = np.flatnonzero(self.low < self.high)
        size = (self.end - self.begin)[whole]
        yield whole, np.zeros(len(whole), np.int64), size, named(self.begin[whole], size)
        strings, places, first, last, depth = self.repeats(length)
        if not len(first):
            return
        pairs = np.stack([first, last + 1], 1).ravel()

        def over(least, values, none):
            return least.reduceat(np.append(values, none), pairs)[::2]

        low, high = over(np.minimum, self.low[strings], LAST), over(np.maximum, self.high[strings], -LAST)
        useful = np.flatnonzero(low < high)
        for chunk in _chunks((last - first + 1)[useful]):
            chunk = useful[chunk]
            member, of = _ranges(first[chunk], last[chunk] - first[chunk] + 1)
            head = first[chunk]
            group = named(self.begin[strings[head]] + places[head], depth[chunk])
            yield strings[member], places[member], depth[chunk][of], group[of]


def _ranges(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges that begin at ``first`` and hold ``n``; the range of each."""
    of = np.repeat(np.arange(len(n)), n)
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), of


def _chunks(cost: np.ndarray, at_once: int = 1 << 21) -> list[np.ndarray]:
    part = np.cumsum(cost) // at_once
    return np.split(np.arange(len(cost)), np.flatnonzero(np.diff(part)) + 1) if len(cost) else []


def _covered(part: Slice, length: int):
    """String, first byte, end and smallest key of what an earlier document holds of each string.

    A maximal repeat gives each window in it the smallest key of its group; a window is
    covered in every document with a larger key. Windows of a string that share their
    smallest key are one span, whatever number of nested repeats they stand in.
    """
    windows = part.end - part.begin - length + 1
    base = np.cumsum(windows) - windows
    low = np.repeat(part.low, windows)
    strings, places, first, last, depth = part.repeats(length)
    for chunk in _chunks((last - first + 1) * (depth - length + 1)):
        member, of = _ranges(first[chunk], last[chunk] - first[chunk] + 1)
        least = np.minimum.reduceat(part.low[strings[member]], np.flatnonzero(np.diff(of, prepend=-1)))
        window, of_member = _ranges(base[strings[member]] + places[member], depth[chunk][of] - length + 1)
        np.minimum.at(low, window, least[of[of_member]])
    owner = np.repeat(np.arange(len(windows)), windows)
    new = np.diff(owner, prepend=-1) != 0
    new[1:] |= low[1:] != low[:-1]
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(low)) - 1
    useful = low[head] < part.high[owner[head]]
    head, tail = head[useful], tail[useful]
    first = head - base[owner[head]]
    return owner[head], first, first + tail - head + length, low[head]


def _members(table: pa.Table, length: int) -> pa.Table:
    part = Slice(table)
    none = np.zeros(0, np.int64)
    string, place, size, group = (
        np.concatenate(c) for c in zip((none, none, none, none), *part.groups(length))
    )
    # a string that is held whole may be in an interval too
    _, once = np.unique(np.stack([group, string, place], 1), axis=0, return_index=True)
    return part.replies(string[once], place=place[once], length=size[once], group=group[once])


def _cover(table: pa.Table, length: int) -> pa.Table:
    part = Slice(table)
    string, first, end, least = _covered(part, length)
    return part.replies(string, least, first=first, end=end)


def _found(piece: Piece, strings: list[np.ndarray], names: tuple[str, ...]):
    """The replies to a piece for each place of its strings: the stretch, then the named columns."""
    replies = piece.column("found") or ()
    text = _unzip([r["string"] for r in replies], U64)
    columns = [_unzip([r[n] for r in replies], np.int64) for n in names]
    order = np.argsort(text, kind="stable")
    first, last = (np.searchsorted(text[order], strings[3], side) for side in ("left", "right"))
    found, of = _ranges(first, last - first)
    return of, *(c[order[found]] for c in columns)


def _occurrences(batches, length, gram, buckets, slices):
    for piece in _rows(batches):
        strings = piece.shared_strings(length, gram, buckets, slices)
        of, place, size, group = _found(piece, strings, ("place", "length", "group"))
        begin, owner = strings[0][of], strings[2][of]
        columns = (group, size, piece.key[owner], piece.document[owner], begin - piece.at[owner] + place)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["group", "length", "key", "document", "start"]
        )


def _source(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Order key (a null id after all others), a hash that tells texts of one id apart, text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(int(LAST))).alias("key"),
        F.xxhash64(text).alias("document"), text.alias("text"),
    )


def _sliced(source: DataFrame, length: int, gram: int, slice_bytes: int):
    """The shared strings of every slice, and a function that takes replies back to the texts.

    The corpus is read once and stored in compressed pieces. Each piece asks the buckets of
    its minimisers which of them other texts have; only strings of those are sent to slices.
    A false match of 32 bits within a bucket sends a string in vain and changes no result.
    A minimiser whose windows alone would pass ``slice_bytes`` is heavy: its windows are dealt
    over all slices by their own hash. Answers and replies go to the pieces that asked, so
    no occurrence of a string travels and no list of minimisers is held in one place.
    """
    gram = min(gram, length)
    pieces = materialize(source.mapInArrow(
        _store, "piece long, n_bytes long, keys binary, documents binary, lengths binary, bytes binary"
    ), "pieces")
    total = pieces.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = int(total // BUCKET_BYTES) + 1
    asked = pieces.mapInArrow(
        partial(_ask, length=length, gram=gram, buckets=buckets),
        "piece long, bucket long, prints binary, weights binary",
    )
    answers = materialize(asked.groupBy("bucket").applyInArrow(
        lambda table: _answer(table, length, slice_bytes), "piece long, bucket long, codes binary, windows long"
    ), "answers")
    # alone, each window of a heavy minimiser is a string
    heavy = answers.agg(F.sum("windows")).first()[0] or 0
    options = dict(
        length=length, gram=gram, buckets=buckets, slices=int((total + length * heavy) // slice_bytes) + 1
    )
    known = answers.groupBy("piece").agg(F.collect_list(F.struct("bucket", "codes")).alias("known"))
    informed = pieces.join(known, "piece", "left")
    strings = informed.mapInArrow(
        partial(_spread, **options), "slice long, piece long, bytes binary, lengths binary, least binary, most binary"
    )

    def at_home(replies: DataFrame, mapper, schema: str) -> DataFrame:
        columns = [c for c in replies.columns if c != "piece"]
        found = replies.groupBy("piece").agg(F.collect_list(F.struct(*columns)).alias("found"))
        return informed.join(found, "piece", "left").mapInArrow(partial(mapper, **options), schema)

    return strings, at_home


def _joined(parts: DataFrame) -> DataFrame:
    """Parts that touch and have the same occurrences, as one repeat; a row per occurrence.

    Their occurrences are the same when they are so relative to the first one.
    """
    anchors = parts.groupBy("group").agg(F.min(F.struct("key", "document", "start")).alias("a"))
    shifted = parts.join(anchors, "group").withColumn("shift", F.col("start") - F.col("a.start"))
    same = [F.bit_xor(F.xxhash64(F.lit(k), "key", "document", "shift")).alias(f"x{k}") for k in range(2)]
    sets = shifted.groupBy("group").agg(
        F.first("a").alias("a"), F.first("length").alias("length"), F.count(F.lit(1)).alias("n"), *same
    ).select(
        "group", "n", "x0", "x1", F.col("a.key").alias("first_key"), F.col("a.document").alias("first_document"),
        F.col("a.start").alias("begin"), (F.col("a.start") + F.col("length")).alias("end"),
    )
    alike = ["first_key", "first_document", "n", "x0", "x1"]
    order = Window.partitionBy(*alike).orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = sets.withColumn("new", F.when(F.col("begin") <= before, 0).otherwise(1)).withColumn(
        "run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    whole = runs.groupBy(*alike, "run").agg(
        F.min(F.struct("begin", "end", "group")).alias("head"), F.max("end").alias("end")
    ).select(F.col("head.group").alias("group"), (F.col("end") - F.col("head.begin")).alias("length"), "first_key")
    return parts.drop("length").join(whole, "group")


def repeat_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 50,
    gram: int = 24,
    slice_bytes: int = 4 << 20,
) -> DataFrame:
    """Maximal repeats of ``length`` bytes or more across documents, with all occurrences.

    Returns ``group``, ``length``, the id (null if it is), ``document`` (hash of the text),
    ``start`` and ``first_key`` (smallest id of the group) per occurrence. Texts are UTF-8
    bytes; no match crosses documents.

    Windows of ``length`` bytes whose minimiser (smallest hash of their ``gram``-byte strings)
    stands in several texts go to slices by it, and those of a minimiser with more than
    ``slice_bytes`` of different text by their own hash, so all occurrences of a
    window meet in one slice of about ``slice_bytes`` of text; a slice holds each distinct
    string of a piece of text once. There an enhanced suffix array is built over the windows that occur in
    several documents, a stack scan makes its common-prefix intervals, and those whose
    suffixes follow different bytes are the maximal repeats within a stretch of one
    minimiser. Parts that touch and have the same occurrences are joined into the full
    repeat. A long repeat of which some parts also occur elsewhere is not one group: it
    appears as its parts, each with all its own occurrences, which cover it without a gap.
    In text that repeats itself for more than ``LONGEST`` windows a part may lack the
    occurrences that a cut goes through; other parts cover those.

    Null text is empty. A null id comes after all others. Rows of one id count as one
    document. An empty table gives no rows.
    """
    source = _source(docs, id_column, text_column)
    strings, at_home = _sliced(source, length, gram, slice_bytes)
    members = strings.groupBy("slice").applyInArrow(
        lambda table: _members(table, length), "piece long, string binary, place binary, length binary, group binary"
    )
    parts = materialize(
        at_home(members, _occurrences, "group long, length long, key long, document long, start long"), "parts"
    )
    return _joined(parts).select(
        F.xxhash64("group", "length").alias("group"), "length",
        F.when(F.col("key") != int(LAST), F.col("key")).alias(id_column), "document", "start", "first_key",
    )


def _cut_out(batches, length, gram, buckets, slices, with_text):
    for piece in _rows(batches):
        strings = piece.shared_strings(length, gram, buckets, slices)
        of, first, end, least = _found(piece, strings, ("first", "end", "least"))
        later = piece.key[strings[2][of]] > least
        of, first, end = of[later], first[later], end[later]
        step = np.zeros(len(piece.data) + 1, np.int32)
        np.add.at(step, strings[0][of] + first, 1)
        np.add.at(step, strings[0][of] + end, -1)
        gone = np.cumsum(step[:-1]) > 0
        rows = []
        for a, b in zip(piece.at[:-1].tolist(), piece.at[1:].tolist()):
            mine = gone[a:b]
            left = piece.data[a:b][~mine].tobytes()
            runs = int(np.count_nonzero(mine[1:] & ~mine[:-1])) + int(mine[:1].sum())
            rows.append((b - a, b - a - len(left), runs, hashlib.sha256(left).hexdigest(), left if with_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece.key), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 50,
    gram: int = 24,
    slice_bytes: int = 4 << 20,
    with_text: bool = True,
) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string of a document with a smaller id.

    Returns a row per document: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs), ``kept_sha256`` and, if ``with_text``, the ``kept`` bytes. Overlaps
    count, and strings are judged on the input. See :func:`repeat_groups` for the method
    and for nulls; rows of one id do not remove each other's bytes.
    """
    source = _source(docs, id_column, text_column)
    strings, at_home = _sliced(source, length, gram, slice_bytes)
    cover = strings.groupBy("slice").applyInArrow(
        lambda table: _cover(table, length), "piece long, string binary, first binary, end binary, least binary"
    )
    cut = at_home(
        cover, partial(_cut_out, with_text=with_text),
        "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
    return cut.select(
        F.when(F.col("key") != int(LAST), F.col("key")).alias(id_column),
        "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else []),
    )
