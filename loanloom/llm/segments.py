"""Token ids of whole texts from token ids of their distinct segments.

A tokenizer that never joins two segments gives a text the ids of its segments in order.
Text repeats its words, so each distinct segment is encoded once per batch and a bounded
cache, and the ids of a batch are gathered with array operations.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain, repeat

import numpy as np

from loanloom.llm import arrays


class SegmentEncoder:
    """Encodes segments through ``encode(list of str) -> list of id lists``, each once.

    Segments are told apart by their bytes. Holds at most ``limit`` of them and ``limit_bytes`` of
    their text, and one batch more. When full, those stay that the present batch uses or that were
    asked for again since it was full before, of the latter the longest known and at most half of
    either limit: most segments are met once only. This changes no result.
    """

    def __init__(
        self, encode: Callable[[list[str]], Sequence[Sequence[int]]], limit: int = 400_000,
        limit_bytes: int = 32 << 20, at_once: int = 1 << 13,
    ):
        self.encode, self.limit, self.limit_bytes, self.at_once = encode, limit, limit_bytes, at_once
        self.slots: dict[bytes, int] = {}
        self.size = 0
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)

    def _keep(self, segments: list[bytes]) -> None:
        """Forget all segments but these, which are known, and half a cache of those asked for again."""
        here = set(segments)
        others = [s for s, again in zip(self.slots, self.again.tolist()) if again and s not in here]
        del others[self.limit // 2 :]
        del others[int(np.searchsorted(np.cumsum([len(s) for s in others]), self.limit_bytes // 2, "right")) :]
        segments = segments + others
        slot = np.fromiter(map(self.slots.__getitem__, segments), np.int64, len(segments))
        first, self.count = self.first[slot], self.count[slot]
        total = np.cumsum(self.count)
        self.first = total - self.count
        self.ids = self.ids[np.repeat(first - self.first, self.count) + np.arange(int(self.count.sum()))]
        self.slots = dict(zip(segments, range(len(segments))))
        self.size = sum(map(len, segments))
        self.again = np.zeros(len(segments), bool)

    def _learn(self, segments: list[bytes]) -> None:
        counts, parts = [], []
        for at in range(0, len(segments), self.at_once):  # an encoding is far larger than its ids
            found = self.encode([s.decode("utf-8") for s in segments[at : at + self.at_once]])
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            parts.append(np.fromiter(chain.from_iterable(found), np.int32, int(counts[-1].sum())))
        count, ids = np.concatenate(counts), np.concatenate(parts)
        self.slots.update(zip(segments, range(len(self.slots), len(self.slots) + len(segments))))
        self.size += sum(map(len, segments))
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, ids])
        self.again = np.concatenate([self.again, np.zeros(len(segments), bool)])

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments end to end, and the number of ids of each segment."""
        number, distinct = arrays.distinct_spans(data, start, end)
        names = distinct.to_pylist()
        known = np.fromiter(map(self.slots.get, names, repeat(-1)), np.int64, len(names))
        self.again[known[known >= 0]] = True
        new = np.flatnonzero(known < 0)
        if len(new):
            fresh = [names[i] for i in new.tolist()]
            if len(self.slots) + len(fresh) > self.limit or self.size > self.limit_bytes:
                kept = np.flatnonzero(known >= 0)
                self._keep([names[i] for i in kept.tolist()])
                known[kept] = np.arange(len(kept))
            known[new] = len(self.slots) + np.arange(len(new))
            self._learn(fresh)
        slot = known[number]
        count = self.count[slot]
        total = np.cumsum(count)
        source = np.repeat(self.first[slot] - (total - count), count)
        return self.ids[source + np.arange(len(source))], count
