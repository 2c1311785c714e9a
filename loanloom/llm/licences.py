"""Licence notices in whole texts, found through a positional index of rare words."""

from __future__ import annotations

import math
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays

# Base phrases and their labels.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
# Opening passages of well-known licences; the phrases without which a text is
# not such a notice follow each.
NOTICES = (
    (
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    (
        "apache-2.0-notice",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        ("you may not use this file except in compliance",),
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version",
        ("gnu general public license as published by",),
    ),
    (
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ("general public license version 3",),
    ),
    (
        "lgpl-notice",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu "
        "lesser general public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    (
        "bsd-notice",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    (
        "isc-notice",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    (
        "mpl-2.0-notice",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    (
        "unlicense-notice",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    (
        "cc-by-4.0",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international",),
    ),
)


class Template(NamedTuple):
    """A label, its words, and where its mandatory phrases stand in them (first, words)."""

    label: str
    words: list[str]
    phrases: list[tuple[int, int]]
    base: bool


def templates() -> list[Template]:
    """Base phrases, each mandatory as it stands, then the notices."""
    out = [Template(label, p.split(), [(0, len(p.split()))], True) for label, p in PHRASES]
    for label, text, phrases in NOTICES:
        words, spans = text.split(), []
        for phrase in phrases:
            inner = phrase.split()
            at = next(i for i in range(len(words)) if words[i : i + len(inner)] == inner)
            spans.append((at, len(inner)))
        out.append(Template(label, words, spans, False))
    return out


VOCABULARY = {w: i for i, w in enumerate(sorted({w for t in templates() for w in t.words}))}


def _numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number in the vocabulary of every word of all texts, -1 for others, and each text's bounds."""
    data, at = arrays.flat(texts)
    data = arrays.LOWER[data]
    start, end, owner = arrays.words(data, at, arrays.PLAIN)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    longest = max(map(len, VOCABULARY))
    number = np.full(len(start), -1, np.int64)
    short = np.flatnonzero(end - start <= longest)
    if len(short):
        word, names = arrays.distinct_spans(data, start[short], end[short])
        known = {w.encode(): i for w, i in VOCABULARY.items()}
        number[short] = np.array([known.get(n, -1) for n in names.to_pylist()], np.int64)[word]
    return number, bounds


def _counts(batches):
    total = np.zeros(len(VOCABULARY), np.int64)
    texts = 0
    for batch in arrays.pieces(batches, "text"):
        number, bounds = _numbered(batch.column(0))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        inside = number >= 0
        pair = np.unique(owner[inside] * len(VOCABULARY) + number[inside])
        total += np.bincount(pair % len(VOCABULARY), minlength=len(VOCABULARY))
        texts += batch.num_rows
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, len(VOCABULARY))), pa.array(np.concatenate([[texts], total]))], ["word", "texts"]
    )


def word_weights(docs: DataFrame, text_column: str = "text") -> list[float]:
    """Inverse document frequency of each licence word over all texts, in vocabulary order.

    A task counts its own texts into one number per licence word; the driver gets as many
    rows as the vocabulary has words, whatever the corpus.
    """
    counted = docs.select(F.col(text_column).alias("text")).mapInArrow(_counts, "word long, texts long")
    found = dict(counted.groupBy("word").agg(F.sum("texts")).collect())
    texts = found.get(-1) or 0
    return [math.log((texts + 1) / ((found.get(i) or 0) + 1)) + 1 for i in range(len(VOCABULARY))]


class Index:
    """Postings of licence words: which template holds a word, and where.

    Of a template the ``rare`` words of highest weight are looked up; in a base phrase all
    words are. Frequent words of the language so cost no look-ups.
    """

    def __init__(self, weights: list[float], rare: int):
        self.templates = templates()
        self.words = [np.array([VOCABULARY[w] for w in t.words]) for t in self.templates]
        self.weights = np.array(weights)
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.looked: list[np.ndarray] = []
        for number, words in enumerate(self.words):
            by_weight = sorted(set(words.tolist()), key=lambda w: (-weights[w], w))
            chosen = by_weight if self.templates[number].base else by_weight[:rare]
            self.looked.append(np.array(chosen))
            for place, word in enumerate(words.tolist()):
                if word in chosen:
                    self.postings.setdefault(word, []).append((number, place))
        self.marks = np.zeros(len(VOCABULARY) + 1, bool)  # the last entry is that of other words
        self.marks[list(self.postings)] = True


def _phrase(number: np.ndarray, words: np.ndarray, at: np.ndarray, first: int, stop: int) -> np.ndarray:
    """Which of ``at`` are places in ``first:stop`` where ``words`` stand consecutively."""
    good = (at >= first) & (at + len(words) <= stop)
    for k, word in enumerate(words.tolist()):
        good[good] = number[at[good] + k] == word
    return good


def _inspect(number, first, stop, places, index, slack, share):
    """Matches in one text: ``(template, start, score)``; ``places`` hold its indexed words."""
    votes: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    words = number[places]
    for word in np.unique(words).tolist():
        at = places[words == word]
        for template, place in index.postings[word]:
            votes.setdefault(template, []).append((at - place, np.full(len(at), word)))
    out = []
    for template, lists in sorted(votes.items()):
        looked, known, info = index.looked[template], index.words[template], index.templates[template]
        if info.base:  # words at their very places: intersect the begins that the postings imply
            if len(lists) < len(known):
                continue
            begins, count = np.unique(np.concatenate([b for b, _ in lists]), return_counts=True)
            begins = begins[count >= len(known)]
            begins = begins[_phrase(number, known, begins, first, stop)]
            out += [(template, int(b), 1.0) for b in begins.tolist()]
            continue
        if len({int(w[0]) for _, w in lists}) < share * len(looked):
            continue
        begins = np.concatenate([b for b, _ in lists])
        word = np.concatenate([w for _, w in lists])
        order = np.argsort(begins, kind="stable")
        begins, word = begins[order], word[order]
        # mandatory phrases first: each names where the template would begin
        agreed = None
        for place, size in info.phrases:
            wanted = known[place : place + size]
            where = np.flatnonzero(number[first:stop] == wanted[np.argmax(index.weights[wanted])]) + first
            where = where - int(np.argmax(index.weights[wanted]))
            where = where[_phrase(number, wanted, where, first, stop)] - place
            if agreed is None:
                agreed = where
            else:  # the other phrases stand where they should, give or take the slack
                near = np.searchsorted(where, agreed - slack) < np.searchsorted(where, agreed + slack, side="right")
                agreed = agreed[near]
        for begin in agreed.tolist():
            low, high = np.searchsorted(begins, begin - slack), np.searchsorted(begins, begin + slack, side="right")
            met = np.unique(word[low:high])
            if len(met) < share * len(looked):
                continue
            inside = number[max(first, begin - slack) : min(stop, begin + len(known) + slack)]
            present = np.isin(known, inside[inside >= 0])
            score = float(index.weights[known[present]].sum() / index.weights[known].sum())
            out.append((template, max(first, begin), score))
    return out


def _scan(batches, weights, rare, slack, share):
    index = Index(weights, rare)
    for batch in arrays.pieces(batches, "text"):
        number, bounds = _numbered(batch.column(1))
        places = np.flatnonzero(index.marks[number])
        cuts = np.searchsorted(places, bounds)
        found = [[] for _ in range(batch.num_rows)]
        for t in np.flatnonzero(np.diff(cuts)).tolist():
            first, stop = int(bounds[t]), int(bounds[t + 1])
            for template, start, score in _inspect(
                number, first, stop, places[cuts[t] : cuts[t + 1]], index, slack, share
            ):
                info = index.templates[template]
                found[t].append({
                    "label": info.label, "base": info.base, "word": start - first,
                    "n_words": len(info.words), "score": score,
                })
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(found, _MATCHES)],
            ["id", "n_words", "matches"],
        )


_MATCHES = pa.list_(pa.struct([
    ("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64()),
]))


def licences(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rare: int = 6,
    slack: int = 8,
    share: float = 0.75,
) -> DataFrame:
    """Licence phrases and notices of every whole text; a row per document.

    Returns the id, ``n_words`` and ``matches``: label, whether it is a base phrase, the word
    it begins at (from 0), the words of its template and the score. Words are runs of ASCII
    letters, digits and bytes above 0x7F; A-Z count as a-z.

    The words of all templates are weighed by inverse document frequency over the whole
    corpus. A text's words are looked up in the postings of each template's heaviest words;
    every posting says where the template would begin, and these places are intersected.
    A base phrase (:data:`PHRASES`) needs all its words at their places, and scores 1. A
    notice (:data:`NOTICES`) needs its mandatory phrases word by word, and beside them
    ``share`` of its ``rare`` heaviest words within ``slack`` words of their place, so names and
    changed words between do not hide it; it scores the weight of its words found there.

    Nothing is shuffled but one count per licence word and task. Null text is empty; a text
    without words has no matches. Repeated rows and null ids each give a row. A very long text is one
    unit of work of about 60 bytes a word. Other columns are not read. An empty table gives no rows.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    weights = word_weights(source)
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(
        partial(_scan, weights=weights, rare=rare, slack=slack, share=share),
        f"id {kind}, n_words long, "
        "matches array<struct<label: string, base: boolean, word: bigint, n_words: bigint, score: double>>",
    )
    return found.withColumnRenamed("id", id_column)
