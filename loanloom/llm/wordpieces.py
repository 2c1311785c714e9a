"""Encoding with a sentence-piece model that keeps every piece's place in the source text."""

from __future__ import annotations

import hashlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.segments import SegmentEncoder

#: Fixed value: the mark that stands for a blank in normalised text.
BLANK = "▁".encode()


def _fields(raw: bytes):
    """Number and value of the fields of a serialised message."""
    at = 0

    def number():
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, raw[at : at + size]
            at += size


class Normaliser:
    """The model's text normalisation, with the source place of every byte it writes.

    The compiled character map is a double-array trie over UTF-8: at each place the
    longest prefix in it is replaced; elsewhere one character is copied. Blanks become
    the blank mark, one goes in front, and extra ones are removed if the model says so.
    """

    def __init__(self, model: bytes):
        spec = dict(_fields(next((v for k, v in _fields(model) if k == 3), b"")))
        trainer = dict(_fields(next((v for k, v in _fields(model) if k == 2), b"")))
        self.prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if trainer.get(24):
            raise ValueError("models with blanks as suffixes are not supported")
        blob = spec.get(2, b"")
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist() if blob else []
        self.targets = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest prefix of ``text[at:]`` in the map."""
        units, found = self.units, None
        if not units:
            return None

        def offset(unit):
            return (unit >> 10) << ((unit & 512) >> 6)

        node = offset(units[0])
        for k in range(at, len(text)):
            node ^= text[k]
            if node >= len(units) or units[node] & 0x800000FF != text[k]:
                break
            leaf = units[node] >> 8 & 1
            node ^= offset(units[node])
            if leaf:
                found = k + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.targets[found[1] : self.targets.index(b"\0", found[1])]

    def steps(self, text: bytes):
        """Source start, source end and output for every step over ``text``."""
        at = 0
        while at < len(text):
            hit = self.longest(text, at)
            if hit is None:
                lead = text[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = size, text[at : at + size]
            yield at, at + hit[0], hit[1]
            at += hit[0]

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of their ends (0 included) its place in ``text``."""
        if not self.units and not self.squeeze:
            return self._plain(text)
        out, ends = bytearray(), [0]
        blank = BLANK if self.escape else b" "
        todo = list(self.steps(text))
        if self.squeeze:
            while todo and not todo[0][2].strip(b" "):
                todo.pop(0)
        if todo and self.prefix:
            out += blank
            ends = [todo[0][0]] * (len(blank) + 1)
        elif todo:
            ends = [todo[0][0]]
        was_blank = self.squeeze
        for _, stop, target in todo:
            if self.squeeze and was_blank:
                target = target.lstrip(b" ")
            for byte in target:
                piece = blank if byte == 0x20 else bytes([byte])
                out += piece
                ends += [stop] * len(piece)
            if target:
                was_blank = target.endswith(b" ")
        if self.squeeze:
            while out.endswith(blank):
                del out[-len(blank) :], ends[-len(blank) :]
        return bytes(out), np.array(ends, np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if not text:
            return b"", np.zeros(1, np.int64)
        blank = BLANK if self.escape else b" "
        source = np.frombuffer(text, np.uint8)
        width = np.where(source == 0x20, len(blank), 1)
        ends = np.repeat(np.arange(1, len(text) + 1), width)
        head = blank if self.prefix else b""
        return head + text.replace(b" ", blank), np.concatenate([np.zeros(len(head) + 1, np.int64), ends])


class Encoder:
    """Ids and source spans of whole texts, exactly as the library encodes them."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            raw = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.normalise = Normaliser(raw)
        pieces = [dict(_fields(v)) for k, v in _fields(raw) if k == 1]
        names = [p.get(1, b"") for p in pieces]
        # a byte piece stands for one byte
        self.sizes = np.array([1 if p.get(3) == 6 else len(n) for p, n in zip(pieces, names)], np.int64)
        self.decimal = np.array([f"{i}," for i in range(len(names))], "S")
        plain = not self.normalise.units and not self.normalise.squeeze
        # no piece goes on over a blank, so words can be encoded one by one
        inner = any(BLANK in n.lstrip(BLANK) if n.startswith(BLANK) else BLANK in n for n in names)
        defined = any(p.get(3) == 4 for p in pieces)
        self.by_word = plain and self.normalise.prefix and self.normalise.escape and not inner and not defined
        self.blank = self.library.piece_to_id(BLANK.decode())
        self.segments = SegmentEncoder(self._words)

    def _words(self, words: list[str]) -> list[list[int]]:
        # the library puts the first blank of a word itself, but none before an empty text
        found = self.library.encode([w[1:] for w in words], num_threads=1)
        return [f or [self.blank] for f in found]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids begin."""
        if not self.by_word:
            found = self.library.encode(texts.fill_null("").to_pylist(), num_threads=1)
            at = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
            return np.fromiter((i for f in found for i in f), np.int32, int(at[-1])), at
        data, at = arrays.flat(texts)
        full = np.flatnonzero(np.diff(at))
        # one blank before every text that is not empty, as the normalisation puts it
        front = np.zeros(len(at) - 1, np.int64)
        front[full] = 1
        lead = at[:-1][full]
        spread = np.insert(data, lead, 0x20)
        begin = lead + np.arange(len(full))
        # the blank mark itself in a text counts as a blank: three bytes
        mark = np.zeros(len(spread), bool)
        if len(spread) > 2:
            mark[:-2] = (spread[:-2] == BLANK[0]) & (spread[1:-1] == BLANK[1]) & (spread[2:] == BLANK[2])
        blank = (spread == 0x20) | mark
        inside = blank.copy()  # bytes of a blank, for the byte before
        inside[1:] |= mark[:-1]
        inside[2:] |= mark[:-2]
        first = blank.copy()
        first[1:] &= ~inside[:-1]
        first[begin] = True
        start = np.flatnonzero(first)
        ids, count = self.segments(spread, start, np.append(start[1:], len(spread)))
        owner = np.searchsorted(begin, start, side="right") - 1
        sizes = np.zeros(len(at) - 1, np.int64)
        sizes[full] = np.bincount(owner, weights=count, minlength=len(full))[: len(full)].astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(sizes)])

    def spans(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-last source byte of each piece; together they cover the text."""
        written, ends = self.normalise(text)
        stop = np.cumsum(self.sizes[ids]) if len(ids) else np.zeros(0, np.int64)
        if len(stop) and stop[-1] != len(written):
            raise ValueError("pieces and normalised text differ in length")
        begin = np.concatenate([[0], stop[:-1]]) if len(stop) else stop
        return ends[begin], ends[stop]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _encode(batches, path, with_pieces):
    coder = encoder(path)
    for batch in arrays.pieces(batches, "text", 1 << 21):
        texts = batch.column(1)
        ids, at = coder.ids(texts)
        data, where = arrays.flat(texts)
        raw = data.tobytes()
        rows = []
        mine = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
        for got, a, b in zip(mine, where[:-1].tolist(), where[1:].tolist()):
            begin, end = coder.spans(raw[a:b], got)
            decoded = coder.library.decode(got.tolist()) if len(got) else ""
            named = coder.decimal[got].tobytes().replace(b"\0", b"")[:-1]
            rows.append((
                len(got), int((end - begin).sum()), hashlib.sha256(named).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
                hashlib.sha256(np.stack([begin, end], axis=1).astype("<i8").tobytes()).hexdigest(),
                *((got, begin, end, decoded) if with_pieces else (None, None, None, None)),
            ))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns],
            ["id", "n_tokens", "bytes_covered", "ids_sha256", "decoded_sha256", "spans_sha256", "ids", "begins", "ends",
             "decoded"],
        )


def encode(
    docs: DataFrame,
    model: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_pieces: bool = True,
    with_spans: bool = False,
) -> DataFrame:
    """Encode whole texts, project every piece onto its source bytes, and decode again.

    Returns a row per document: the id, ``n_tokens``, ``bytes_covered`` (source bytes in
    the pieces' spans), ``ids_sha256``, ``decoded_sha256``, ``with_spans`` also ``spans_sha256`` (of the spans' ends, little-endian
    signed 64-bit numbers, begin and end of each piece in turn) and, if ``with_pieces``,
    ``ids``, ``begins`` and ``ends`` (UTF-8 byte spans of the source) and ``decoded``.

    Null or empty text has no pieces. Rows with equal or null ids stay apart. Ids are the
    library's; the path must name a file that every executor has. An empty table gives no
    rows. Only a projection: nothing is shuffled.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(
        partial(_encode, path=model, with_pieces=with_pieces),
        f"id {kind}, n_tokens long, bytes_covered long, ids_sha256 string, decoded_sha256 string, "
        "spans_sha256 string, "
        "ids array<int>, begins array<long>, ends array<long>, decoded string",
    )
    found = found.withColumnRenamed("id", id_column)
    found = found if with_spans else found.drop("spans_sha256")
    return found if with_pieces else found.drop("ids", "begins", "ends", "decoded")
