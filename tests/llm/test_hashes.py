"""Words that a polynomial hash modulo a power of two cannot tell apart must stay apart."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from loanloom.llm import arrays, minhash, packing, repeats, secrets, segments, wordpieces


def twin_words(letters: int = 1024) -> tuple[str, str]:
    """A word of a and b by the parity of the ones in the place's number, and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(letters)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("letters", [1024, 2048])
def test_word_pieces_of_twins(letters):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [f"{w} tail" for w in twin_words(letters)] + list(twin_words(letters))
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, at = wordpieces.Encoder(path).ids(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library.encode(texts)


@pytest.mark.parametrize("letters", [1024, 2048])
def test_tokens_of_twins(letters):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = list(twin_words(letters)) + [f"x {w}" for w in twin_words(letters)]
    whole = Tokenizer.from_file(path)
    ids, at = packing.token_ids(pa.array(texts), path)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [
        e.ids for e in whole.encode_batch(texts, add_special_tokens=False)
    ]


def test_shingles_of_twins_differ(spark):
    x, y = twin_words()
    a, b = arrays.shingles(pa.array([f"{x} z", f"{y} z"]), 2)
    assert len(a) == len(b) == 1 and a[0] != b[0]
    rows = [(0, f"{x} z"), (1, f"{y} z"), (2, f"{x.upper()} Z")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert {r.doc_id: r.component_id for r in got.collect()} == {0: 0, 1: 1, 2: 0}


def test_repeats_of_twins(spark):
    x, y = twin_words()
    rows = [(0, x), (1, y)]
    got = {
        r.doc_id: r for r in repeats.remove_repeats(
            spark.createDataFrame(rows, "doc_id long, text string"), with_text=False
        ).collect()
    }
    covered, earlier = np.zeros(len(y), bool), {x[i : i + 50] for i in range(len(x) - 49)}
    for i in range(len(y) - 49):
        if y[i : i + 50] in earlier:
            covered[i : i + 50] = True
    kept = bytes(c for c, gone in zip(y.encode(), covered) if not gone)
    assert got[1].n_removed == covered.sum() and got[1].kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert got[0].n_removed == 0


def test_segments_are_told_apart_by_bytes_and_the_cache_stays_small():
    asked = []
    coder = segments.SegmentEncoder(lambda ts: asked.extend(ts) or [[len(t), ord(t[0])] for t in ts], limit=3, limit_bytes=9)
    for text in ("ab cd ab ef", "cd gh ij kl mn", "ab", "longer-than-the-cache x"):
        data = np.frombuffer(text.encode(), np.uint8)
        start, end, _ = arrays.words(data, np.array([0, len(data)]))
        ids, count = coder(data, start, end)
        assert ids.tolist() == [v for w in text.split() for v in (len(w), ord(w[0]))]
        assert count.tolist() == [2] * len(text.split())
    assert asked.count("ab") == 2 and asked.count("cd") >= 1


def test_segments_met_again_stay_when_the_cache_is_full():
    asked = []
    coder = segments.SegmentEncoder(lambda ts: asked.extend(ts) or [[ord(t[0])] for t in ts], limit=4)
    for text in ("aa bb", "aa cc", "dd ee", "aa ff", "aa gg hh", "aa"):
        data = np.frombuffer(text.encode(), np.uint8)
        start, end, _ = arrays.words(data, np.array([0, len(data)]))
        ids, _ = coder(data, start, end)
        assert ids.tolist() == [ord(w[0]) for w in text.split()] and len(coder.slots) <= 4
    assert asked.count("aa") == 1


def test_overlap_of_bare_values_is_linear_and_right():
    import random
    import time

    rnd = random.Random(8)

    def plain(text):
        base = [s for s in secrets.find(text) if s[1] != "bare"]
        out = [
            (m.start(), m.end()) for m in secrets.BARE.finditer(text)
            if all(p.search(m[0]) for p in secrets.MIXED) and not any(a < m.end() and m.start() < b for a, _, b, _ in base)
        ]
        return out

    parts = ["password=", "token: '", "AKIA", "Zz9" * 9, "0123456789abcdef" * 3, " ", "\n", "x/", "aB1" * 10, "secret:"]
    for _ in range(300):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40)))
        assert [(a, b) for a, k, b, _ in secrets.find(text) if k == "bare"] == plain(text)
    dump = "\n".join(f"secret={'aB3' * 9}{i} {'Xy7' * 9}{i}" for i in range(20_000))
    start = time.process_time()
    assert len(secrets.find(dump)) == 40_000
    assert time.process_time() - start < 5


def test_only_the_querys_own_row_is_left_out(spark):
    from loanloom.llm import neighbours

    rows = [(20, [2.0, 1.0]), (20, [2.0, 1.0]), (20, [1.0, 3.0]), (1, [1.0, 1.0]), (40, [1e200, -1e200]), (2, [1e200, 1e200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.search(df, df.where("vec_id = 20"), k=9, cells_per_half=2, share=1.0, by_row=True).collect()
    assert len(got) == 3 * 5
    # either of the equal rows finds the other one, and both find the third row of their id
    assert sorted(r.score for r in got if r.vec_id == 20) == [5.0, 5.0, 5.0, 5.0, 5.0, 5.0]


def test_span_digests_are_those_of_the_pieces(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["one  two", "", None, "é☃ x\n", " ", "▁a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in wordpieces.encode(df, path, with_spans=True).collect():
        ends = np.array(list(zip(r.begins, r.ends)), "<i8")
        assert r.spans_sha256 == hashlib.sha256(ends.tobytes()).hexdigest()
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        assert r.ids == library.encode(texts[r.doc_id] or "")
