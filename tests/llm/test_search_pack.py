from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loanloom.llm import neighbours, packing
from tests.llm.data import awkward

SF = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- nearest neighbours ---


def brute_neighbours(rows, query, k):
    own, q = query
    scored = [(-sum(float(a) * float(b) for a, b in zip(v, q)), i) for i, v in rows if i != own]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def test_traverse_takes_pairs_by_summed_distance():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.normal(size=13), rng.normal(size=9)
        sizes = rng.integers(0, 3, (13, 9))
        cells = neighbours.traverse(a, b, sizes, 10**9)
        total = [a[c // 9] + b[c % 9] for c in cells]
        assert total == sorted(total) and len(cells) == (sizes > 0).sum()
        some = neighbours.traverse(a, b, sizes, 20)
        assert some == cells[: len(some)] and sizes.ravel()[some].sum() >= 20 > sizes.ravel()[some[:-1]].sum()


def test_search_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = neighbours.search(df, df.where("vec_id % 20 = 0")).toPandas()
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    hits = 0
    for q in [r for r in rows if r[0] % 20 == 0]:
        mine = got[got.query_id == q[0]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        want = brute_neighbours(rows, q, 20)
        hits += len(set(mine.vec_id) & {i for i, _ in want})
        exact = {i: s for i, s in brute_neighbours(rows, q, len(rows))}
        assert np.allclose(mine.score, [exact[i] for i in mine.vec_id], atol=1e-12)
        assert (np.diff(mine.score) <= 0).all()
    assert hits / (20 * got.query_id.nunique()) > 0.9


def test_search_with_all_cells_is_exact_with_ties_and_a_hot_vector(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 0.5, 0.0, 0.0, -1.0, 2.0]) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.search(df, df.where("vec_id % 20 = 0"), k=7, cells_per_half=4, share=1.0, shard_rows=16, query_block=3)
    for q in [r for r in rows if r[0] % 20 == 0]:
        mine = [(r.vec_id, r.score) for r in got.where(f"query_id = {q[0]}").orderBy("rank").collect()]
        want = brute_neighbours(rows, q, 7)
        assert [i for i, _ in mine] == [i for i, _ in want]
        assert np.allclose([s for _, s in mine], [s for _, s in want])


def test_search_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [0.0, 0.0]), (11, [1.0, 2.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as cell", "3 as query")
    got = neighbours.search(df, df.where("vec_id % 20 = 0"), k=5, cells_per_half=2, share=1.0)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == sorted(
        [(0, 1, 11, 5.0), (0, 2, 20, 4.0), (0, 3, 20, 4.0)] + 2 * [(20, 1, 0, 4.0), (20, 2, 11, 4.0)]
    )
    assert neighbours.search(df.limit(0), df.limit(0)).count() == 0
    assert neighbours.search(df, df.limit(0)).count() == 0


# --- packing ---


def test_token_ids_equal_the_library():
    rnd = random.Random(1)
    parts = ["'s", "'re", "'", "  ", " ", "\n", "\t", "a", "don't", "I'll", "'shall", "12", "3", "é", "ñ", "!!", "...",
             "\u0085", "x'", "''s", "<|endoftext|>", "日本", "_", "'d'm", "\r\n", "'S", "²", "\x1c", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(4000)]
    ids, at = packing.token_ids(pa.array([*texts, None]), TOKENIZER)
    want = Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)
    for i, w in enumerate(want):
        assert ids[at[i] : at[i + 1]].tolist() == w.ids, texts[i]
    assert at[-1] == at[-2]


def plain_best_fit(lengths, window):
    """One piece at a time, longest first, into the tightest window; fills of all windows."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(window - n)
    return sorted(window - r for r in room)


def test_a_batch_of_texts_is_split_at_once(monkeypatch):
    from tokenizers import Tokenizer

    whole, calls, split = Tokenizer.from_file(TOKENIZER), [], packing.split_words
    monkeypatch.setattr(packing, "split_words", lambda *args: calls.append(1) or split(*args))
    ends = ["it's", " 's", "'", "'s", "re", "'l", "l\n", "\n ", " ", "", "a \n b  c", "☃ it's", "é'd1", "we've", None, "x"]
    texts = [a if b is None else f"{a or ''}{b}" for a in ends for b in ends]
    ids, at = packing.token_ids(pa.array(texts, pa.string()), TOKENIZER)
    for text, a, b in zip(texts, at[:-1], at[1:]):
        assert ids[a:b].tolist() == whole.encode(text or "", add_special_tokens=False).ids, text
    assert len(calls) == 1


@pytest.mark.parametrize("seed", range(12))
def test_grouped_best_fit_equals_one_by_one(seed):
    rnd = random.Random(seed)
    window = rnd.choice([7, 16, 50])
    counts = {rnd.randint(1, window): rnd.randint(1, 30) for _ in range(rnd.randint(1, 14))}
    used = {}
    seen = {n: [] for n in counts}
    for length, first, count, sequence, offset, each in packing.best_fit_decreasing(counts, window):
        seen[length] += range(first, first + count)
        for k in range(count):
            used.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
    assert {n: sorted(s) for n, s in seen.items()} == {n: list(range(c)) for n, c in counts.items()}
    assert sorted(used) == list(range(len(used)))
    for pieces in used.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:]))
    fills = sorted(sum(n for _, n in p) for p in used.values())
    assert max(fills) <= window
    assert fills == plain_best_fit([n for n, c in counts.items() for _ in range(c)], window)


def check_pieces(df, got, window):
    library = Tokenizer.from_file(TOKENIZER)
    pieces, sequences = {}, {}
    for r in got.collect():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text in df.select("doc_id", "text").collect():
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        starts = {s: ids for s, ids, n in pieces[doc] if n == len(want)}
        assert [i for s in sorted(starts) for i in starts[s]] == want
    for mine in sequences.values():
        mine.sort()
        assert mine[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:]))
        assert mine[-1][0] + mine[-1][1] <= window
    total = sum(n for s in sequences.values() for _, n in s)
    return total / (window * len(sequences))


@pytest.mark.parametrize("window", [64, 2048])
def test_packing_documents(spark, window):
    df = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150").repartition(5)
    got = packing.pack(df, TOKENIZER, window=window)
    assert check_pieces(df, got, window) > 0.95


def test_packing_awkward_rows(spark):
    df = awkward(spark)
    got = packing.pack(df.where("doc_id is not null"), TOKENIZER)
    check_pieces(df.where("doc_id is not null"), got, 2048)
    assert packing.pack(df, TOKENIZER, with_ids=False).where("doc_id is null").count() == 2
    assert packing.pack(df.limit(0), TOKENIZER).count() == 0
