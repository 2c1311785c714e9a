"""Periodic runs, licences and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loanloom.llm import licences, periods, queries, resampling
from tests.llm.data import awkward

SF = "/root/testdata/sf0.001"
SPACE = re.compile("[^\x20\x09-\x0d]+")
PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


# --- periodic runs ------------------------------------------------------------------------


def brute_runs(words, exponent=4, least=6):
    """Every period on its own; a stretch counts when no smaller period fits it."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                part = words[i : j + q]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def repetitive(rnd):
    words = []
    for _ in range(rnd.randint(0, 5)):
        unit = [str(rnd.randrange(rnd.choice([1, 2, 3, 30]))) for _ in range(rnd.randint(1, 14))]
        words += (unit * 9)[: rnd.randint(1, len(unit) * 8)]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = [repetitive(rnd) for _ in range(rnd.randint(1, 12))]
    names = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    begin, stop, period = periods.find_runs(np.array([names[w] for t in texts for w in t], np.int64), bounds)
    got = sorted(zip(begin.tolist(), (stop - begin).tolist(), period.tolist()))
    want = [(s + int(bounds[i]), n, q) for i, t in enumerate(texts) for s, n, q in brute_runs(t)]
    assert got == sorted(want)


def test_runs_of_one_long_text():
    unit = [f"w{i}" for i in range(700)]
    words = ["x", *(unit * 5), "y", *(["a", "b"] * 4000), "z", *(["q"] * 9000)]
    names = {w: i for i, w in enumerate(sorted(set(words)))}
    number = np.array([names[w] for w in words], np.int64)
    found = periods.find_runs(number, np.array([0, len(words)]))
    got = sorted(zip(*(f.tolist() for f in found)))
    assert got == [(1, 3501, 700), (3502, 11502, 2), (11503, 20503, 1)]


def test_range_successor_equals_sorting():
    rnd = np.random.default_rng(5)
    values = rnd.permutation(300)
    low = rnd.integers(0, 300, 500)
    high = low + rnd.integers(0, 300 - low + 1)
    above = rnd.integers(-1, 320, 500)
    want = [min((v for v in values[a:b] if v > x), default=-1) for a, b, x in zip(low, high, above)]
    assert periods.successors(values, low, high, above).tolist() == want


def test_runs_below_exponent_four_are_refused():
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(8, np.int64), np.array([0, 8]), exponent=3)


def test_runs_query_equals_brute_force(spark):
    got = rows_of(queries.op11_internal_pattern_runs(spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        words = planted(doc.doc_id, SPACE.findall(doc.text or ""))
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        assert tuple(got[doc.doc_id]) == (
            doc.doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)),
        )


def test_planting_equals_its_statement(spark):
    rnd = random.Random(2)
    rows = [(i, " \t".join(f"w{rnd.randrange(9)}" for _ in range(rnd.randint(0, 40)))) for i in range(400)]
    rows += [(None, "a b c"), (401, None), (402, ""), (403, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in queries.with_planted_runs(docs).collect()}
    assert got[None] == "a b c"
    for i, text in rows:
        if i is not None:
            assert SPACE.findall(got[i] or "") == planted(i, SPACE.findall(text or ""))


def test_runs_awkward_rows(spark):
    docs = awkward(spark)
    found = periods.periodic_runs(docs).collect()
    assert len(found) == docs.count()
    by_text = {(r.doc_id, r.text) for r in docs.collect()}
    for r in found:
        texts = [t for i, t in by_text if i == r.doc_id]
        assert any(
            r.n_words == len(SPACE.findall(t or "")) and r.collapsed == collapsed(SPACE.findall(t or ""), [tuple(x) for x in r.runs])
            for t in texts
        )
    assert periods.periodic_runs(docs.limit(0)).count() == 0
    assert periods.periodic_runs(docs, id_column="id", text_column="line").columns[0] == "id"


# --- licences -----------------------------------------------------------------------------


def brute_base(words):
    out = []
    for label, phrase in licences.PHRASES:
        want = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return sorted(out)


def check_base(got, text):
    words = PLAIN.findall(lower(text or ""))
    base = brute_base(words)
    assert got.n_words == len(words) and got.n_base == len(base)
    assert (got.first_word, got.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
    labels = sorted({label for _, label in base})
    assert got.base_labels == ",".join(labels)
    assert set(labels) <= set(got.labels.split(",")) and got.labels == ",".join(sorted(set(got.labels.split(","))))
    assert 0 <= got.score <= 1 and (got.score > 0) == (got.labels != "")


def test_licence_query_equals_brute_force(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        got = rows_of(queries.op12_rare_word_licences(spark, sf))
        docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
        assert len(got) == len(docs)
        for doc in docs:
            check_base(got[doc.doc_id], doc.text)
    assert any(r.n_base for r in got.values())


def notices(name):
    return next(text for label, text, _ in licences.NOTICES if label == name)


def found_in(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: {m.label: m for m in r.matches} for r in licences.licences(rows).collect()}


def test_notices_need_their_phrases_and_bear_changed_words(spark):
    filler = " ".join(f"word{i}" for i in range(400))
    mit = notices("mit-notice")
    changed = mit.replace("any person", "any natural person or body")
    cut = mit.replace("free of charge", "for a fee")
    scattered = " ".join(w + " " + filler[: 90] for w in mit.split())
    got = found_in(spark, [
        f"{filler} {mit.upper()} {filler}", f"{filler}, {changed}.", cut, scattered, filler,
        notices("bsd-notice"), "Licensed under CC BY-NC 4.0.", "a license of MIT, mit-license; MIT\nLicense",
    ])
    assert got[0]["mit-notice"].score == 1 and got[0]["mit-notice"].word == 400
    assert got[1]["mit-notice"].word == 400
    assert "mit-notice" not in got[2] and "mit-notice" not in got[3] and not got[4]
    assert set(got[5]) == {"bsd-notice"} and set(got[6]) == {"cc-by-nc-4.0"}
    assert set(got[7]) == {"mit"}


def test_every_notice_is_found_where_it_stands(spark):
    texts = [f"one two three\n{text}" for _, text, _ in licences.NOTICES]
    for i, found in found_in(spark, texts).items():
        label = licences.NOTICES[i][0]
        assert found[label].word == 3 and found[label].score == pytest.approx(1)


def test_word_weights_count_every_text(spark):
    texts = ["Mit license", "mit MIT", None, "", "the licence"] * 7
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    weights = dict(zip(licences.VOCABULARY, licences.word_weights(rows)))
    assert weights["mit"] == math.log(36 / 15) + 1 and weights["license"] == math.log(36 / 8) + 1
    assert weights["the"] == math.log(36 / 8) + 1 and weights["cc"] == math.log(36) + 1


def test_licences_awkward_rows(spark):
    docs = awkward(spark)
    found = licences.licences(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words) for r in found) == sorted(
        (r.doc_id is None, r.doc_id or 0, len(PLAIN.findall(lower(r.text or "")))) for r in docs.collect()
    )
    assert licences.licences(docs.limit(0)).count() == 0


def test_non_ascii_words_are_not_cut(spark):
    got = found_in(spark, ["émit license", "mit license", "MIT Licenseé", "x-mit license"])
    assert [set(got[i]) for i in range(4)] == [set(), set(), set(), {"mit"}]


# --- importance resampling ------------------------------------------------------------------


def brute_features(text, longest):
    words = PLAIN.findall(lower(text or ""))
    return words, [
        " ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]


def brute_resample(docs, target, longest, buckets, percent, least, seed):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    source, goal = Counter(), Counter()
    for _, text in docs:
        source.update(map(bucket, brute_features(text, longest)[1]))
    for text in target:
        goal.update(map(bucket, brute_features(text, longest)[1]))
    all_s, all_t, rows = sum(source.values()), sum(goal.values()), []
    for i, text in docs:
        words, feats = brute_features(text, longest)
        weight = sum(
            math.floor(1000 * math.log((goal[b] + 1) * (all_s + buckets) / ((source[b] + 1) * (all_t + buckets))))
            for b in map(bucket, feats)
        )
        h = int(sha(f"{seed}:{i}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(words), len(feats), weight, score))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return {r[0]: (*r, rank.get(r[0])) for r in rows}


def test_resampling_query_equals_brute_force(spark):
    got = rows_of(queries.op13_importance_resampling(spark, SF))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute_resample(docs, target, 1, 10_000, 10, 20, 2024)
    for i, (_, _, n, weight, score, rank) in want.items():
        r = got[i]
        assert (r.n_features, r.weight, r.score, r["rank"]) == (n, weight, score, rank)
    assert len(got) == len(want) and any(r["rank"] for r in got.values())


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_longer_features_equal_brute_force(spark, longest):
    rnd = random.Random(longest)
    texts = [" ".join(rnd.choice("The a-b café 42 x_y Z.".split()) for _ in range(rnd.randint(0, 40))) for _ in range(150)]
    docs = list(enumerate([*texts, None, "", "  "]))
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    goal = spark.createDataFrame([(t,) for t in texts[:9]], "text string")
    got = resampling.resample(rows, goal, longest=longest, buckets=512, percent=33, least_words=3, seed=7)
    want = brute_resample(docs, texts[:9], longest, 512, 33, 3, 7)
    assert {r.doc_id: tuple(r) for r in got.collect()} == want


def test_blocks_do_not_change_features(monkeypatch):
    text = " ".join(f"W{i % 17}-{i % 5}" for i in range(300)).encode()
    whole = {n: sorted(c for _, codes in resampling.features(text, n) for c in codes) for n in (1, 2, 4)}
    for block in (1, 7, 64):
        monkeypatch.setattr(resampling, "BLOCK", block)
        for n, codes in whole.items():
            assert sorted(c for _, part in resampling.features(text, n) for c in part) == codes
            assert sum(k for k, _ in resampling.features(text, n)) == 600


def test_resampling_awkward_rows(spark):
    docs = awkward(spark)
    goal = docs.select("text")
    found = resampling.resample(docs, goal, percent=50, least_words=3).collect()
    assert len(found) == docs.count()
    able = sum(r.n_words >= 3 for r in found)
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, able // 2 + 1))
    drawn = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [r.score for r in drawn] == sorted((r.score for r in drawn), reverse=True)
    assert resampling.resample(docs.limit(0), goal).count() == 0
    assert resampling.resample(docs, goal.limit(0)).count() == docs.count()


def test_ranks_are_whole_over_many_ranges_and_ties(spark):
    rows = spark.range(5000).selectExpr("id", "id % 3 as score")
    from pyspark.sql import functions as F

    got = resampling.ranked(rows, [F.desc("score"), F.asc("id")], parts=13).collect()
    assert [r.id for r in sorted(got, key=lambda r: r["rank"])] == sorted(range(5000), key=lambda i: (-(i % 3), i))
    assert sorted(r["rank"] for r in got) == list(range(1, 5001))
