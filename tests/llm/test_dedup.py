from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from loanloom.llm import arrays, exact, graph, lines, minhash, repeats
from tests.llm.data import awkward, near_copies


def components(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [root(x) for x in range(n)]


# --- components ---


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    links += [(7, 7), (5, 5)]
    got = {r.node: r.component for r in graph.connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, 202: 200}


def test_components_of_no_links(spark):
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- exact ---


def test_exact_groups_equal_brute_force(spark):
    rows = [(i, t) for i, t in near_copies()] + [(100, "one"), (101, " one"), (102, "a\tb"), (103, "a \n b"), (104, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    normal = {i: re.sub("[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    for fan in (2, 8):
        got = {r.doc_id: r for r in exact.exact_groups(df, fan=fan).collect()}
        for i, t in normal.items():
            same = [j for j, u in normal.items() if u == t]
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (min(same), len(same), i == min(same))
            assert got[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("fan, run", [(2, 3), (3, 1), (8, 50)])
def test_runs_of_many_ranges_equal_brute_force(spark, fan, run):
    rows = [(f"d{i * 7 % 400:03d}" if i % 9 else None, f"text {i % 90}") for i in range(400)]
    df = spark.createDataFrame(rows, "name string, text string").repartition(13)
    for text, size in Counter(t for _, t in rows).items():
        assert size in (4, 5) and text
    least = {}
    for name, text in rows:
        least[text] = min(least.get(text, (True, "")), (name is None, name or ""))
    got = exact.exact_groups(df, "name", fan=fan, run=run).collect()
    digest = {hashlib.sha256(t.encode()).hexdigest(): t for t in least}
    assert len(got) == 400 and sum(r.kept for r in got) == 90
    sizes = Counter(t for _, t in rows)
    for r in got:
        text = digest[r.text_sha256]
        assert (r.keep_id is None, r.keep_id or "") == least[text] and r.group_size == sizes[text]


def test_merge_is_ordered_verified_and_cut():
    def entry(first, length, row, size=1):
        return {"digest": bytes([first]) * 32, "verifier": {"bytes": length, "hash": 1},
                "least": {"none": False, "id": row, "row": row}, "size": size}

    runs = [[entry(1, 5, 9), entry(200, 5, 4)], [entry(1, 5, 3, 2), entry(1, 6, 1), entry(90, 5, 2)], [entry(255, 5, 8)]]
    kind = pa.list_(pa.struct({
        "digest": pa.binary(), "verifier": pa.struct({"bytes": pa.int32(), "hash": pa.int64()}),
        "least": pa.struct({"none": pa.bool_(), "id": pa.int64(), "row": pa.int64()}), "size": pa.int64(),
    }))
    table = pa.table({"node": pa.array([0] * 3, pa.int32()), "range": pa.array([0] * 3), "run": pa.array(runs, kind)})
    out = exact._merge((pa.scalar(0, pa.int32()), pa.scalar(0)), table, 2).to_pylist()
    assert [r["range"] for r in out] == [0, 1] and {r["node"] for r in out} == {0}
    assert [r["run"] for r in out] == [
        [entry(1, 5, 3, 3), entry(1, 6, 1), entry(90, 5, 2)], [entry(200, 5, 4), entry(255, 5, 8)],
    ]


def test_exact_awkward_rows(spark):
    df = awkward(spark)
    got = exact.exact_groups(df)
    assert got.count() == df.count()
    assert {(r.doc_id, r.kept) for r in got.where("group_size = 3 and length(text_sha256) = 64").collect()} == {
        (1, True), (1, False), (None, False), (3, True), (4, False)
    }
    kept = exact.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "5", "6", "7"]
    assert exact.exact_groups(df.limit(0)).count() == 0
    assert exact.keep_first(df.limit(0)).count() == 0


# --- near duplicates ---


def shingle_set(text, width):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return set()
    return {tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))}


@pytest.mark.parametrize("width,percent", [(2, 80), (5, 80), (1, 50)])
def test_near_duplicates_equal_brute_force(spark, width, percent):
    rows = near_copies(seed=width)
    sets = [shingle_set(t, width) for _, t in rows]
    want = components(len(rows), lambda a, b: bool(sets[a] and sets[b]) and
                      100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bands, size = (40, 6) if percent == 80 else (60, 2)
    got = minhash.near_duplicates(df, width=width, percent=percent, bands=bands, rows=size)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in range(len(rows))
    }


def test_near_duplicates_of_a_hub_that_links_few(spark):
    # a chain: neighbours are linked, others are not, and one band may hold them all
    base = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join(f"x{i}" if i < 3 * k else w for i, w in enumerate(base))) for k in range(25)]
    sets = [shingle_set(t, 2) for _, t in rows]
    want = components(25, lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(enumerate(want))


def test_near_duplicates_awkward_rows(spark):
    df = awkward(spark)
    got = minhash.near_duplicates(df)
    assert got.count() == df.count()
    found = {(r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in got.collect()}
    assert found == {
        (1, True, 1, True), (2, True, 1, False), (None, True, 1, False), (None, False, None, True),
        (3, False, 3, True), (4, False, 4, True), (5, True, 5, True), (6, True, 5, False), (7, True, 7, True),
    }
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "7", "None"]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_sketch_estimates_similarity_and_fills_every_coordinate():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for share, n in ((0.8, 400), (0.5, 60), (0.8, 2000)):
        common = int(n * 2 * share / (1 + share))
        a, b = items[:n], np.concatenate([items[:common], items[n : 2 * n - common]])
        x, y = minhash.sketch(a, 240), minhash.sketch(b, 240)
        assert x.max() < np.iinfo(np.int64).max
        assert abs((x == y).mean() - common / (2 * n - common)) < 0.12
    one = minhash.sketch(items[:1], 240)
    assert (one == minhash.sketch(items[:1], 240)).all() and len(one) == 240


# --- lines ---


def test_lines_equal_brute_force(spark):
    rnd = random.Random(3)
    pool = []
    for _ in range(40):
        line = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(rnd.randint(2, 25)))
        pool.append(line)
        for _ in range(3):
            other = list(line)
            for _ in range(rnd.randint(0, 3)):
                other[rnd.randrange(len(other))] = rnd.choice("abcxyz")
            pool.append("".join(other))
    pool += ["la " * 40, "la " * 41, "", "short", "Short ", "abcdefghijkl", "abcdefghijklm"]
    rnd.shuffle(pool)
    docs = [(i, "\n".join(pool[5 * i : 5 * i + 5])) for i in range(len(pool) // 5 + 1)]
    flat = [(d, k, t.lower().strip(" ").encode()) for d, text in docs for k, t in enumerate(text.split("\n"))]
    sets = [{t[i : i + 8] for i in range(len(t) - 7)} for _, _, t in flat]

    def linked(a, b):
        same = flat[a][2] == flat[b][2]
        near = sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
        return bool(flat[a][2]) and bool(same or near)

    want = components(len(flat), linked)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.line_no): r.kept for r in lines.line_components(df).collect()}
    assert got == {(d, k): not t or want[i] == i for i, (d, k, t) in enumerate(flat)}
    texts = {r.doc_id: r.text for r in lines.drop_lines(df).collect()}
    assert texts == {d: "\n".join(t for k, t in enumerate(text.split("\n")) if got[d, k]) for d, text in docs}


def test_lines_with_a_common_passage_are_not_all_compared(spark, monkeypatch):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    passage = "".join(rng.choices(letters, k=70))
    tails = ["".join(rng.choices(letters, k=60)) for _ in range(90)]
    rows = [passage + t for t in tails]
    rows += [passage + t[:-k] + "0" * k for t in tails[::9] for k in (1, 4, 9, 16)]
    compared, plain = [], lines.materialize

    def counted(df, label):
        out = plain(df, label)
        if label == "pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(lines, "materialize", counted)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in lines.line_components(df).collect()}
    sets = [{t[k : k + 8] for k in range(len(t) - 7)} for t in rows]
    want = components(len(rows), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    smallest = {c: min(got[i].line_id for i in range(len(rows)) if want[i] == c) for c in want}
    assert {i: r.component for i, r in got.items()} == {i: smallest[c] for i, c in enumerate(want)}
    assert sum(compared) < 5 * len(rows)


def test_lines_of_small_open_bands_are_compared_by_sketch_first(spark, monkeypatch):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for _ in range(15):  # six lines with a passage, unlike otherwise, and near copies of the first two
        passage = "".join(rng.choices(letters, k=70))
        unlike = [passage + "".join(rng.choices(letters, k=60)) for _ in range(6)]
        rows += unlike + [t[:-k] + "0" * k for t in unlike[:2] for k in (2, 9)]
    compared, plain = [], lines.materialize

    def counted(df, label):
        out = plain(df, label)
        if label == "pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(lines, "materialize", counted)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in lines.line_components(df).collect()}
    sets = [{t[k : k + 8] for k in range(len(t) - 7)} for t in rows]
    want = components(len(rows), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    smallest = {c: min(got[i].line_id for i in range(len(rows)) if want[i] == c) for c in want}
    assert {i: r.component for i, r in got.items()} == {i: smallest[c] for i, c in enumerate(want)}
    assert compared[0] > 30 and compared[1] < 30


def test_sketches_leave_out_no_linked_line(spark):
    rng = random.Random(13)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, linked = [], []
    for i in range(400):
        one = "".join(rng.choices(letters, k=rng.randint(12, 300)))
        two = one + "".join(rng.choices(letters, k=rng.randint(1, len(one) // 4 + 1)))
        a, b = ({t[k : k + 8] for k in range(len(t) - 7)} for t in (one, two))
        linked += [100 * len(a & b) >= 80 * len(a | b)]
        rows += [(i, one), (i, two)]
    hashes = "transform(sequence(1, octet_length(line) - 7), i -> xxhash64(substring(line, i, 8)))"
    stored = spark.createDataFrame(rows, "pair long, text string").selectExpr("pair", "encode(text, 'UTF-8') as line")
    sets = stored.selectExpr("pair", "octet_length(line) as size", f"array_distinct({hashes}) as h").select(
        "pair", "size", F.size("h").alias("n"), F.expr(lines._SKETCH).alias("s")
    )
    x, y = sets.alias("x"), sets.alias("y")
    met = x.join(y, (F.col("x.pair") == F.col("y.pair")) & (F.col("x.size") < F.col("y.size")) & lines._likely(80))
    likely = {r.pair for r in met.select("x.pair").collect()}
    assert {i for i, near in enumerate(linked) if near} <= likely and 100 < sum(linked) < 400


def sketched(spark, rows):
    """Distinct lines as :func:`lines.line_components` stores them: sizes, sketches, marks."""
    hashes = "transform(sequence(1, octet_length(line) - 7), i -> xxhash64(substring(line, i, 8)))"
    stored = spark.createDataFrame(rows, "pair long, text string").selectExpr("pair", "encode(text, 'UTF-8') as line")
    return stored.selectExpr(
        "pair", "xxhash64(line) as node", "line", "octet_length(line) as size", f"array_distinct({hashes}) as h"
    ).select(
        "pair", "node", "line", "size", F.size("h").alias("n"), F.expr(lines._SKETCH).alias("s")
    ).select("*", *lines._marks())


def test_marks_let_all_likely_lines_pass_and_few_others(spark):
    rng = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for i in range(400):
        one = "".join(rng.choices(letters, k=rng.randint(12, 300)))
        rows += [(i, one), (i, one + "".join(rng.choices(letters, k=rng.randint(1, len(one) // 4 + 1))))]
    sets = sketched(spark, rows)
    x, y = sets.alias("x"), sets.alias("y")
    for percent in (80, 60):
        near = x.join(y, (F.col("x.pair") == F.col("y.pair")) & (F.col("x.size") < F.col("y.size")))
        met = near.select("x.pair", lines._likely(percent).alias("likely"), lines._alike(percent).alias("alike")).collect()
        assert len(met) == 400 and all(r.alike for r in met if r.likely) and sum(r.likely for r in met) > 100
    other = x.join(y, F.col("x.pair") < F.col("y.pair")).where("greatest(x.n, y.n) > 48").select(
        F.count_if(lines._alike(80)).alias("alike"), F.count(F.lit(1)).alias("all")
    ).first()
    assert other["alike"] < other["all"] / 1000


def test_rare_shingles_meet_without_the_sets_of_their_lines(spark):
    rng = random.Random(15)
    one = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=130))
    rows = [(k, one[: 130 - k] + "0" * k) for k in range(0, 40, 4)]
    stored = sketched(spark, rows).withColumn("component", F.col("node"))
    found = lines._rare_pairs(stored, 8, 80)
    plan = found._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    for side in (plan.left(), plan.right()):
        assert "item:bigint" in side.schema().simpleString() and "array" not in side.schema().simpleString()
    node = {r.pair: r.node for r in stored.collect()}
    sets = {node[i]: {t[k : k + 8] for k in range(len(t) - 7)} for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert want <= {(r.a, r.b) for r in found.collect()} and len(want) > 10


def test_bands_travel_in_few_bits_and_texts_in_parts(spark, monkeypatch):
    rng = random.Random(16)
    letters = "abcdefghijklmnopqrstuvwxyz"
    passage = "".join(rng.choices(letters, k=70))
    tails = ["".join(rng.choices(letters, k=60)) for _ in range(30)]
    rows = [passage + t for t in tails] + [passage + t[:-k] + "0" * k for t in tails[::5] for k in (1, 9, 16)]
    seen, plain = {}, lines.materialize

    def kept(df, label):
        out = plain(df, label)
        if label in ("bands", "shared"):
            seen.setdefault(label, []).append(out.select("key", "stub").collect() if label == "bands" else out.count())
        return out

    monkeypatch.setattr(lines, "materialize", kept)
    monkeypatch.setattr(lines, "FEW", 8)
    monkeypatch.setattr(lines, "WHOLE", 0)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in lines.line_components(df).collect()}
    sets = [{t[k : k + 8] for k in range(len(t) - 7)} for t in rows]
    want = components(len(rows), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    smallest = {c: min(got[i].line_id for i in range(len(rows)) if want[i] == c) for c in want}
    assert {i: r.component for i, r in got.items()} == {i: smallest[c] for i, c in enumerate(want)}
    assert all(r.key % (1 << 16) == 0 and 0 <= r.stub < 1 << 40 for r in seen["bands"][0])
    assert len(seen["shared"]) == lines.PARTS and sum(seen["shared"]) <= len(rows)


def test_lines_that_differ_by_white_space(spark):
    rows = [(1, "one two three\r\n\r\nshort\r\n \t\r\nlast line\f"), (2, "one\ttwo  three\n\nshort\n\t\nLAST\x0b line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line_no): (r.kept, r.n_copies) for r in lines.line_components(df).collect()}
    assert got == {(d, k): (d == 1, 2) if k % 2 == 0 else (True, 1) for d in (1, 2) for k in range(5)}
    kept = {r.doc_id: r.text for r in lines.drop_lines(df).collect()}
    assert kept == {1: rows[0][1], 2: "\n\t"}


def test_repetitive_lines_have_whole_signatures(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(200):
        part = "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(30, 60)))
        rows.append((part * rnd.randint(2, 5),))
    df = spark.createDataFrame(rows, "line string").selectExpr("encode(line, 'UTF-8') as line")
    got = lines._signatures(df, 8).collect()
    assert len(got) == 200 and all(len(r.s) == 24 and r.s == sorted(set(r.s)) for r in got)


def test_lines_use_no_python(spark):
    plan = lines.line_components(spark.createDataFrame([(1, "a line of text\nanother")], "doc_id long, text string"))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_lines_awkward_rows(spark):
    df = awkward(spark)
    got = lines.line_components(df)
    assert got.count() == df.count() + 1
    assert got.where("doc_id = 1 and kept").count() == 1
    assert lines.drop_lines(df).columns == df.columns
    assert lines.drop_lines(df).where("text is null").count() == 2
    assert lines.line_components(df.limit(0)).count() == 0


def test_lines_leave_no_texts_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")

    def left():
        return {f for f in os.listdir(shared) if f.startswith(("texts-", "shared-"))} if os.path.isdir(shared) else set()

    before, docs = left(), near_copies(seed=5)
    got = lines.line_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert left() == before
    assert got.where("not kept").count() > 0 and left() == before


@pytest.mark.parametrize("other", ["  ", "\t", "\x0b", "\f", "\r", " \t\r "])
def test_each_white_space_alone_is_one_blank(spark, other):
    df = spark.createDataFrame([(1, "some words here"), (2, f"some{other}words here")], "doc_id long, text string")
    assert lines.line_components(df).select("line_id").distinct().count() == 1


# --- repeats ---


def brute_repeats(rows, length):
    first = {}
    for key, text in rows:
        for p in range(len(text) - length + 1):
            w = text[p : p + length]
            first[w] = min(first.get(w, key), key)
    out = {}
    for key, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - length + 1):
            if first[text[p : p + length]] < key:
                gone[p : p + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        left = bytes(b for b, g in zip(text, gone) if not g)
        out[key] = (len(text), int(gone.sum()), runs, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("letters,length,slice_bytes", [("ab", 8, 700), ("abcdefgh ", 10, 10**6), ("aé", 12, 700)])
def test_repeats_equal_brute_force(spark, letters, length, slice_bytes):
    rnd = random.Random(length)

    def some(n):
        return "".join(rnd.choice(letters) for _ in range(n))

    pool = [some(rnd.randint(5, 60)) for _ in range(6)]
    rows = [(i, "".join(rnd.choice(pool) if rnd.random() < 0.7 else some(rnd.randint(0, 20))
                        for _ in range(rnd.randint(0, 8)))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeats.remove_repeats(df, length=length, gram=3, slice_bytes=slice_bytes, with_text=False)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute_repeats([(i, t.encode()) for i, t in rows], length)


def test_maximal_intervals_of_a_known_word():
    text = b"mississippi"
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = [0] + [next(k for k in range(12) if text[a + k : a + k + 1] != text[b + k : b + k + 1] or b + k >= 11)
                    for a, b in zip(order[1:], order)]
    before = np.array([text[i - 1] if i else -1 for i in order])
    found = {(text[order[a] : order[a] + n], b - a + 1)
             for a, b, n in repeats.maximal_intervals(np.array(common), before)}
    assert found == {(b"i", 4), (b"issi", 2), (b"p", 2), (b"s", 4)}


def test_repeat_groups_hold_all_occurrences(spark):
    shared = "this passage of more than twenty bytes is shared"  # two rows may share the blank at an end too
    rows = [(1, "aaa " + shared + " bbb"), (2, "cc " + shared), (3, shared + " dd"), (4, "nothing in common here")]
    groups = repeats.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string"), length=20, gram=6).collect()
    assert {r.doc_id for r in groups} == {1, 2, 3} and all(r.first_key == 1 for r in groups)
    texts = dict(rows)
    for g in {r.group for r in groups}:
        mine = [texts[r.doc_id][r.start : r.start + r.length] for r in groups if r.group == g]
        assert len(set(mine)) == 1 and len(mine) >= 2 and len(mine[0]) >= 20
        # maximal: all that hold the string are in its group
        assert len(mine) == sum(t.count(mine[0]) for _, t in rows)


@pytest.mark.parametrize("slice_bytes", [150, 10**6])
def test_repeat_groups_over_several_slices(spark, slice_bytes):
    rnd = random.Random(5)

    def some(n):
        return "".join(rnd.choice("abcdefgh ") for _ in range(n))

    passages = [some(300) for _ in range(3)]
    rows = [(i, some(30) + "#".join([passages[i % 3], some(40), passages[(i + 1) % 3]]) + some(30)) for i in range(9)]
    rows += [(20, some(500)), (21, some(20) + passages[0][100:200] + some(20))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    groups = repeats.repeat_groups(df, length=20, gram=6, slice_bytes=slice_bytes).collect()
    texts = dict(rows)
    found = {}
    for g in groups:
        found.setdefault(g.group, []).append((texts[g.doc_id][g.start : g.start + g.length], g.doc_id, g.first_key))
    for mine in found.values():
        assert len({t for t, _, _ in mine}) == 1
        assert len(mine) == sum(t.count(mine[0][0]) for _, t in rows)
        assert {k for _, _, k in mine} == {min(d for _, d, _ in mine)}
    whole = {mine[0][0] for mine in found.values()}
    # passages of one set of occurrences are one repeat
    assert all(any(p in w for w in whole) for p in passages[1:])
    assert passages[0][100:200] in whole
    assert len({(mine[0][0]) for mine in found.values()}) == len(found)


def test_a_heavy_minimiser_is_dealt_over_slices(spark):
    rnd = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = np.frombuffer("".join(rnd.choice(letters) for _ in range(80_000)).encode(), np.uint8)
    at = np.arange(0, len(names), 8)
    low = at[np.argmin(arrays.span_hash(arrays.prefix_hash(names), at, at + 8))]
    gram = bytes(names[low : low + 8]).decode()
    rows = [(i, "".join(gram + "".join(rnd.choice(letters) for _ in range(30)) for _ in range(20))) for i in range(40)]
    rows += [(50 + i, t[: 300 + i]) for i, t in rows[:5]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    strings, _ = repeats._sliced(repeats._source(df, "doc_id", "text"), 50, 8, 4_000)
    sizes = {}
    for r in strings.collect():
        sizes[r.slice] = sizes.get(r.slice, 0) + len(zstandard.ZstdDecompressor().decompress(r.bytes))
    assert max(sizes.values()) < 3 * 4_000 and len(sizes) > 50
    got = repeats.remove_repeats(df, slice_bytes=4_000, with_text=False)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute_repeats([(i, t.encode()) for i, t in rows], 50)


def test_windows_of_a_heavy_minimiser_are_found_without_hashing_the_piece_again(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdé ", k=n)) for n in (300, 0, 40, 5_000, 50, 90_000, 700, 20_000)]
    texts += ["ab" * 400, texts[3]]
    raw = [t.encode() for t in texts]
    pack = lambda values, kind: [repeats._zip(np.array(values, kind))]
    names = np.unique(repeats.stretches(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 50, 24)[3])
    codes = np.arange(len(names)) % 3  # alone, in several texts, heavy
    piece = repeats.Piece(pa.RecordBatch.from_pydict({
        "piece": [0], "keys": pack(range(len(raw)), np.int64), "documents": pack(range(len(raw)), np.int64),
        "lengths": pack([len(r) for r in raw], np.int64), "bytes": pack(np.frombuffer(b"".join(raw), np.uint8), np.uint8),
        "known": [[{"bucket": 0, "codes": repeats._zip(codes.astype(np.uint8))}]],
    }), 0)
    hashed, plain = [], repeats.stretches
    monkeypatch.setattr(repeats, "stretches", lambda data, *a: hashed.append(len(data)) or plain(data, *a))
    begin, end, owner, text, slot, low = piece.shared_strings(50, 24, 1, 7)
    assert sum(hashed) == len(piece.data)

    def span(a, n):  # of equal bytes anywhere
        return arrays.hash_spans(piece.data, np.array([a]), np.array([a + n]))[0]

    got = Counter()
    for a, b, o, t, s in zip(begin.tolist(), end.tolist(), owner.tolist(), text, slot.tolist()):
        assert piece.at[o] <= a and b <= piece.at[o + 1] and t == span(a, b - a)
        got.update({(i, s): 1 for i in range(a, b - 49)})
    want = Counter()
    for a, b in zip(piece.at[:-1].tolist(), piece.at[1:].tolist()):
        grams = arrays.hash_spans(piece.data, np.arange(a, b - 23), np.arange(a, b - 23) + 24) if b - a >= 50 else []
        for i in range(a, b - 49):
            least = grams[i - a : i - a + 27].min()
            code = codes[np.searchsorted(names, least)]
            if code:
                key = span(i, 50) if code == repeats.HEAVY else least
                want[i, int(arrays.mix(np.array([key]))[0] % 7)] += 1
    assert got == want


def test_repeats_awkward_rows(spark):
    df = awkward(spark)
    got = repeats.remove_repeats(df)
    assert got.count() == df.count()
    by_id = {r.doc_id: r for r in got.where("doc_id is not null").collect()}
    assert by_id[6].n_removed == by_id[5].n_bytes and by_id[6].n_spans == 1 and bytes(by_id[6].kept) == b" end"
    assert by_id[5].n_removed == 0 and by_id[4].n_bytes == 0
    assert repeats.remove_repeats(df.limit(0)).count() == 0
