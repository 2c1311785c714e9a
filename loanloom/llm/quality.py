"""Quality classifier: weak labellers, their accuracies by EM, and a hashed linear scorer."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.arrays import U64

LABELLERS = ("symbols", "capitals", "repeats", "echoes", "runs", "bars", "marks", "lengths", "sentences")
GOOD, BAD, ABSTAIN = 0, 1, 2
#: Bytes of text looked at together: each takes about two hundred bytes of arrays.
PIECE = 1 << 19

_UPPER, _LOWER, _DIGIT, _BLANK, _PLAIN, _SYMBOL = range(6)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[128:] = _LOWER
_KIND[ord("A") : ord("Z") + 1] = _UPPER
_KIND[ord("a") : ord("z") + 1] = _LOWER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[0x20, *range(0x09, 0x0E)]] = _BLANK
_KIND[[ord(c) for c in ".,;:?!'\"-()/"]] = _PLAIN
#: A byte's shape: letters, digits and white space by kind, other characters themselves.
_SHAPE = np.where(
    _KIND == _UPPER, ord("A"), np.where(_KIND == _LOWER, ord("a"), np.where(
        _KIND == _DIGIT, ord("0"), np.where(_KIND == _BLANK, ord(" "), np.arange(256))))
).astype(np.uint64)


def _per_text(at: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Number of set marks in each text."""
    total = np.concatenate([[0], np.cumsum(marks)])
    return (total[at[1:]] - total[at[:-1]]).astype(float)


class Facts:
    """What the labellers and the scorer look at, for all texts of a batch at once."""

    def __init__(self, texts: pa.Array):
        data, at = arrays.flat(texts)
        self.data, self.at, self.texts = data, at, len(at) - 1
        kind = _KIND[data]
        start, end, owner = arrays.words(data, at)
        word = arrays.span_hash(arrays.prefix_hash(data), start, end)
        again = np.zeros(len(word), bool)
        again[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
        echo = np.zeros(len(word), bool)
        echo[2:] = (word[2:] == word[:-2]) & (owner[2:] == owner[:-2])
        run = again & echo
        run[1:] &= again[:-1] & echo[:-1]
        self.owner, self.again = owner, again

        def words_with(mark):
            return np.bincount(owner, weights=mark, minlength=self.texts)

        last = data[end - 1] if len(end) else data
        double = np.zeros(len(data) + 1, np.int64)
        if len(data) > 1:
            pair = (data[1:] == data[:-1]) & ((kind[1:] == _SYMBOL) | (data[1:] == ord("!")))
            double[2:] = np.cumsum(pair)
        self.size = np.maximum(_per_text(at, kind != _BLANK), 1)
        self.letters = _per_text(at, (kind == _UPPER) | (kind == _LOWER))
        self.upper = _per_text(at, kind == _UPPER)
        self.symbols = _per_text(at, kind == _SYMBOL)
        self.words = words_with(np.ones(len(owner)))
        self.repeats, self.echoes, self.runs = map(words_with, (again, echo, run))
        self.bars = words_with((end - start == 1) & (data[start] == ord("|")) if len(start) else again)
        self.ends = words_with((last == ord(".")) | (last == ord("?")) | (last == ord("!")))
        # a doubled mark inside a word: its second byte lies after the word's first
        self.marks = words_with((double[end] - double[np.minimum(start + 1, len(data))]) > 0)

    def votes(self) -> np.ndarray:
        """A row per text and a column per labeller: GOOD, BAD or ABSTAIN."""
        words = np.maximum(self.words, 1)
        enough = self.words >= 12

        def vote(bad, good, able):
            return np.where(~able, ABSTAIN, np.where(bad, BAD, np.where(good, GOOD, ABSTAIN)))

        length = self.size / words
        ends = self.ends / words
        return np.stack([
            vote(self.symbols / self.size > 0.08, self.symbols / self.size < 0.02, enough),
            vote(self.upper / np.maximum(self.letters, 1) > 0.4,
                 self.upper / np.maximum(self.letters, 1) < 0.15, enough),
            vote(self.repeats / words > 0.2, self.repeats / words < 0.04, enough),
            vote(self.echoes / words > 0.2, self.echoes / words < 0.06, enough),
            vote(self.runs / words > 0.15, self.runs == 0, enough),
            vote(self.bars / words > 0.1, self.bars == 0, enough),
            vote(self.marks / words > 0.15, self.marks / words < 0.01, enough),
            vote((length < 2) | (length > 18), (length > 3) & (length < 12), enough),
            vote(np.zeros(self.texts, bool), (ends > 0.02) & (ends < 0.3), self.words >= 30),
        ], 1).astype(np.int64)

    def features(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashed features: text, bucket and value of each occurrence.

        Shape four-grams of the bytes, each worth its share of the text, and word repeats,
        each worth its share of the words.
        """
        shape = _SHAPE[self.data]
        n = max(len(shape) - 3, 0)
        owner = np.repeat(np.arange(self.texts), np.diff(self.at))[:n]
        whole = np.searchsorted(self.at, np.arange(n) + 3, side="right") - 1 == owner
        key = shape[:n]
        for k in range(1, 4):
            key = key * U64(256) + shape[k : n + k]
        gram = (arrays.mix(key) % U64(buckets - 1)).astype(np.int64)[whole]
        owner = owner[whole]
        repeated = self.owner[self.again]
        value = np.concatenate([
            1 / np.maximum(np.diff(self.at), 1)[owner], 1 / np.maximum(self.words, 1)[repeated]
        ])
        return (np.concatenate([owner, repeated]),
                np.concatenate([gram, np.full(len(repeated), buckets - 1)]), value)


def _code(votes: np.ndarray) -> np.ndarray:
    return votes @ (3 ** np.arange(votes.shape[1]))


def _count_votes(batches):
    total = np.zeros(3 ** len(LABELLERS), np.int64)
    for batch in arrays.pieces(batches, "text", PIECE):
        total += np.bincount(_code(Facts(batch.column(0)).votes()), minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["code", "n"])


def estimate_accuracies(
    codes: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = 200
) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote patterns: share of bad, ``table[labeller, class, vote]``, posterior of bad.

    Labellers vote independently given the class, and abstaining says nothing about it. A
    posterior is kept for each of the ``3**labellers`` patterns. The start takes a bad vote
    as the better evidence; a little smoothing keeps every probability inside 0 and 1.
    """
    votes = codes[:, None] // 3 ** np.arange(labellers) % 3
    share = 0.1
    table = np.ones((labellers, 2, 3))  # a vote of ABSTAIN keeps its factor of 1
    table[:, 0, :ABSTAIN], table[:, 1, :ABSTAIN] = [0.98, 0.02], [0.6, 0.4]

    def posterior(v):
        each = np.log(np.stack([1 - share, share]))[None] + sum(
            np.log(table[k][:, v[:, k]]).T for k in range(labellers)
        )
        return 1 / (1 + np.exp(np.clip(each[:, 0] - each[:, 1], -700, 700)))

    for _ in range(rounds):
        if not counts.sum():
            break
        bad = posterior(votes)
        weight = np.stack([(1 - bad) * counts, bad * counts])
        share = float(np.clip(weight[1].sum() / counts.sum(), 1e-4, 0.5))
        new = np.ones_like(table)
        for k in range(labellers):
            for c in (0, 1):
                seen = np.bincount(votes[:, k], weights=weight[c], minlength=3)[:ABSTAIN] + 0.5
                new[k, c, :ABSTAIN] = seen / seen.sum()
        done = np.abs(new - table).max() < 1e-9
        table = new
        if done:
            break
    every = np.arange(3**labellers)
    return share, table, posterior(every[:, None] // 3 ** np.arange(labellers) % 3)


def _examples(batches, posterior, buckets):
    for batch in arrays.pieces(batches, "text", PIECE):
        facts = Facts(batch.column(1))
        bad = posterior[_code(facts.votes())]
        owner, bucket, value = facts.features(buckets)
        cell, back = np.unique(owner * buckets + bucket, return_inverse=True)
        total = np.bincount(back, weights=value, minlength=len(cell))
        cut = np.searchsorted(cell // buckets, np.arange(facts.texts + 1))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(bad),
                pa.array([(cell[a:b] % buckets).astype(np.int32) for a, b in zip(cut[:-1], cut[1:])], pa.list_(pa.int32())),
                pa.array([total[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.list_(pa.float64())),
            ],
            ["pick", "bad", "buckets", "values"],
        )


def fit_linear(
    rows: list, buckets: int, steps: int = 400, rate: float = 0.5, decay: float = 1e-5, prefer_good: float = 3.0
) -> np.ndarray:
    """Logistic weights (the last is the bias) for soft labels.

    A good document weighs ``prefer_good`` times a bad one of a balanced sample, so that a
    text that says little is kept.
    """
    weights = np.zeros(buckets + 1)
    if not rows:
        weights[-1] = 5.0
        return weights
    owner = np.repeat(np.arange(len(rows)), [len(r.buckets) for r in rows])
    bucket = np.concatenate([np.asarray(r.buckets, np.int64) for r in rows])
    value = np.concatenate([np.asarray(r["values"], float) for r in rows])
    good = 1 - np.array([r.bad for r in rows])
    each = prefer_good * good / max(good.sum(), 1e-9) + (1 - good) / max((1 - good).sum(), 1e-9)
    each /= each.sum()
    square = np.zeros(buckets + 1)
    for _ in range(steps):
        z = np.bincount(owner, weights=weights[bucket] * value, minlength=len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - good) * each
        slope = np.append(np.bincount(bucket, weights=error[owner] * value, minlength=buckets), error.sum())
        slope[:-1] += decay * weights[:-1]
        square += slope**2
        weights -= rate * slope / np.sqrt(square + 1e-12)
    return weights


class Model:
    """Labeller accuracies, posterior per vote pattern, and the scorer's weights."""

    def __init__(self, share, table, posterior, weights):
        self.share, self.table, self.posterior, self.weights = share, table, posterior, weights

    def judge(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vote pattern, posterior of bad, and score (probability of good) of each text."""
        facts = Facts(texts)
        code = _code(facts.votes())
        owner, bucket, value = facts.features(len(self.weights) - 1)
        z = np.bincount(owner, weights=self.weights[bucket] * value, minlength=facts.texts) + self.weights[-1]
        score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        blank = np.bincount(owner, minlength=facts.texts) == 0
        return code, self.posterior[code], np.where(blank, 1 - self.posterior[code], score)


def train(
    docs: DataFrame, text_column: str = "text", buckets: int = 1 << 12, sample_rows: int = 4000
) -> Model:
    """Fit the weak-label model on ``docs``; no given label is read.

    Votes of all documents are counted per pattern (``3**9`` numbers at most), and EM runs
    on these counts. The scorer is fitted on a bounded sample: of the documents with
    posterior below and above one half, the ``sample_rows`` with the smallest hash each.
    """
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    counted = source.mapInArrow(_count_votes, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    share, table, posterior = estimate_accuracies(
        counted["code"].to_numpy(int), counted["n"].to_numpy(float), len(LABELLERS)
    )
    bad_rows = float(counted["n"].to_numpy(float) @ (posterior[counted["code"].to_numpy(int)] >= 0.5))
    rows = float(counted["n"].sum())
    picked = source.withColumn("pick", F.xxhash64("text"))
    chosen = []
    for bad, n in ((False, rows - bad_rows), (True, bad_rows)):
        if not n:
            continue
        # only hashes below this can be among the smallest; copies of a text share one
        part = min(1.0, 8 * sample_rows / n)
        cut = int(-(2**63) + part * (2**64 - 1)) if part < 1 else 2**63 - 1
        examples = picked.where(F.col("pick") <= cut).select("pick", "text").mapInArrow(
            partial(_examples, posterior=posterior, buckets=buckets),
            "pick long, bad double, buckets array<int>, values array<double>",
        )
        side = F.col("bad") >= 0.5 if bad else F.col("bad") < 0.5
        chosen += examples.where(side).dropDuplicates(["pick"]).orderBy("pick").limit(sample_rows).collect()
    return Model(share, table, posterior, fit_linear(chosen, buckets))


def _judge(batches, model, at):
    model = model.value
    for batch in batches:
        codes, bads, scores = [], [], []
        for piece in arrays.pieces(iter([batch]), batch.schema.names[at], PIECE):
            code, bad, score = model.judge(piece.column(at))
            codes.append(code), bads.append(bad), scores.append(score)
        extra = [pa.array(np.concatenate(x)) for x in (codes, bads, scores)] if codes else []
        if extra:
            yield pa.RecordBatch.from_arrays(
                [*[c for i, c in enumerate(batch.columns) if i != at], *extra],
                [*[c for i, c in enumerate(batch.schema.names) if i != at], "code", "bad", "score"],
            )


def classify(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", least: float = 0.5
) -> DataFrame:
    """A row per document: the id, ``score`` (probability of good), ``kept``, the weak
    label's ``posterior_bad`` and a vote column per labeller (0 good, 1 bad, 2 abstain).

    ``kept`` is decided by the scorer: ``score >= least``. Whole texts are read. Null or
    empty text, or one of under four bytes, has no features: its score is one less the
    posterior, so it is kept unless the model holds most documents bad. Repeated rows give equal rows. A projection, no shuffle.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    source = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(
        partial(_judge, model=shared, at=1), f"id {kind}, code long, bad double, score double"
    )
    votes = [
        F.expr(f"cast(code div {3 ** k} % 3 as int)").alias(f"vote_{name}") for k, name in enumerate(LABELLERS)
    ]
    return found.select(
        F.col("id").alias(id_column), "score", (F.col("score") >= least).alias("kept"),
        F.col("bad").alias("posterior_bad"), *votes,
    )


def _keep(batches, model, at, least):
    model = model.value
    for batch in batches:
        for piece in arrays.pieces(iter([batch]), batch.schema.names[at], PIECE):
            yield piece.filter(pa.array(model.judge(piece.column(at))[2] >= least))


def keep_good(docs: DataFrame, model: Model, text_column: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the documents that :func:`classify` rejects; all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(
        partial(_keep, model=shared, at=docs.columns.index(text_column), least=least), docs.schema
    )
