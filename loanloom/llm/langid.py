"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import sys
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.arrays import U64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Every letter to its lower case, all other code points to 0."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        if (char := chr(code)).isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def grams(texts: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-gram buckets of all texts, the text of each, and whether a text has letters.

    Letters are lower-cased and every run of other characters is one separator, so words
    keep their edges; n-grams across a separator only touch it.
    """
    codes = np.frombuffer("\0\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes_ = np.array([0, *map(len, texts), 0]) + 2
    owner = np.repeat(np.arange(-1, len(texts) + 1), sizes_)[: len(codes)]
    letter = _letters()[codes]
    keep = letter > 0
    keep[1:] |= letter[:-1] > 0  # the first separator after a letter
    keep[:-1] |= (letter[1:] > 0) & (owner[1:] != owner[:-1])  # and one before the first
    letter, owner = letter[keep].astype(U64), owner[keep]
    has = np.zeros(len(texts) + 2, bool)
    has[owner[letter > 0] + 1] = True
    found, of = [], []
    for size in sizes:
        if len(letter) < size:
            continue
        n = len(letter) - size + 1
        key = np.full(n, size, U64)
        inner = np.zeros(n, bool)
        for k in range(size):
            key = key * U64(0x9E3779B97F4A7C15) + letter[k : k + n]
            inner |= (letter[k : k + n] == 0) if 0 < k < size - 1 else False
        good = ~inner & (letter[size // 2 : size // 2 + n] > 0) if size < 3 else ~inner
        found.append((arrays.mix(key)[good] % U64(buckets)).astype(np.int64))
        of.append(owner[:n][good] if size < 2 else owner[1 : n + 1][good])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has[1:-1]
    found, of = np.concatenate(found), np.concatenate(of)
    inside = (of >= 0) & (of < len(texts))
    return found[inside], of[inside], has[1:-1]


def _count(batches, langs, sizes, buckets):
    place = {lang: i for i, lang in enumerate(langs)}
    total = np.zeros(len(langs) * buckets, np.int64)
    for batch in arrays.pieces(batches, "text", 1 << 19):
        of_lang = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
        bucket, owner, _ = grams(batch.column(0).fill_null("").to_pylist(), sizes, buckets)
        total += np.bincount(of_lang[owner] * buckets + bucket, minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used // buckets), pa.array(used % buckets), pa.array(total[used])], ["lang", "bucket", "n"]
    )


class Model:
    """Languages, and a log-probability per bucket and language."""

    def __init__(self, langs: list[str], prior: np.ndarray, weight: np.ndarray, sizes: tuple[int, ...]):
        self.langs, self.prior, self.weight, self.sizes = langs, prior, weight, sizes

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language's number, its posterior probability, and whether the text has letters."""
        bucket, owner, has = grams(texts, self.sizes, len(self.weight))
        total = np.tile(self.prior, (len(texts), 1))
        for k in range(len(self.langs)):
            total[:, k] += np.bincount(owner, weights=self.weight[bucket, k], minlength=len(texts))
        best = total.argmax(1)
        top = total[np.arange(len(texts)), best]
        return best, 1.0 / np.exp(total - top[:, None]).sum(1), has


def train(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    sizes: tuple[int, ...] = (1, 2, 3),
    buckets: int = 1 << 16,
    smoothing: float = 0.5,
    max_langs: int = 1000,
) -> Model:
    """Count n-grams per language over all of ``docs`` with text and a language.

    Each task adds up its own matrix; only sums meet, at most ``buckets`` times the number
    of languages, which is the model's size. More than ``max_langs`` languages are an error.
    """
    known = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")
    )
    share = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(max_langs + 1).collect()
    if len(share) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = [r.lang for r in share]
    if not langs:
        return Model([], np.zeros(0), np.zeros((buckets, 0)), sizes)
    counted = (
        known.mapInArrow(
            partial(_count, langs=langs, sizes=sizes, buckets=buckets), "lang long, bucket long, n long"
        )
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most buckets x languages numbers: the model itself
    )
    count = np.full((buckets, len(langs)), smoothing)
    count[counted["bucket"].to_numpy(int), counted["lang"].to_numpy(int)] += counted["n"].to_numpy(float)
    prior = np.log(np.array([r.n for r in share], float) / sum(r.n for r in share))
    return Model(langs, prior, np.log(count / count.sum(0)), sizes)


def _predict(batches, model):
    model = model.value
    for batch in arrays.pieces(batches, "text", 1 << 19):
        texts = batch.column(batch.num_columns - 1).fill_null("").to_pylist()
        if model.langs:
            best, score, has = model.score(texts)
            named = [model.langs[b] if h else "und" for b, h in zip(best.tolist(), has.tolist())]
            score = np.where(has, score, 0.0)
        else:
            named, score = ["und"] * len(texts), np.zeros(len(texts))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(named), pa.array(score)],
            [*batch.schema.names[:-1], "lang_pred", "score"],
        )


def predict(
    docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_column: str = "text"
) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score`` (posterior, 0 to 1) of whole texts.

    Only the text is read for a prediction; the model is broadcast once. Null text and
    text without letters give ``und`` and score 0, and so does a model without languages.
    Equal posteriors go to the language first in order. Repeated rows give equal rows.
    """
    spark = docs.sparkSession
    columns = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    source = docs.select(*columns, F.col(text_column).alias("text"))
    kinds = [f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    shared = spark.sparkContext.broadcast(model)
    found = source.mapInArrow(
        partial(_predict, model=shared), ", ".join([*kinds, "lang_pred string", "score double"])
    )
    return found.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score"
    )
