"""The registered query of each operator, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import (
    exact,
    langid,
    licences,
    lines,
    minhash,
    neighbours,
    packing,
    periods,
    quality,
    repeats,
    resampling,
    secrets,
    wordpieces,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def op1_inverted_multi_index(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 20 = 0"), by_row=True)


def op2_naive_bayes_languages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    model = langid.train(docs.where(remainder != 0))
    marked = docs.withColumn("held_out", F.coalesce(remainder == 0, F.lit(False)))
    return langid.predict(marked, model, keep=("doc_id", "held_out"))


def op3_weak_label_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality.classify(docs, quality.train(docs))


def op4_secret_ownership(spark, sf_dir):
    return secrets.scan(documents(spark, sf_dir)).drop("row", "found")


def op5_repeat_intervals(spark, sf_dir):
    return repeats.remove_repeats(documents(spark, sf_dir), with_text=False)


def op6_fuzzy_lines(spark, sf_dir):
    return lines.line_components(documents(spark, sf_dir)).drop("row")


def op7_sentencepiece_offsets(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return wordpieces.encode(documents(spark, sf_dir), model, with_pieces=False, with_spans=True)


def op8_exact_tree_merge(spark, sf_dir):
    return exact.exact_groups(documents(spark, sf_dir))


def op9_similarity_sketches(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir), width=2, percent=80)


def op10_best_fit_packing(spark, sf_dir):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(documents(spark, sf_dir), tokenizer, with_ids=False)


def with_planted_runs(docs):
    """Every tenth document by its hash goes on repeating a stretch of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = r"regexp_extract_all(text, '([^\\x20\\x09-\\x0D]+)', 1)"
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), F.expr(words))
    )
    g = F.floor(F.col("h") / 10)
    sized = chosen.withColumn("n", F.when(F.size("w") > 0, F.size("w"))).withColumn(
        "a", (g % F.col("n")).cast("int")
    ).withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    again = F.expr(
        "slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)"
    )
    planted = F.array_join(F.concat(F.slice("w", 1, F.col("a")), again), " ")
    return sized.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_internal_pattern_runs(spark, sf_dir):
    found = periods.periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as l, -r.start as s, -r.period as p)))")
    named = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(named, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_rare_word_licences(spark, sf_dir):
    found = licences.licences(documents(spark, sf_dir))
    base = F.expr("filter(matches, m -> m.base)")

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(matches["label"])), ",")

    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base.word")).alias("first_word"), F.array_max(F.col("base.word")).alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.col("matches.score")), F.lit(0.0)).alias("score"),
    )


def op13_importance_resampling(spark, sf_dir):
    return resampling.resample(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), longest=1, buckets=10_000, percent=10,
        least_words=20, seed=2024,
    ).drop("n_words")


QUERIES = {
    f.__name__: f
    for f in (
        op1_inverted_multi_index,
        op2_naive_bayes_languages,
        op3_weak_label_quality,
        op4_secret_ownership,
        op5_repeat_intervals,
        op6_fuzzy_lines,
        op7_sentencepiece_offsets,
        op8_exact_tree_merge,
        op9_similarity_sketches,
        op10_best_fit_packing,
        op11_internal_pattern_runs,
        op12_rare_word_licences,
        op13_importance_resampling,
    )
}

ORACLES = {
    "op8_exact_tree_merge": r"""
with texts as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = min(doc_id) over same as kept, text_sha256
from texts window same as (partition by text_sha256)
""",
}
