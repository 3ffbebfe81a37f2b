"""Quality rules: plain counts of a text, and a log-likelihood ratio of hashed n-grams.

The ratio compares two multinomials over ``buckets`` hashed unigrams and bigrams, as in data
selection by importance: one of trusted documents, one of the whole raw corpus. A document's
score is its mean over all n-grams, so that length does not matter, and every document is
judged by one fixed threshold: nothing is drawn at random.

All of it is built-in functions; the texts are read once to count and once to score, and
what a task sends is at most one row per bucket. A window of five words is compared by a
64-bit hash (two different windows of one text agree by chance with a probability of 1e-19).

Rules: a null text has no words. A text without words scores 0. All rows are judged each for
itself, repeated ones too. Columns of other names pass through ``apply_quality_rules``
untouched; ``quality_rules`` returns its own columns only. Without trusted documents all
weights are 0, and only the counts decide.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import constant_array, free_name, marked_by_id

BREAKS = r"[\x20\x09-\x0D]+"
NOT_BREAK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Hash buckets of the multinomials, and how many n-grams of the raw corpus the target counts in advance:
#: the fewer trusted documents there are, the closer all weights are to 0. With too few buckets an unseen word
#: shares its bucket with so many others that it weighs about 0; the README has the shares that are kept.
BUCKETS = 65_536
PRIOR = 4 * BUCKETS
#: Documents whose mean ratio is below this go. Text like the trusted scores about 0. Set on labels held out from the target.
THRESHOLD = -0.1


def _from(start: int, end: Column) -> Column:
    """start, ..., end - 1; empty if there is none."""
    return F.when(end > start, F.sequence(F.lit(start), end - 1)).otherwise(F.array().cast("array<int>"))


def _hashed(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep``, _text, _words, and _h: the hash of each word."""
    texts = docs.select(*keep, F.coalesce(text, F.lit("")).alias("_text"))
    words = texts.select("*", F.array_remove(F.split("_text", BREAKS, -1), "").alias("_words"))
    return words.select("*", F.transform("_words", lambda word: F.xxhash64(word)).alias("_h"))


def _bigram(h: Column, k: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.get(h, k), F.get(h, k + 1)), F.lit(buckets)).cast("int")


def fit_target_ratio(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, prior: float = PRIOR) -> list[float]:
    """Weight of each bucket: log probability under the trusted documents less that under all.
    ``trusted`` has a column ``id_col``, and all of its documents count; raw counts are over all of ``docs``."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = marked_by_id(rows, "_id", trusted.select(id_col), "_trusted")
    rows = _hashed(rows, F.col("_text"), [F.col("_trusted")])
    h = F.col("_h")
    rows = rows.select(
        F.col("_trusted").cast("int").alias("trusted"),
        F.concat(
            F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int")),
            F.transform(_from(0, F.size(h) - 1), lambda k: _bigram(h, k, buckets)),
        ).alias("grams"),
    )
    # explode() would filter empty arrays early, and so compute them a second time, per n-gram
    counts = rows.select("trusted", F.explode_outer("grams").alias("bucket")).filter("bucket is not null").groupBy("bucket")
    counts = counts.agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    found = counts.collect()  # at most ``buckets`` rows
    raw, target = sum(row.raw for row in found), sum(row.target for row in found)
    return _weights({row.bucket: (row.raw, row.target) for row in found}, raw, target, buckets, prior)


def _weights(counts: dict[int, tuple[int, int]], raw: int, target: int, buckets: int, prior: float) -> list[float]:
    found = []
    for bucket in range(buckets):
        of_raw, of_target = counts.get(bucket, (0, 0))
        share = (of_raw + 1) / (raw + buckets)
        found.append(log((of_target + prior * share) / (target + prior)) - log(share))
    return found


def _judged(docs: DataFrame, text: Column, keep: list[Column], weights: list[float], threshold: float) -> DataFrame:
    """``keep`` and the rules' columns, with names that begin with "_"."""
    h, grams, buckets = F.col("_h"), F.col("_grams"), len(weights)
    table = constant_array(weights)
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(NOT_BREAK))
    kept = [F.col(name) for name in docs.select(*keep).columns]
    rows = _hashed(docs, text, keep)
    rows = rows.select(
        *kept,
        F.size("_words").alias("_n"),
        F.length(F.array_join("_words", "")).cast("long").alias("_word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("_n_symbols"),
        lines.alias("_lines"),
        "_h",
        F.transform(_from(0, F.size(h) - 4), lambda k: F.xxhash64(*(F.get(h, k + j) for j in range(5)))).alias("_grams"),
    )
    ratio = F.aggregate(h, F.lit(0.0), lambda sum_, x: sum_ + F.get(table, F.pmod(x, F.lit(buckets)).cast("int")))
    ratio += F.aggregate(_from(0, F.size(h) - 1), F.lit(0.0), lambda sum_, k: sum_ + F.get(table, _bigram(h, k, buckets)))
    rows = rows.select(
        *kept,
        F.col("_n").cast("long").alias("_n_words"),
        "_word_chars",
        "_n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_n_dup_lines"),
        (ratio / F.greatest(2 * F.col("_n") - 1, F.lit(1))).alias("_score"),
        # only texts that repeat a window need their windows sorted
        F.when(F.size(F.array_distinct(grams)) < F.size(grams), grams).otherwise(F.array().cast("array<bigint>")).alias("_grams"),
    )
    pairs = F.sort_array(F.transform(grams, lambda gram, k: F.struct(gram.alias("gram"), k.alias("at"))))
    rows = rows.withColumn("_pairs", pairs)
    pairs = F.col("_pairs")
    same = lambda k, j: F.get(pairs, k)["gram"].eqNullSafe(F.get(pairs, j)["gram"])
    twice = F.filter(_from(0, F.size(pairs)), lambda k: same(k, k + 1) | same(k, k - 1))
    rows = rows.withColumn("_twice", F.sort_array(F.transform(twice, lambda k: F.get(pairs, k)["at"])))
    twice = F.col("_twice")
    covered = F.aggregate(_from(1, F.size(twice)), F.lit(5), lambda sum_, k: sum_ + F.least(F.lit(5), F.get(twice, k) - F.get(twice, k - 1)))
    repeats = F.when(F.size(twice) > 0, covered).otherwise(0).cast("long")
    rows = rows.withColumn("_n_repeat_words", repeats)
    rows = rows.withColumn("_base_failed", (F.col("_n_words") < 10) | (100 * F.col("_n_repeat_words") > 20 * F.col("_n_words")))
    rows = rows.withColumn("_kept", ~F.col("_base_failed") & (F.col("_score") >= threshold))
    return rows.drop("_grams", "_pairs", "_twice")


def quality_rules(docs: DataFrame, weights: list[float], *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept."""
    rows = _judged(docs, F.col(text_col), [F.col(id_col).alias("doc_id")], weights, threshold)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    return rows.select("doc_id", *(F.col(f"_{name}").alias(name) for name in names))


def apply_quality_rules(docs: DataFrame, weights: list[float], *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    whole = free_name(docs, "row")
    rows = _judged(docs, F.col(text_col), [F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias(whole)], weights, threshold)
    # the second condition keeps the filter above the projections; below, it would repeat their work
    rows = rows.withColumn("_here", F.spark_partition_id())
    return rows.filter("_kept and _here >= 0").select(f"{whole}.*")
