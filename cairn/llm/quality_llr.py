"""Quality rules by a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and word pairs are hashed into ``buckets``.  The corpus gives one multinomial over
the buckets, a trusted target (documents labelled good and not toxic) another, both with
one added to each count.  A document's score is the mean over its n-grams of
log(target / corpus): length-normalised, so long and short documents compare.  Documents
under the threshold are rejected; the same document always gets the same verdict.

The corpus counts cover all documents.  The target and the threshold are fitted on
labelled rows, at most ``label_limit`` of each class (those whose doc_id hashes lowest),
so their ids can be sent to every task; the weights and the score histogram are bounded
by their parameters.  The threshold is the middle of the cut of the labelled scores with
the fewest errors, a trusted document lost counting ``keep_weight`` times a bad one kept.

Base rules: under ``min_words`` words, or over ``max_repeat_percent`` of the words in
3-word windows that occur twice or more in the text.

Defined cases: null and empty texts have no words, score 0 and fail the base rules; rows
of equal doc_id are scored row by row; a doc_id labelled more than once counts as good
only if no label of it is bad or toxic; without labels of both classes every document
that passes the base rules is kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 8192
LABEL_LIMIT = 100_000
KEEP_WEIGHT = 10
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: scores are sorted into steps of this size for the threshold
SCORE_STEP = 0.002
WHITE = " \t\n\x0b\f\r"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where the optimizer moves the
    expression into a filter: lambdas over words would else split the text for each word."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    inner = F.btrim(text, F.lit(WHITE))
    none = F.array().cast("array<string>")
    return F.when(F.length(inner) > 0, F.split(inner, "[ \\t\\n\\x0B\\f\\r]+")).otherwise(none)


def _windows(words: Column, n: int) -> Column:
    """64-bit hashes of the n consecutive words from each word on."""
    def hashes(ws):
        own = F.slice(ws, 1, F.greatest(F.size(ws) - (n - 1), F.lit(0)))
        return F.transform(own, lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, n)]))

    return let(words, hashes)


def repeated_words(grams: Column, n: int = 3) -> Column:
    """Words inside windows (given as hashes in text order) that occur twice or more."""
    def total(g):
        placed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(placed, lambda s: F.filter(
            s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])))
        starts = F.sort_array(F.transform(again, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(starts, zero, lambda acc, p: F.struct(
            (acc["n"] + p + n - F.greatest(p, acc["end"])).alias("n"), (p + n).alias("end")), lambda acc: acc["n"])

    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), total(g)).otherwise(F.lit(0))).cast("long")


def with_base_rules(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Adds _words and the base columns to ``docs`` (with _text, never null)."""
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    out = docs.withColumn("_words", words_of(text)).select(
        "*", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(_windows(F.col("_words"), 3)).alias("n_repeat_words"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def features(words: Column, buckets: int) -> Column:
    """Bucket numbers of the words and word pairs of a text."""
    bucket = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    return let(words, lambda ws: F.concat(F.transform(ws, lambda w: bucket(F.xxhash64(w))),
                                          F.transform(_windows(ws, 2), bucket)))


def labelled(labels: DataFrame, limit: int) -> DataFrame:
    """doc_id, trusted of a bounded number of labelled documents of either class."""
    each = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("doc_id").agg(F.min("quality").alias("_q"), F.max(F.coalesce("toxic", F.lit(0))).alias("_t")))
    each = each.where("_q = 0 OR _t = 0").select("doc_id", (F.col("_q") > 0).alias("trusted"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return (each.where("trusted").orderBy(*order).limit(limit)
            .union(each.where("NOT trusted").orderBy(*order).limit(limit)))


def fit_weights(words: DataFrame, buckets: int) -> list[float]:
    """log(target / corpus) of each bucket; ``words`` has _words and trusted (null: not labelled)."""
    counts = (words.select(F.explode(features(F.col("_words"), buckets)).alias("_b"), F.coalesce("trusted", F.lit(False)).alias("_t"))
              .groupBy("_b").agg(F.count(F.lit(1)).alias("n"), F.count_if("_t").alias("t")))
    corpus, target = [1] * buckets, [1] * buckets
    for r in counts.collect():  # one row per bucket at most
        corpus[r._b] += r.n
        target[r._b] += r.t
    if sum(target) == buckets:
        return [0.0] * buckets
    log_ratio = math.log(sum(corpus)) - math.log(sum(target))
    return [math.log(t) - math.log(c) + log_ratio for t, c in zip(target, corpus)]


def score(words: Column, weights: list[float]) -> Column:
    """Mean weight of the n-grams; the weights travel in the plan as one constant array."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    return let(features(words, len(weights)),
               lambda f: F.when(F.size(f) > 0, F.aggregate(f, F.lit(0.0), lambda s, b: s + F.get(table, b)) / F.size(f))
               .otherwise(F.lit(0.0)))


def threshold_counts(scored: DataFrame) -> DataFrame:
    """s, good, bad: labelled rows of ``scored`` that pass the base rules, per score step.  They
    are counted under a condition: a filter would be moved below the words and split every
    text again."""
    step = F.greatest(F.lit(-20_000), F.least(F.lit(20_000), F.floor(F.col("llr") / SCORE_STEP))).cast("int")
    passed = ~F.col("base_failed")
    return scored.groupBy(step.alias("s")).agg(F.count_if(passed & F.col("trusted")).alias("good"), F.count_if(passed & ~F.col("trusted")).alias("bad"))


def fit_threshold(scored: DataFrame, keep_weight: int = KEEP_WEIGHT) -> float:
    """Threshold from the labelled rows of ``scored`` (llr, trusted, base_failed)."""
    # bounded by the number of steps; a step of failed rows alone is no step
    rows = sorted((r.s, r.good, r.bad) for r in threshold_counts(scored).collect() if r.good + r.bad)
    if not sum(r[1] for r in rows) or not sum(r[2] for r in rows):
        return -math.inf
    # cutting before step k rejects all steps below it
    lost, kept = 0, sum(r[2] for r in rows)
    best, ties = kept, [rows[0][0]]
    for i, (s, good, bad) in enumerate(rows):
        lost, kept = lost + good, kept - bad
        after = rows[i + 1][0] if i + 1 < len(rows) else s + 1
        cost = keep_weight * lost + kept
        if cost < best:
            best, ties = cost, [s + 1, after]
    return sum(ties) / len(ties) * SCORE_STEP


def quality_verdicts(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, label_limit: int = LABEL_LIMIT,
                     keep_weight: int = KEEP_WEIGHT, min_words: int = MIN_WORDS,
                     max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """``docs`` (with doc_id, text) with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, llr, kept.  Three passes over the texts, no shuffle of them."""
    known = F.broadcast(labelled(labels, label_limit))  # at most 2 * label_limit ids
    text = F.coalesce(F.col("text"), F.lit("")).alias("_text")
    pick = docs.select(F.col("doc_id"), text).join(known, "doc_id", "left")
    weights = fit_weights(pick.select(words_of(F.col("_text")).alias("_words"), "trusted"), buckets)
    fit = with_base_rules(docs.select("doc_id", text).join(known, "doc_id"), min_words, max_repeat_percent)
    threshold = fit_threshold(fit.select(score(F.col("_words"), weights).alias("llr"), "trusted", "base_failed"), keep_weight)
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept", "_words", "_text"]
    own = [c for c in docs.columns if c not in made]
    out = with_base_rules(docs.select(*own, text), min_words, max_repeat_percent)
    out = out.withColumn("llr", score(F.col("_words"), weights))
    return (out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))
            .select(*own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"))
