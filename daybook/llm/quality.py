"""Quality rules: base counts, and how much more a text resembles a trusted corpus.

Words and pairs of words are hashed to ``BUCKETS`` buckets, the same number for
every table, and counted in all trusted documents and in all documents.  A
bucket's weight is the smoothed log-likelihood ratio of the two multinomials; a
document's score is the mean weight of its n-grams, and every document at or
above ``THRESHOLD`` passes.

All in DataFrame functions: the counts are one explode and one aggregate with
partial sums (a row a bucket and task at most); the weights, a whole number of
``UNIT`` for each bucket, are a constant of the scoring pass, which has no
shuffle.  N-grams that share a bucket share a weight: with more different
n-grams than buckets a weight is the ratio of all of them together.

A null or empty text has no words, fails the base rules and scores 0.  Repeated
or null ids keep a row each; an empty table gives an empty result, and without
trusted documents every weight is 0.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import SPACE, handoff
from daybook.llm.near_duplicates import MAX_BROADCAST_IDS

BUCKETS = 1 << 18
SMOOTHING = 5.0
THRESHOLD = -0.1
UNIT = 1e-4
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a lambda's body may use it many times)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs without space and U+0009 to U+000D; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")


def ngrams(w: Column) -> Column:
    """Buckets of the words and of the pairs of neighbouring words."""
    def bucket(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS).cast("bigint"))
    pairs = F.when(F.size(w) > 1, F.transform(
        F.sequence(F.lit(0), F.size(w) - 2), lambda i: bucket(F.get(w, i), F.get(w, i + 1))))
    return F.concat(F.transform(w, lambda x: bucket(x)), F.coalesce(pairs, F.array().cast("array<bigint>")))


def repeated_words(w: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash.  Only texts with a repeated window
    sort them; then each position that a repeated window covers counts once.
    """
    def covered(h: Column) -> Column:
        by_hash = F.sort_array(F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("i")))

        def starts(s: Column) -> Column:
            own = F.transform(s, lambda x, i: F.when(
                (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"]))
            return F.sort_array(F.filter(own, lambda x: x.isNotNull()))
        return let(let(by_hash, starts), lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(5)), F.lit(5))),
            F.lit(0), lambda a, x: a + x))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(
        *[F.get(w, i + j) for j in range(5)]))
    return F.when(F.size(w) < 5, F.lit(0)).otherwise(let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled as of good quality."""
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id"))


def weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``bucket, w``: the log-likelihood ratio of every bucket that occurs, in units.

    The raw counts are scaled to the trusted corpus before smoothing, so a
    bucket that hardly occurs weighs nothing.  Without trusted documents all
    weights are 0.
    """
    trusted = handoff(trusted.select("doc_id").distinct(), "trusted")
    if trusted.count() <= MAX_BROADCAST_IDS:                  # 8 bytes each; beyond, a shuffled join
        trusted = F.broadcast(trusted)
    flagged = (docs.where("doc_id IS NOT NULL").join(trusted.withColumn("_trusted", F.lit(1)), "doc_id", "left")
               .select("text", "_trusted")
               .unionByName(docs.where("doc_id IS NULL").select("text", F.lit(None).cast("int").alias("_trusted"))))
    counts = (flagged.select(F.coalesce("_trusted", F.lit(0)).alias("t"),
                             F.explode(let(words(F.col("text")), ngrams)).alias("bucket"))
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("t").alias("target")))
    counts = handoff(counts, "ngram-counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    scale = F.lit((total["target"] or 0) / (total["raw"] or 1))
    weight = F.when(F.lit(bool(total["target"])), F.log(
        (F.col("target") + SMOOTHING) / (F.col("raw") * scale + SMOOTHING))).otherwise(F.lit(0.0))
    return counts.select("bucket", F.round(weight / UNIT).cast("bigint").alias("w"))


def constant(table: DataFrame) -> Column:
    """The weights of ``BUCKETS`` buckets in order, 0 for those that don't occur."""
    of = {r.bucket: r.w for r in table.collect()}             # at most BUCKETS rows
    return F.split(F.lit(",".join(str(of.get(i, 0)) for i in range(BUCKETS))), ",").cast("array<bigint>")


def rate(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (``doc_id, text``) with counts, ``score``, ``base_failed`` and ``kept``.

    One row for every row of ``docs``.  A null or empty text has no words and
    fails the base rules; its score is 0.  Repeated ids keep a row each.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    small = constant(weights(docs, trusted))
    text = F.coalesce("text", F.lit(""))
    length = F.length(text)
    repeats = let(F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0),
                  lambda x: F.size(x) - F.size(F.array_distinct(x)))

    def per_words(w: Column) -> Column:
        mean = F.when(F.size(w) > 0, let(ngrams(w), lambda g: F.aggregate(
            g, F.lit(0).cast("bigint"), lambda a, b: a + F.get(small, b.cast("int")))) * UNIT / (2 * F.size(w) - 1)
        ).otherwise(0.0)
        return F.struct(F.size(w).cast("bigint").alias("n_words"),
                        repeated_words(w).cast("bigint").alias("n_repeat_words"),
                        mean.alias("score"))

    rows = docs.select(
        "doc_id", let(words(F.col("text")), per_words).alias("of"),
        F.length(F.translate(text, SPACE, "")).cast("bigint").alias("word_chars"),
        (length - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        repeats.cast("bigint").alias("n_dup_lines"))
    failed = (F.col("of.n_words") < 10) | (100 * F.col("of.n_repeat_words") > 20 * F.col("of.n_words"))
    return (rows.select("doc_id", "of.n_words", "word_chars", "n_symbols", "n_dup_lines", "of.n_repeat_words",
                        failed.alias("base_failed"), "of.score")
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)))
