"""Mixing sources to target weights by iterative proportional fitting.

The tokens (words) of the documents are summed by cell (source, language,
topic).  Raking scales the cells until their sums by source, by language and
by topic meet the targets.  A cell's rate is its raked over its present weight,
scaled so that half of the tokens have a rate of at least 1.  The targets are
met, up to the draws, in two ways: ``copies`` takes a document as often as its
rate says (the whole part, and one more by a draw for the rest), and ``chosen``
takes it at most once, by a draw under its rate over the greatest one.
``sampled`` tells whether there is a copy at all; its rows alone don't meet the
targets where rates are above 1.  Draws depend on a hash of the id alone, so a
rerun draws the same.

All in DataFrame functions.  Each round is three aggregates of the cell table
joined back to it; every round is written in the shared folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import handoff

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 8
#: Targets by default: present shares to this power, normalised (small ones gain).
TEMPER = 0.9
#: The share of tokens whose rate is scaled to less than 1.
SCALED = 0.5


def n_tokens(text: Column) -> Column:
    """Words of a text; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def topic(text: Column) -> Column:
    """Kind of a text, a stand-in where documents carry no topic: by its marks and its length."""
    marks = F.length(text) - F.length(F.translate(text, "#*$%&", ""))
    bars = F.length(text) - F.length(F.translate(text, "|", ""))
    return (F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "empty").when(bars * 50 > F.length(text), "table")
            .when(marks * 50 > F.length(text), "symbols").when(F.length(text) < 1000, "short")
            .when(F.length(text) < 5000, "article").otherwise("long"))


def cells(docs: DataFrame) -> DataFrame:
    """``source, lang, topic, tokens``; a null is a value of its own (the empty string)."""
    return docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))


def targets(table: DataFrame, dimension: str, given: Mapping[str, float] | None, temper: float) -> DataFrame:
    """Target share of every present value of a dimension; shares sum to 1.

    Values without a given target get 0.
    """
    sums = table.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("t"))
    if given is None:
        wanted = F.pow("t", F.lit(temper))
    else:
        wanted = F.lit(0.0)
        for value, share in given.items():
            wanted = F.when(F.col(dimension) == value, F.lit(float(share))).otherwise(wanted)
    shares = sums.select(dimension, F.when(F.col("t") > 0, wanted).otherwise(0.0).alias("x"))
    whole = handoff(shares.agg(F.sum("x").alias("s")), "whole").scalar()
    return shares.select(dimension, (F.col("x") / F.when(whole > 0, whole)).alias("target"))


def rake(table: DataFrame, given: Mapping[str, Mapping[str, float]] | None = None, temper: float = TEMPER,
         rounds: int = ROUNDS) -> DataFrame:
    """The cell table with ``weight``: raked token shares, which sum to 1.

    ``given`` has target shares by dimension and value; a dimension without
    them gets its tempered present shares.  The last step of a round fits the
    last dimension exactly, the others as far as the rounds took them.
    """
    wanted = {d: handoff(targets(table, d, (given or {}).get(d), temper), f"target-{d}") for d in DIMENSIONS}
    now = table.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for d in DIMENSIONS:
            sums = now.groupBy(d).agg(F.sum("weight").alias("_sum")).join(wanted[d], d)
            now = (now.join(sums, d).withColumn("weight", F.when(
                F.col("_sum") > 0, F.col("weight") * F.col("target") / F.col("_sum")).otherwise(0.0))
                .select(*DIMENSIONS, "tokens", "weight"))
        now = handoff(now, "raked")
    return now


def rates(raked: DataFrame) -> DataFrame:
    """The cell table with ``rate``: raked over present weight, 1 at the token-weighted quantile ``SCALED``.

    ``once`` is the rate over the greatest one.  Cells without tokens get 1 in both.
    """
    ratio = F.col("weight") / F.col("tokens")
    one = handoff(raked.where("tokens > 0").agg(F.percentile(ratio, SCALED, F.col("tokens")).alias("q")),
                  "rate-of-one").scalar()
    most = handoff(raked.where("tokens > 0").agg(F.max(ratio).alias("m")), "greatest-ratio").scalar()

    def over(whole: Column) -> Column:
        return F.when(F.col("tokens") > 0, F.coalesce(ratio / F.when(whole > 0, whole), F.lit(0.0))).otherwise(1.0)
    return raked.select(*DIMENSIONS, "tokens", "weight", over(one).alias("rate"), over(most).alias("once"))


def draw(id_col: str) -> Column:
    """A number in [0, 1) from the id: the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 8), 16, 10
                  ).cast("bigint") / F.lit(float(1 << 32))


def mix(docs: DataFrame, given: Mapping[str, Mapping[str, float]] | None = None, temper: float = TEMPER,
        rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with ``topic, n_tokens, rate, sampled, copies, chosen`` (columns of these names are replaced).

    A document is sampled if its draw is under its rate.  Its tokens meet the
    targets (in expectation) counted ``copies`` times, and also among the
    chosen documents, each taken once.  Texts without words
    have no weight; in a cell without tokens they are always sampled, once, and chosen.  A null
    source or language is a value of its own.  Equal ids are drawn alike.
    """
    names = ["topic", "n_tokens", "rate", "sampled", "copies", "chosen"]
    docs = docs.drop(*names).withColumn("topic", topic(F.col("text"))).withColumn("n_tokens", n_tokens(F.col("text")))
    keys = [F.coalesce(F.col(d).cast("string"), F.lit("")) for d in DIMENSIONS]
    table = handoff(cells(docs.select(*[k.alias(d) for k, d in zip(keys, DIMENSIONS)], "n_tokens")), "cells")
    table = handoff(rates(rake(table, given, temper, rounds)), "rates")
    table = table.select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS], "rate",
                         F.col("once").alias("_once"))
    on = [k == F.col(f"_{d}") for k, d in zip(keys, DIMENSIONS)]
    return (docs.join(table, on, "left").withColumn("sampled", draw("doc_id") < F.col("rate"))
            .withColumn("copies", F.greatest(F.ceil(F.col("rate") - draw("doc_id")), F.lit(0)).cast("bigint"))
            .withColumn("chosen", draw("doc_id") < F.col("_once")).drop("_once", *[f"_{d}" for d in DIMENSIONS]))
