"""The stages of the corpus pipeline: each takes and (but for the last) returns documents.

All columns come through as they are, whatever their names: those that a stage
doesn't read are set aside under other names while it works.  Empty tables
give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import mixing, near_duplicates, packing, secrets, toxicity
from daybook.llm.queries import tokenizer_path
from daybook.sources.readers import read_table


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that aren't ``used`` under names that no operator adds, and the names by new one."""
    names = {c if c in used else f"kept_{i}": c for i, c in enumerate(docs.columns)}
    return docs.toDF(*names), names


def named(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of before, under their own names."""
    return docs.select(*[F.col(new).alias(old) for new, old in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5, by a model fitted on the labelled ones among them; null texts are scored as empty."""
    docs, names = apart(docs, "doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return named(toxicity.score(docs, model).where("predicted = 0"), names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8): its smallest id.

    Rows that repeat an id with the same text are one document (their least
    row).  Different texts under one id are documents of their own, compared
    apart from each other; of equal ids in a group the text with the least hash
    stays.  Rows with a null id take no part and stay.
    """
    docs, names = apart(docs, "doc_id", "text")
    keyed = docs.where("doc_id IS NOT NULL").withColumn("_key", F.xxhash64("doc_id", "text"))
    found = near_duplicates.near_duplicates(keyed.select("_key", "text"), size=5, id_col="_key")
    owners = found.select("_key", "component_id").distinct().join(keyed.select("_key", "doc_id").distinct(), "_key")
    stay = owners.groupBy("component_id").agg(F.min(F.struct("doc_id", "_key")).alias("least")).select("least._key")
    return named(keyed.join(stay, "_key", "left_semi").groupBy("_key")
                 .agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*").unionByName(
                     docs.where("doc_id IS NULL")), names)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the values of secrets replaced by their kind and ``n_chars`` renewed; null texts stay null."""
    docs, names = apart(docs, "doc_id", "text", "n_chars")
    out = secrets.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return named(out, names)


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn, each at most once, so that sources, languages and topics meet their target token shares.

    Null and empty texts have no tokens and follow ``mixing.mix``; equal ids are drawn alike.
    """
    docs, names = apart(docs, "doc_id", "text", "source", "lang")
    return named(mixing.mix(docs).where("chosen"), names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents packed into sequences of 2048 tokens; null texts are packed as empty ones."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets),
          ("mixing", sample_mixture), ("packing", pack_sequences)]
