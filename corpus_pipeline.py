"""Corpus pipeline: toxicity, near duplicates, secrets, mixing, packing.

Stages run in order on what the one before kept; each result is written as
Parquet in the shared folder and read again.  All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm.common import handoff
from daybook.llm.stages import STAGES
from daybook.sources.readers import read_table

#: Token ids, hashes and a trained model: not expressible in SQL (see tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = handoff(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
