"""Sorting, limits, unions and unpivot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide -> long, one row per id and value column; null values are kept."""
    return df.unpivot(list(ids), list(values), variable, value)


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """O3: first ``n`` rows of a total order (planned as a top-k, no full sort)."""
    return df.orderBy(*order).limit(n)


def sorted_by(df: DataFrame, *order: Column | str) -> DataFrame:
    """O1/O2: global sort (range-partitioned; only where the order is the output)."""
    return df.orderBy(*order)
