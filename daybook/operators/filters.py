"""Row filters and value rewrites.

Null rules follow the reference's pandas semantics where they decide results:
a comparison with a missing value is *false* there, so "drop rows where A and
B" keeps rows whose A or B is null.  Plain Spark ``~(A & B)`` would be null
for those rows and ``where`` would drop them, hence the ``coalesce`` below.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows where ``condition`` is true; rows where it is null stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """Plain filter (pushed into Parquet scans when it is on a scan column)."""
    return df.where(condition)


def drop_rows_with_value(df: DataFrame, marker: str,
                         columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where any of ``columns`` (default: all string columns) equals ``marker``."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not columns:
        return df
    hit = F.array_contains(F.array(*[F.col(c).cast("string") for c in columns]), F.lit(marker))
    return drop_where(df, hit)


def replace_values(df: DataFrame, column: str,
                   replacements: Sequence[tuple[str, str]] | Mapping[str, str]) -> DataFrame:
    """Exact-match replacements applied one after another, in order.

    Order matters because a later rule sees the output of an earlier one
    (``A -> B`` then ``B -> C`` turns ``A`` into ``C``).  Values are literal:
    ``Punjab*`` matches only ``Punjab*``.
    """
    pairs = list(replacements.items()) if isinstance(replacements, Mapping) else list(replacements)
    out = F.col(column)
    for old, new in pairs:
        out = F.when(out == F.lit(old), F.lit(new)).otherwise(out)
    return df.withColumn(column, out)


def patch_where(df: DataFrame, target: str, condition: Column, value) -> DataFrame:
    """Set ``target`` to ``value`` where ``condition`` holds."""
    return df.withColumn(target, F.when(F.coalesce(condition, F.lit(False)), F.lit(value))
                         .otherwise(F.col(target)))


def fill_constant(df: DataFrame, column: str, value) -> DataFrame:
    """Constant in place of null."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def drop_nulls(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows null in ``subset`` (default: any column)."""
    return df.na.drop(how="any", subset=list(subset) if subset is not None else None)


def skip_leading_rows(df: DataFrame, row_col: str, n) -> DataFrame:
    """Drop the first ``n`` rows of each document (``row_col`` is 0-based)."""
    return df.where(F.col(row_col) >= (_c(n) if not isinstance(n, int) else F.lit(n)))


def slice_from_last_anchor(df: DataFrame, doc_keys: Sequence[str], row_col: str,
                           is_anchor: Column) -> DataFrame:
    """Keep rows from the *last* anchor row of each document on.

    A document without an anchor keeps all its rows (pandas slices from
    ``None``).  The anchor position is a grouped maximum joined back, so a
    very large document is aggregated map-side and its join can be split by
    adaptive skew handling, instead of sorting it in a single window task.
    """
    anchors = (df.where(F.coalesce(is_anchor, F.lit(False)))
               .groupBy(*doc_keys).agg(F.max(row_col).alias("_anchor_row")))
    return (df.join(anchors, list(doc_keys), "left")
            .where(F.col(row_col) >= F.coalesce(F.col("_anchor_row"), F.lit(0)))
            .drop("_anchor_row"))
