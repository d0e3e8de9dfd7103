"""Scans.

Every reader takes an explicit schema: no inference pass over the data, the
same types on every run, and column pruning / filter pushdown stay possible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daybook import schemas
from daybook.operators.scans import with_global_rank
from daybook.sources.sinks import handoff


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a data folder (one ``<name>.parquet`` each)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_json_records(spark: SparkSession, path: str, record_schema=schemas.CASE_RECORD,
                      field: str = "value") -> DataFrame:
    """JSON lines whose payload sits in a struct field; flatten it.

    Header and footer lines of an array dump (``{"rows": [`` / ``]}``) parse
    to a null struct and are dropped; so is any record without the field.
    """
    wrapper = StructType([StructField(field, record_schema, True)])
    return (spark.read.schema(wrapper).option("mode", "PERMISSIVE").json(path)
            .where(F.col(field).isNotNull()).select(f"{field}.*"))


#: Lines of an array dump around its records (blanks aside): not rejects.
WRAPPER_LINE = r"^\s*(\{\s*(\"[^\"]*\"\s*:\s*)?)?[\[\]]?\s*\}?\s*,?\s*$"
#: Column of the original text of a record that doesn't fit its schema.
CORRUPT = "_corrupt_record"


def rejected_json_records(spark: SparkSession, path: str, record_schema=schemas.CASE_RECORD,
                          field: str = "value") -> DataFrame:
    """Every line that :func:`read_json_records` leaves out or reads only in part:
    ``file_name, reason, text``.

    ``malformed``: not JSON, or a value that doesn't fit its type; ``no <field>``:
    JSON without the payload.  Empty lines and the lines that open and close an
    array dump are no records and are not listed.
    """
    wrapper = StructType([StructField(field, record_schema, True), StructField(CORRUPT, StringType(), True)])
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"), "value")
    read = lines.select("file_name", F.col("value").alias("text"), F.from_json(
        "value", wrapper, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    reason = (F.when(F.col(f"r.{CORRUPT}").isNotNull(), "malformed")
              .when(F.col(f"r.{field}").isNull(), f"no {field}"))
    return (read.where(~F.col("text").rlike(WRAPPER_LINE)).withColumn("reason", reason)
            .where(F.col("reason").isNotNull()).select("file_name", "reason", "text"))


def rejected_csv_records(spark: SparkSession, path: str, schema, sep: str = ",", header: bool = True) -> DataFrame:
    """Every record that doesn't fit the schema (too many or too few fields, or
    text that is no value of its type), which :func:`read_csv` reads only in
    part: ``file_name, text``.  All columns are parsed for it."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    read = (spark.read.schema(full).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
    # Spark parses only what is asked for, so the condition looks at every field
    parsed = F.length(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in schema.fields])) >= 0
    return (read.where(F.col(CORRUPT).isNotNull() & parsed)
            .select(F.col("_metadata.file_name").alias("file_name"), F.col(CORRUPT).alias("text")))


def read_csv(spark: SparkSession, path: str, schema, sep: str = ",",
             header: bool = True) -> DataFrame:
    """Delimited text with a header; empty fields become null.

    ``path`` may be a file, a glob or a folder of part files (all parts are
    read, not just the first).
    """
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


def with_file_date(df: DataFrame, name: str = "report_date", length: int = 10) -> DataFrame:
    """Report date taken from the first characters of each row's file name."""
    return df.withColumn(name, F.try_to_date(F.substring(F.col("_metadata.file_name"), 1, length),
                                             "yyyy-MM-dd"))


def with_document_position(df: DataFrame, file_col: str = "file_name",
                           name: str = "doc_index") -> DataFrame:
    """Position of each row's file in the sorted list of file names, from 0.

    The positions are numbered on the distinct file names (a table as long as
    the file list, written once) by ranges of names, so no task holds them all,
    and joined back; a null name has a null position.
    """
    files = df.select(F.col(file_col).alias("_file")).where(F.col("_file").isNotNull()).distinct()
    numbered = with_global_rank(handoff(files, "file-names"), "_file", name)
    return df.drop(name).join(numbered.withColumn(name, F.col(name).cast("int")),
                              F.col(file_col) == F.col("_file"), "left").drop("_file")


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the session catalog (``db.table`` or a temp view)."""
    return spark.table(name)


def read_catalog_sql(spark: SparkSession, name: str, columns=("*",), where: str | None = None) -> DataFrame:
    """A saved table read by SQL text.  A condition on the table's partition
    column decides which partitions are listed and read at all."""
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    names = ", ".join(c if c == "*" else f"`{c}`" for c in columns)
    return spark.sql(f"SELECT {names} FROM {quoted}" + (f" WHERE {where}" if where else ""))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-partitioned input over all task slots.

    A file with a few large row groups scans as a few tasks; before CPU-heavy
    row work that leaves most cores idle.  When ``df`` has fewer than half of
    ``min_partitions`` partitions (default: the cluster's default
    parallelism) it is hash-partitioned on all its columns into
    ``min_partitions`` parts (deterministic under task retries without the
    local sort a round-robin repartition needs); otherwise -- the normal case
    for a large table made of many files -- it is returned unchanged and
    costs nothing.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    current = df.rdd.getNumPartitions()
    if 2 * current >= target:
        return df
    return df.repartition(target, *[F.col(c) for c in df.columns])
