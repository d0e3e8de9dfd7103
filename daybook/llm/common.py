"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from daybook.sources.sinks import handoff  # noqa: F401 - written tables in the shared folder

#: White space of the word contracts: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
#: Rows handled at a time inside a task, whatever the Arrow batch holds.
SLICE_ROWS = 512


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of at most ``rows`` rows, to bound what a task expands at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: What drops the caches that a module keeps in a worker process between tasks.
CACHES: list[Callable[[], None]] = []


def forget() -> None:
    """Drop what earlier stages left in this worker process: called where a task of
    another kind begins, since workers are reused."""
    for drop in CACHES:
        drop()
    pa.default_memory_pool().release_unused()


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of steps whose results are handed off: its
    cleaner does so once the driver has collected the plans that nothing refers to."""
    spark.sparkContext._jvm.System.gc()


def tasks_for(df: DataFrame) -> int:
    """Shuffle partitions of the session (the cluster's choice)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
