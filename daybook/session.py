"""SparkSession defaults shared by the library, the tests and the benchmark.

Everything here is ordinary Spark configuration:

* UTC session time zone, so day boundaries do not move with the host.
* Adaptive query execution with partition coalescing and skew-join splitting:
  joins on a hot key (one region or station holding a large share of the rows)
  are split at runtime instead of landing in one task.
* No web UI.
* Whole-stage codegen falls back for methods too large for the JIT.
* A checkpoint folder.  On a cluster it comes from ``spark.checkpoint.dir``
  (a shared file system); only when nothing is configured, as in local tests,
  do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffle partition count comes from the cluster (or the caller); AQE then
    # coalesces small partitions towards this size and splits skewed ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Parquet row groups feed vectorized scans; 128 MB splits keep a task's
    # input bounded whatever the table size.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Generated methods above 8000 bytecodes are never JIT-compiled by the JVM;
    # fall back to non-fused code for them (wide CASE projections of layouts).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "daybook",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions expose no context
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by the cluster, if any."""
    sc = _context(spark)
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir", None)
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return sc.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a local one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins.  The local fallback exists for tests and single-machine runs.
    """
    sc = _context(spark)
    current = checkpoint_dir(spark)
    if current:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if sc is None or not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="daybook-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written hand-offs.

    It is deleted when the application ends.
    """
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{os.urandom(6).hex()}"
    sc = _context(spark)
    if sc is not None:
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path
