"""Session construction and shared scratch space.

The library never creates its own cluster settings when a session already exists: callers on a
cluster pass their session in.  ``get_session`` is for tests, the bench and local runs.
"""
from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job relies on: UTC wall clock, AQE with skew-join splitting,
# dynamic partition overwrite so a day replace (M4) touches only its own partition.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "playledger") -> SparkSession:
    """Return the active session, or build a local one with :data:`BASE_CONF`."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PLAYLEDGER_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage; we only read it, and refuse to go on
    when it is unset.  A local master (unit tests, a laptop) gets a private folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="playledger-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (for landing files, staging, state)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/playledger-{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files go when the write that made them ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: list[list[str]] = []


def store(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to a fresh Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but keeps columns apart, so later readers prune them, push filters and know
    the size; a lost executor costs no recomputation beyond the running job's tasks.  Columns of type void, which files
    can't hold, are made anew.  Inside :func:`scratch_scope` the table is deleted when the scope ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    held = df.drop(*void) if void else df
    if not held.columns:
        return df.checkpoint(eager=True)
    before = spark.conf.get(_CLEANUP, None)
    if before is None:
        spark.conf.set(_CLEANUP, "true")  # unless the session says otherwise; left on, so concurrent queries don't undo it
    held.write.option("compression", "zstd").parquet(path)  # steps lie on disk beside the shuffle files of the later ones
    out = spark.read.schema(held.schema).parquet(path)
    out = out.select(*[F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns]) if void else out
    out.step_path = path
    return out


def drop_step(df: DataFrame) -> None:
    """Delete a step of :func:`store` whose last reader is done."""
    fs, at = path_of(df.sparkSession, df.step_path)
    fs.delete(at, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Tables that :func:`store` makes inside are deleted at the end: for jobs whose results are written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for p in _scopes.pop():
            fs, at = path_of(spark, p)
            fs.delete(at, True)


def store_alone(spark: SparkSession, make) -> list[DataFrame]:
    """The frames that ``make()`` returns, stored; the steps that it stored on the way are deleted then."""
    with scratch_scope(spark):
        frames = make()
        at = len(_scopes[-1])
        out = [store(df) for df in frames]
        own = _scopes[-1][at:]
        del _scopes[-1][at:]
    if _scopes:
        _scopes[-1].extend(own)
    return out


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder (see :func:`store`)."""
    return store(df)


def path_of(spark: SparkSession, path: str):
    """(file system, path) of ``path`` in whatever store it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def input_bytes(paths: list[str], spark: SparkSession | None = None) -> int:
    """Total size of the files under ``paths``, asked of the file system that holds them (to size partitions)."""
    spark = spark or SparkSession.getActiveSession()
    total = 0
    for p in paths:
        fs, at = path_of(spark, p)
        total += fs.getContentSummary(at).getLength() if fs.exists(at) else 0
    return total


def configure_for_scale(spark: SparkSession, input_size_bytes: int, cores: int,
                        target_partition_bytes: int = 256 << 20, expansion: float = 1.0) -> int:
    """Size shuffles so a partition fits comfortably in an executor core's memory.

    ``expansion`` is the ratio of shuffled bytes to (compressed) input bytes; projections and map-side partial
    aggregation usually keep it at or below 1, raise it for jobs dominated by a widening join or explode.
    AQE then coalesces small partitions and splits skewed ones, so this is a ceiling, not a fixed count
    (100 TB -> ~410 k partitions of 256 MB).  Returns the shuffle partition count set."""
    parts = max(cores * 2, int(input_size_bytes * expansion / target_partition_bytes) + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes // 2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    return parts
