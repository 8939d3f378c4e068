"""Session helpers: a local session for tests/bench and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "rosterkit") -> SparkSession:
    """A local session configured like the tests and the bench use it.

    AQE stays on (coalescing and skew-join splitting are what keep the
    keyed shuffles healthy on large inputs); the UI is off. Small files
    are split finely here so that all cores share their rows.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.minPartitionNum", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder that all executors share and
    is only read. Where it is unset, a local session (tests, one machine)
    gets a fresh folder of its own; any other raises, since executors
    would each write to their own disk and later reads would miss files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rosterkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", folder)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


@contextmanager
def shuffles_for(spark: SparkSession, rows: int, rows_per_task: int = 250_000) -> Iterator[None]:
    """What is run inside shuffles into at least a task for each
    ``rows_per_task`` of its input's rows, so that the memory of one task's
    sorts does not grow with the input (adaptive execution merges what
    turns out small)."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), -(-rows // rows_per_task))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each action inside go when it has ended, not
    when the driver's JVM happens to collect its plan: a job of several
    writes holds the shuffles of one at a time."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def discard(df) -> None:
    """Remove what :func:`materialize` wrote for ``df`` (or for the parts of
    a union), once nothing that is still to run reads it."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str, partition_by: tuple[str, ...] = ()):
    """Cut lineage by writing ``df`` as a Parquet table in the shared
    checkpoint folder and reading it back.

    Preferred over ``Dataset.checkpoint()`` for data that is read again:
    later scans prune columns and push filters into the files, and the
    stage is never recomputed after an executor is lost. ``partition_by``
    splits the files, so that a part is read alone. The folder
    belongs to the run: remove it when the application has ended."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with shuffles_dropped(spark):
        if not partition_by:
            df.write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)          # no file of an empty table tells its columns
