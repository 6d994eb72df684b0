"""Session helpers: a local session for tests/bench and a shared scratch folder.

On a cluster the session is created by the launcher; the library never
changes its configuration except to name a checkpoint directory when none
is set (local runs and tests only) and, for the time of a write of its own, to
have that write's shuffle files removed when it ends.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "ledgerloom") -> SparkSession:
    """Session for tests and the benchmark (single JVM, UI off)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Small local inputs: keep AQE from merging shuffles into a few tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests) a
    fresh folder is created and registered so every later caller gets the same
    one. On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that the driver "
                           "and all executors share")
    local_dir = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


def clear_scratch(spark: SparkSession) -> None:
    """Delete this session's scratch tables; frames that still read them must not be used again."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/ledgerloom-scratch")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/ledgerloom-scratch/{name}-{uuid.uuid4().hex}"


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme for callers that need a plain local path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


#: Spark's switch for removing a query's shuffle files when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes begun in here remove their shuffle files when they end.

    What is written is read from its files, never from the shuffles again. Left to Spark, these stay on the
    disks until the driver collects its garbage, so that a chain of writes would keep them all.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for the functions that run there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    package = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="ledgerloom-py-")) / "ledgerloom_package.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(out))


def stored(df, name: str):
    """Write a frame below the shared checkpoint folder and read it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
