"""Session defaults and shared scratch locations.

The cluster names its shared folder in ``spark.checkpoint.dir``; every
derived table this package writes (landing drops, raw and trusted zones of
the demo flows, checkpoints that cut lineage) goes below it.  Without the
setting a local session gets a private folder (driver and executors are one
process there); on a cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the operators rely on: wall-clock timestamps in UTC,
# adaptive execution (partition coalescing and skew-join splitting).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Static settings, only applicable when we build the session: call-site
# capture costs a JVM round trip per column function call.
STATIC_DEFAULTS = {
    "spark.driver.memory": "8g",        # local mode: the driver JVM is the executor
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# While a batch writes its zones: the shuffle files of an execution go when it ends (else they stay
# until the driver happens to collect its garbage), and tables are packed tighter.
LEAN_DISK = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str = "local[8]", app: str = "terrace",
                  shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**STATIC_DEFAULTS, **SESSION_DEFAULTS, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the runtime SQL settings on a session someone else built."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


@contextmanager
def lean_disk(spark: SparkSession):
    """``LEAN_DISK`` holds inside, what held before afterwards."""
    before = {k: spark.conf.get(k, None) for k in LEAN_DISK}
    for k, v in LEAN_DISK.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local session gets a fresh folder of its
    own; a cluster session fails, since executors cannot see the driver's disk.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="run-")
    sc.setCheckpointDir(root)
    return root


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete files or folders that this package wrote, where they are still there."""
    sc = spark.sparkContext
    for p in paths:
        at = sc._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder for tables we derive."""
    base = checkpoint_root(spark).rstrip("/")
    leaf = os.path.join(*parts) if parts else ""
    tag = uuid.uuid4().hex[:12] if unique else ""
    return "/".join(p for p in (base, "terrace", tag, leaf) if p)
