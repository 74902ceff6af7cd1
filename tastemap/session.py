"""Spark session, checkpoint folder and shared scratch paths.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (or a
folder the application already set with ``setCheckpointDir``); it must be a
shared file system.  Only for a local master without one (tests, a laptop) do we
create a folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tastemap", extra: dict | None = None) -> SparkSession:
    """A session with the settings the operators expect.  The master comes from the
    argument, the environment or spark-submit; local[*] is only the last resort, and the
    number of shuffle partitions is Spark's own unless given (AQE coalesces small ones)."""
    from pyspark import SparkConf
    master = master or os.environ.get("TASTEMAP_MASTER") or SparkConf().get("spark.master", None) or "local[*]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # delete reliable checkpoints of iterations once nothing references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions is None and master.startswith("local"):
        shuffle_partitions = 2 * (os.cpu_count() or 4)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("TASTEMAP_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tastemap`` importable in the Python workers (what --py-files does):
    zip the package once on the driver and add it to the SparkContext, which
    distributes it to every executor.  Idempotent per application."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tastemap-pyfiles-"), "tastemap.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("tastemap", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder.  A local master without one gets a
    temporary folder; on a cluster a shared folder must be configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tastemap-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Within this block a query removes its shuffle files when it ends: for queries that write
    all they give, so that nothing reads their shuffles again.  Shuffles below a persisted
    table stay with it.  Without this they lie on the disks until the driver happens to
    collect garbage, those of every step of an iteration."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, truncates the plan.  The checkpoint is
    written by the only job that computes the plan, whose shuffle files are removed after it."""
    checkpoint_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)      # a query made under the setting


class Rewritten:
    """A table that every step of an iteration writes anew: ``keep(df)`` writes ``df`` to the
    scratch folder in one job, gives the table read back, and deletes the one before, which
    nothing needs any more, and the shuffle files of the step.  Tables handed out last stay."""

    def __init__(self, spark, name: str):
        self.spark, self.name, self.path = spark, name, None

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        with shuffles_removed(self.spark):
            df.write.parquet(path)
        old, self.path = self.path, path
        if old:
            delete_path(self.spark, old)
        return self.spark.read.schema(df.schema).parquet(path)


def delete_path(spark, path: str) -> None:
    """Remove a written table, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
