"""Session settings the jobs are designed for, and the shared folder they may write to."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Sketches are Java objects: beyond this many groups a task sorts its input
    # instead of hashing it. A sketch grows with the values it has seen, so all
    # sketches of a task together stay within a few times the task's input, and
    # the number of groups only adds about a kilobyte each.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # The JVM never compiles methods above 8000 bytes. Projections of 56 columns
    # can exceed that when fused into one method; beyond the limit Spark uses
    # its split projections, which are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def builder(app: str = "doselake") -> SparkSession.Builder:
    """A session builder carrying ``SETTINGS``; add master and memory to taste."""
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b

#: Bytes of files that a task reads for wide rows, which take some forty times as much in memory.
WIDE_READ_BYTES = 16 * 1024 * 1024


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Settings for what is written inside: rows of 56 columns, or the text of such.

    Tasks read little enough that what they sort and shuffle stays in memory, and shuffle files go when the write that
    made them has ended, instead of whenever the driver collects garbage.
    """
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    now = {
        "spark.sql.files.maxPartitionBytes": str(min(most, WIDE_READ_BYTES)),
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in now}
    for key, value in now.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables.

    It lies in the folder ``spark.checkpoint.dir`` names. Only a local session
    without that setting gets a temporary folder of this machine, because
    executors of a cluster could not read one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="doselake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies in; a missing one is fine."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fan_in(spark: SparkSession) -> int:
    """Number of salts that splits a hot group's merge into two even levels."""
    return max(2, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
