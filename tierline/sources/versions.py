"""Versions of a load: each writes tables of its own, and one pointer names the current one.

A load under ``<root>/loads/<version>`` touches nothing that readers see. The pointer is a
small table, ``<root>/published``; publishing appends one row of one file, which the
writer's commit puts in place in a single step. Until then, and if the load stops half
way, readers stay with the version before. Older versions are dropped afterwards, but for
the last few, so that readers that have begun can finish.

One load at a time may publish under a root; of two that do, the later one wins.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "seq long, version string, published_at timestamp"
KEPT_VERSIONS = 2


def new_version() -> str:
    """A name that sorts by the time it was made."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:6]}"


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/loads/{version}"


def _pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/published"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """``seq, version, published_at`` of all published versions; none if there is no pointer."""
    try:
        return spark.read.schema(POINTER).parquet(_pointer_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POINTER)


def current_version(spark: SparkSession, root: str) -> str | None:
    row = versions(spark, root).agg(F.max(F.struct("seq", "version")).alias("last")).first()
    return row.last.version if row.last else None


def current_path(spark: SparkSession, root: str) -> str:
    """Where the current version's layers are; ``root`` itself if nothing was published there."""
    version = current_version(spark, root)
    return version_path(root, version) if version else root.rstrip("/")


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the current one."""
    last = versions(spark, root).agg(F.max("seq")).first()[0] or 0
    row = spark.createDataFrame([(last + 1, version)], "seq long, version string")
    row = row.withColumn("published_at", F.current_timestamp()).coalesce(1)
    row.write.mode("append").parquet(_pointer_path(root))
    spark.catalog.refreshByPath(_pointer_path(root))


def drop_versions(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Delete the folders of loads older than the last ``keep`` published ones.

    That includes loads that stopped half way. Loads begun later are left alone.
    """
    last = versions(spark, root).orderBy(F.desc("seq")).limit(max(1, keep)).collect()
    if not last:
        return []
    oldest = min(row.version for row in last)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/loads")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in files.listStatus(folder):
        if status.getPath().getName() < oldest:
            files.delete(status.getPath(), True)
            dropped.append(status.getPath().getName())
    return sorted(dropped)
