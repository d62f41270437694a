"""Parquet tables under ``<root>/<layer>/<table>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), *, gather: bool = True
) -> None:
    """Replace the table at ``path``; running a load twice gives the same table.

    With ``partition_by`` rows are first gathered by those columns through a
    rebalance, which merges small partition values and splits large ones into
    several files, so one busy month is not written by a single task. For columns
    of a few values ``gather=False`` saves that shuffle: each task then writes one
    file per value.
    """
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # Tables registered at this path must list the new files on their next read.
    df.sparkSession.catalog.refreshByPath(path)


LOAD = "load_id"
# Formats read without aggregate push-down; a frame keeps the reader it was made with.
_OLD_READERS = "spark.sql.sources.useV1SourceList"


def append_load(df: DataFrame, path: str, load_id: str) -> None:
    """Add the rows of one load to the table at ``path``.

    The table has one folder per load. Repeating a load replaces its own folder and no
    other, so rows are added once however often it runs; a load that stops adds nothing.
    """
    (
        df.withColumn(LOAD, F.lit(load_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD)
        .parquet(path)
    )
    df.sparkSession.catalog.refreshByPath(path)


def read_loads(
    spark: SparkSession, path: str, schema: T.StructType, loads: Sequence[str] | None = None
) -> DataFrame:
    """Rows of all loads, or of some, with the column ``load_id``. Only their folders are read."""
    with_load = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    rows = spark.read.schema(with_load).parquet(path)
    return rows if loads is None else rows.where(F.col(LOAD).isin(*loads))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a written table; a known schema saves the inference job."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_footers(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A written table for counts and ranges that the files' footers know.

    Row counts, and least and greatest values of whole numbers and dates, are answered from
    the footers as long as nothing is filtered or grouped by other than folders; decimals,
    timestamps and text are read as usual. Only this reader asks footers, so tables for
    any other use come from ``read_table``.
    """
    listed = spark.conf.get(_OLD_READERS)
    others = [name for name in listed.split(",") if name != "parquet"]
    spark.conf.set(_OLD_READERS, ",".join(others))
    try:
        return read_table(spark, path, schema)
    finally:
        spark.conf.set(_OLD_READERS, listed)
