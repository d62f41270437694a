"""Layers as catalog databases: create, publish, list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_layers(
    spark: SparkSession,
    layers: Sequence[str],
    *,
    root: str | None = None,
    drop_existing: bool = False,
) -> None:
    """Create one database per layer, located under ``root`` if given.

    ``drop_existing`` drops the databases with everything in them first.
    """
    for layer in layers:
        if drop_existing:
            spark.sql(f"DROP DATABASE IF EXISTS `{layer}` CASCADE")
        location = f" LOCATION '{root.rstrip('/')}/{layer}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{location}")


def publish_table(df: DataFrame, layer: str, table: str) -> DataFrame:
    """Write ``df`` as the managed table ``layer.table``, replacing its contents."""
    spark = df.sparkSession
    create_layers(spark, [layer])
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{layer}`.`{table}`")
    return spark.table(f"`{layer}`.`{table}`")


def register_table(spark: SparkSession, layer: str, table: str, path: str) -> DataFrame:
    """Name an already written parquet table in the catalog; no data moves.

    The catalog lists the folders of a partitioned table itself, so they are recovered.
    """
    create_layers(spark, [layer])
    name = f"`{layer}`.`{table}`"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, table_rows`` with exact counts, all in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("table_rows")).select(
            F.lit(name).alias("table_name"), "table_rows"
        )
        for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts)


def list_layer(spark: SparkSession, layer: str) -> DataFrame:
    """The tables the catalog knows in one layer, with exact row counts."""
    names = [t.name for t in spark.catalog.listTables(layer) if not t.isTemporary]
    if not names:
        return spark.createDataFrame([], "table_name string, table_rows bigint")
    return count_tables({name: spark.table(f"`{layer}`.`{name}`") for name in names})
