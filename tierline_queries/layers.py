"""Layer tables built from one set of driver tables, each written on first use.

In a layered load each step reads the tables that the previous step
wrote. So a query here runs its own operator and reads the inputs from these tables,
which live in the shared checkpoint folder for as long as the session does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierline_queries.mapped_raw import raw_table
from tierline.operators import cleaning, quarantine, star
from tierline.plans.pipeline import write_classified, write_ranked
from tierline.schemas import CLEAN, RAW, STAR
from tierline.session import input_bytes, shared_folder, size_for, tune
from tierline.sources import layer_path, read_table, write_table


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header that keep the spaces around values."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_files(lines: DataFrame, folder: str) -> None:
    """Text files of given names: ``lines`` holds ``file``, ``place`` in it and ``line``."""
    spark, staged = lines.sparkSession, f"{folder}-staged"
    ordered = lines.repartition("file").sortWithinPartitions("file", "place")
    ordered.select("file", "line").write.mode("overwrite").partitionBy("file").text(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, source = hadoop.Path(folder), hadoop.Path(staged)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)
    files.mkdirs(target)
    for part in files.globStatus(hadoop.Path(f"{staged}/file=*/part-*")):
        name = part.getPath().getParent().getName().removeprefix("file=")
        files.rename(part.getPath(), hadoop.Path(target, name))
    files.delete(source, True)


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = size_for(tune(spark), input_bytes(spark, sf_dir))
        self.sf_dir = sf_dir
        self.root = shared_folder(spark)
        self._tables: dict[tuple[str, str], DataFrame] = {}

    def _written(
        self, layer: str, name: str, schema, build: Callable[[], DataFrame]
    ) -> DataFrame:
        known = self._tables.get((layer, name))
        if known is None:
            path = layer_path(self.root, layer, name)
            write_table(build(), path)
            known = self._tables[layer, name] = read_table(self.spark, path, schema)
        return known

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to a work table of its own and read back."""
        path = layer_path(self.root, "work", f"{name}-{uuid.uuid4().hex[:8]}")
        write_table(df, path)
        return read_table(self.spark, path, df.schema)

    def mapped(self, name: str) -> DataFrame:
        """The mapping itself, not yet written."""
        return raw_table(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return self._written("bronze", name, RAW[name], lambda: self.mapped(name))

    def classified(self) -> DataFrame:
        key = ("work", "classified_order_items")
        if key not in self._tables:
            self._tables[key] = write_classified(
                self.spark,
                self.raw("order_items"),
                self.clean("orders"),
                self.clean("products"),
                layer_path(self.root, *key),
            )
        return self._tables[key]

    def ranked(self) -> DataFrame:
        key = ("work", "ranked_order_items")
        if key not in self._tables:
            path = layer_path(self.root, *key)
            self._tables[key] = write_ranked(self.spark, self.classified(), path)
        return self._tables[key]

    def exact_quarantine(self) -> DataFrame:
        return quarantine.build_exact_quarantine(self.classified(), self.ranked())

    def profiles(self) -> DataFrame:
        return self._written(
            "work",
            "order_profiles",
            None,
            lambda: star.build_order_profiles(self.clean("orders"), self.clean("customers")),
        )

    def clean(self, name: str) -> DataFrame:
        return self._written("silver", name, CLEAN[name].schema, lambda: self.build_clean(name))

    def star(self, name: str) -> DataFrame:
        return self._written("gold", name, STAR[name].schema, lambda: self.build_star(name))

    def build_clean(self, name: str) -> DataFrame:
        """One clean table's operator over its written inputs."""
        if name == "categories":
            return cleaning.build_categories(self.raw("product_category_translation"))
        if name == "products":
            return cleaning.build_products(self.raw("products"), self.clean("categories"))
        if name == "customers":
            return cleaning.build_customers(self.raw("customers"))
        if name == "orders":
            return cleaning.build_orders(self.raw("orders"), self.clean("customers"))
        if name == "order_items":
            return quarantine.build_order_items(self.classified())
        return quarantine.build_quarantine(self.classified())

    def classify_live(self) -> DataFrame:
        """Classification over raw line items, not written in between."""
        return quarantine.classify_order_items(
            self.raw("order_items"), self.clean("orders"), self.clean("products")
        )

    def build_star(self, name: str) -> DataFrame:
        """One star table's operator over its written inputs."""
        if name == "dim_products":
            return star.build_dim_products(self.clean("products"), self.clean("categories"))
        if name == "dim_customers":
            return star.people_from_profiles(self.profiles(), self.clean("order_items"))
        return star.fact_from_profiles(self.clean("order_items"), self.profiles())

    def all_raw(self) -> dict[str, DataFrame]:
        return {name: self.raw(name) for name in RAW}

    def all_clean(self) -> dict[str, DataFrame]:
        return {name: self.clean(name) for name in CLEAN}

    def all_star(self) -> dict[str, DataFrame]:
        return {name: self.star(name) for name in STAR}

    def star_path(self, name: str) -> str:
        self.star(name)
        return layer_path(self.root, "gold", name)


_LAYERS: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers of this session and directory."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LAYERS:
        _LAYERS[key] = Layers(spark, key[1])
    return _LAYERS[key]
