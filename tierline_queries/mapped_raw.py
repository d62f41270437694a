"""Raw tables derived from the driver's star tables, defects included.

Every rule and check of the library finds something here: orphans, blanks,
malformed amounts, repeated keys, overlong codes. Extra copies are made with
``explode`` in the scan that makes the first copy, so each table is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.schemas import RAW


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _copies(extra: Column) -> Column:
    """0 for the first copy of a row and 1 for its extra copy, if it has one."""
    return F.explode(F.when(extra, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def _text(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.lower("p_type")
    return (
        _table(spark, sf_dir, "part")
        .select(
            name.alias("product_category_name"),
            F.concat(F.lit("en_"), name).alias("product_category_name_english"),
        )
        .distinct()
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    part = _table(spark, sf_dir, "part").withColumn("_copy", _copies(key % 100 == 17))
    return part.select(
        _text("P", "p_partkey").alias("product_id"),
        F.when(key % 53 == 0, F.lit(""))
        .when(key % 97 == 0, F.lit("untranslated"))
        .otherwise(F.lower("p_type"))
        .alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        (3 * F.length("p_name")).cast("string").alias("product_description_lenght"),
        F.when(F.col("_copy") == 1, F.lit("99"))
        .otherwise((size % 7).cast("string"))
        .alias("product_photos_qty"),
        F.when(key % 31 == 0, F.lit(""))
        .otherwise((size * 100).cast("string"))
        .alias("product_weight_g"),
        size.cast("string").alias("product_length_cm"),
        (size + 1).cast("string").alias("product_height_cm"),
        (size + 2).cast("string").alias("product_width_cm"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    home = _table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    placed = (
        _table(spark, sf_dir, "orders")
        .join(home, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("_copy", _copies(F.col("o_orderkey") % 100 == 13))
    )
    return placed.select(
        _text("C", "o_orderkey").alias("customer_id"),
        _text("U", "o_custkey").alias("customer_unique_id"),
        (F.col("o_custkey") + 10000).cast("string").alias("customer_zip_code_prefix"),
        F.when(F.col("_copy") == 1, F.lit(" DUP "))
        .otherwise(F.concat(F.lit(" "), "n_name", F.lit(" ")))
        .alias("customer_city"),
        F.when(F.col("n_nationkey") == 24, F.lit(" xyz"))
        .otherwise(F.concat(F.lit(" "), F.lower(F.substring("r_name", 1, 2))))
        .alias("customer_state"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")

    def text(instant: Column) -> Column:
        return instant.cast("string")

    bought = F.expr("o_orderdate + INTERVAL '1' SECOND * (o_orderkey % 86400)")
    arrival = F.expr("_bought + INTERVAL '1' HOUR * (24 + o_orderkey % 700)")
    base = (
        _table(spark, sf_dir, "orders")
        .withColumn("_copy", _copies(key % 100 == 11))
        .withColumn("_bought", bought)
    )
    return base.select(
        _text("O", "o_orderkey").alias("order_id"),
        F.when(key % 50 == 7, _text("X", "o_orderkey"))
        .otherwise(_text("C", "o_orderkey"))
        .alias("customer_id"),
        F.when(F.col("_copy") == 1, F.lit("canceled"))
        .when(status == "F", F.lit("delivered"))
        .when(status == "O", F.lit("shipped"))
        .otherwise(F.lit("processing"))
        .alias("order_status"),
        text(F.col("_bought")).alias("order_purchase_timestamp"),
        F.when(status == "P", F.lit(""))
        .otherwise(text(F.expr("_bought + INTERVAL '1' HOUR")))
        .alias("order_approved_at"),
        F.when(status == "P", F.lit(""))
        .otherwise(text(F.expr("_bought + INTERVAL '1' DAY")))
        .alias("order_delivered_carrier_date"),
        F.when((status == "F") & (key % 500 == 9), text(F.expr("_bought - INTERVAL '2' DAY")))
        .when((status == "F") & (key % 200 != 3), text(arrival))
        .otherwise(F.lit(""))
        .alias("order_delivered_customer_date"),
        text(F.expr("o_orderdate + INTERVAL '15' DAY")).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, number = F.col("l_suppkey"), F.col("l_linenumber")

    def amount(name: str) -> Column:
        return F.col(name).cast("decimal(10,2)").cast("string")

    return _table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 89 == 0, _text("Z", "l_orderkey"))
        .otherwise(_text("O", "l_orderkey"))
        .alias("order_id"),
        number.cast("string").alias("order_item_id"),
        _text("P", "l_partkey").alias("product_id"),
        _text("S", "l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("string").alias("shipping_limit_date"),
        F.when((supplier % 41 == 0) & (number == 2), F.lit("N/A"))
        .when((supplier % 37 == 0) & (number == 3), F.lit(""))
        .otherwise(amount("l_extendedprice"))
        .alias("price"),
        amount("l_quantity").alias("freight_value"),
    )


BUILDERS = {
    "product_category_translation": categories,
    "products": products,
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir).select(*RAW[name].names)
