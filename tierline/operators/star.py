"""Clean to star: two dimensions and the line-item fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import half_up_ratio
from tierline.operators.matching import compared, join_on
from tierline.schemas import BINARY, STAR, collated_columns, conform


def build_dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with the English category name joined in."""
    named = join_on(products, categories, "product_category_name", "left")
    return conform(
        named.withColumnRenamed("product_category_name_english", "category_english"),
        STAR["dim_products"].schema,
    )


def build_order_profiles(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the person behind them: one row per order id.

    Both the person dimension and the fact start from this frame, so a load
    writes it once. It joins at order grain; line items meet it on the order id,
    the only key they are ever shuffled by.
    """
    return join_on(orders, customers, "customer_id").select(
        "order_id",
        "customer_unique_id",
        "city",
        "state",
        "order_status",
        "purchase_ts",
        "delivery_days",
        "is_delayed",
    )


def people_from_profiles(profiles: DataFrame, items: DataFrame) -> DataFrame:
    """One row per person who bought something: orders, spend, average line.

    ``avg_order_value`` is the average per line item, freight included. Items are
    summed per order before anything is joined: the sum runs partly in the map
    tasks, so neither a huge order nor a busy person sends its line items to one
    task, and distinct orders become a plain count.
    """
    line = F.col("price") + F.col("freight_value")
    per_order = items.groupBy(compared(items, "order_id").alias("order_id")).agg(
        F.sum(line).alias("spent"), F.count(line).alias("lines")
    )
    spent, lines = F.sum("spent"), F.sum("lines")
    person = "customer_unique_id"
    # Under a collation one person may be spelled in several ways; the least one is stored.
    written = [F.collate(person, BINARY).alias("_written")] if person in collated_columns(profiles) else []
    spelled = [F.min("_written").alias("_spelled") for _ in written]
    people = (
        profiles.select(*[compared(profiles, c).alias(c) for c in ("order_id", person)], *written, "city", "state")
        .join(per_order, "order_id")
        .groupBy(person)
        .agg(
            *[_greatest(profiles, name) for name in ("city", "state")],
            *spelled,
            F.count("order_id").alias("total_orders"),
            spent.alias("total_spent"),
            half_up_ratio(spent, lines, 2).alias("avg_order_value"),
        )
    )
    if spelled:
        people = people.withColumn(person, F.col("_spelled"))
    return conform(people, STAR["dim_customers"].schema)


def _greatest(df: DataFrame, name: str) -> Column:
    """The greatest text; of those a collation holds equal, the one of the greatest bytes."""
    if name not in collated_columns(df):
        return F.max(name).alias(name)
    exact = F.struct(compared(df, name).alias("text"), F.collate(name, BINARY).alias("exact"))
    return F.max(F.when(F.col(name).isNotNull(), exact))["exact"].alias(name)


def fact_from_profiles(items: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per line item with its order's and its person's attributes."""
    placed = profiles.drop("city", "state")
    return conform(join_on(items, placed, "order_id"), STAR["fact_order_items"].schema)


def build_dim_customers(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    return people_from_profiles(build_order_profiles(orders, customers), items)


def build_fact_order_items(
    items: DataFrame, orders: DataFrame, customers: DataFrame
) -> DataFrame:
    return fact_from_profiles(items, build_order_profiles(orders, customers))
