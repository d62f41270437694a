"""Business reports over the star schema.

Reports that need an attribute of a dimension aggregate the fact to the
dimension's key before joining: that sum starts in the map tasks, and what is
joined is one row per key, so a key holding a third of the fact costs no more
than any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import half_up_ratio, month_of
from tierline.schemas import AMOUNT_SUM

# Default spend tiers, highest first, and the tier for the rest.
SPEND_TIERS: tuple[tuple[str, int], ...] = (("High Value", 1000), ("Mid Value", 300))
LOWEST_TIER = "Low Value"


def _money(total: Column) -> Column:
    return total.cast(AMOUNT_SUM)


def monthly_trend(fact: DataFrame) -> DataFrame:
    """Orders, revenue and revenue per order by purchase month."""
    revenue, orders = F.sum("price"), F.count_distinct("order_id")
    return (
        fact.groupBy(month_of("purchase_ts").alias("order_month"))
        .agg(
            orders.alias("total_orders"),
            _money(revenue).alias("total_revenue"),
            half_up_ratio(revenue, orders, 2).alias("avg_order_value"),
        )
        .orderBy("order_month")
    )


def running_revenue(fact: DataFrame) -> DataFrame:
    """Monthly revenue and its running total.

    The running total is one ordered pass over the months, a handful of rows
    however large the fact is.
    """
    monthly = fact.groupBy(month_of("purchase_ts").alias("order_month")).agg(
        _money(F.sum("price")).alias("monthly_revenue")
    )
    so_far = Window.orderBy("order_month").rangeBetween(Window.unboundedPreceding, 0)
    return monthly.select(
        "order_month",
        "monthly_revenue",
        _money(F.sum("monthly_revenue").over(so_far)).alias("running_total_revenue"),
    ).orderBy("order_month")


def running_total(
    rows: DataFrame, by: str, value: str, keep: Callable[[DataFrame], DataFrame], name: str = "running_total"
) -> DataFrame:
    """``rows`` with the sum of ``value`` up to and including their ``by``, nulls of ``by`` first.

    Rows of equal ``by`` get the same sum. No task sees more than its range: values are
    summed per distinct key, the keys are dealt out by range and written (``keep`` writes
    a frame and reads it back), each range is summed in order, and the totals of the
    ranges before it, one number per range, are added. Every row then looks up its key;
    adaptive execution splits a key that many rows share.
    """
    key = F.col(by).alias("_key")
    totals = rows.groupBy(key).agg(F.sum(value).alias("_own"))
    ranged = keep(totals.repartitionByRange("_key").withColumn("_range", F.spark_partition_id()))
    kind = ranged.schema["_own"].dataType
    before, offsets = None, []
    # At most as many rows as shuffle partitions.
    for r in ranged.groupBy("_range").agg(F.sum("_own").alias("total")).orderBy("_range").collect():
        offsets.append((r["_range"], before))
        before = r.total if before is None else before if r.total is None else before + r.total
    spark = rows.sparkSession
    schema = T.StructType([T.StructField("_range", T.IntegerType()), T.StructField("_before", kind)])
    along = Window.partitionBy("_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.withColumn("_so_far", F.sum("_own").over(along).cast(kind))
    summed = within.join(spark.createDataFrame(offsets, schema), "_range").select(
        "_key", F.coalesce(F.col("_so_far") + F.col("_before"), "_so_far", "_before").alias(name)
    )
    return rows.join(summed, rows[by].eqNullSafe(summed["_key"])).drop("_key")


def running_revenue_by_order(fact: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Every order's revenue, and the revenue of all orders up to its purchase time."""
    orders = fact.groupBy("order_id", "purchase_ts").agg(_money(F.sum("price")).alias("revenue"))
    total = running_total(orders, "purchase_ts", "revenue", keep, "running_total_revenue")
    return total.withColumn("running_total_revenue", _money(F.col("running_total_revenue")))


def spend_segments(
    dim_customers: DataFrame, tiers: tuple[tuple[str, int], ...] = SPEND_TIERS
) -> DataFrame:
    """People by spend tier; a tier starts at its threshold."""
    segment = F.lit(LOWEST_TIER)
    for name, threshold in sorted(tiers, key=lambda tier: tier[1]):
        segment = F.when(F.col("total_spent") >= threshold, F.lit(name)).otherwise(segment)
    return (
        dim_customers.groupBy(segment.alias("spend_segment"))
        .agg(
            F.count(F.lit(1)).alias("num_customers"),
            half_up_ratio(F.sum("total_spent"), F.count("total_spent"), 2).alias(
                "avg_spent_in_segment"
            ),
            half_up_ratio(F.sum("total_orders"), F.count("total_orders"), 2).alias(
                "avg_orders_in_segment"
            ),
        )
        .orderBy(F.desc("avg_spent_in_segment"), "spend_segment")
    )


def purchase_range(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.min("purchase_ts").alias("earliest_order"), F.max("purchase_ts").alias("latest_order")
    )


def price_range(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        half_up_ratio(F.sum("price"), F.count("price"), 2).alias("avg_price"),
    )


def delivery_range(fact: DataFrame, *, delivered_only: bool = True) -> DataFrame:
    """Shortest and longest delivery among delivered items.

    Items not delivered have no days, which neither figure counts anyway; without the
    filter the two can come from file footers.
    """
    if delivered_only:
        fact = fact.filter(F.col("delivery_days").isNotNull())
    return fact.agg(
        F.min("delivery_days").alias("fastest_delivery"),
        F.max("delivery_days").alias("slowest_delivery"),
    )


def category_list(dim_products: DataFrame) -> DataFrame:
    return dim_products.select("category_english").distinct().orderBy("category_english")


def state_list(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.select("state").distinct().orderBy("state")


def _by_state(per_person: DataFrame, dim_customers: DataFrame, *totals: str) -> DataFrame:
    """Totals per person brought to state level; both sides have one row per person."""
    places = dim_customers.select("customer_unique_id", "state")
    return (
        per_person.join(places, "customer_unique_id")
        .groupBy("state")
        .agg(*[F.sum(name).alias(name) for name in totals])
    )


def revenue_by_state(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Orders and revenue by the person's state.

    An order belongs to one person, so a state's distinct orders are the sum over
    its people.
    """
    per_person = fact.groupBy("customer_unique_id").agg(
        F.count_distinct("order_id").alias("total_orders"), F.sum("price").alias("revenue")
    )
    by_state = _by_state(per_person, dim_customers, "total_orders", "revenue")
    return by_state.select(
        "state", "total_orders", _money(F.col("revenue")).alias("total_revenue")
    ).orderBy(F.desc("total_revenue"), "state")


def _delivery_report(by_state: DataFrame) -> DataFrame:
    return by_state.select(
        "state",
        "total_orders",
        half_up_ratio(F.col("days"), F.col("timed"), 1).alias("avg_delivery_days"),
        half_up_ratio(100 * F.col("late"), F.col("total_orders"), 2).alias("pct_orders_delayed"),
    ).orderBy(F.desc("pct_orders_delayed"), "state")


def delivery_performance(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Delivery time and delay rate by state, over delivered line items.

    The rate divides late line items by distinct orders, so it can pass 100; see
    :func:`delivery_performance_by_order` for the share of late orders.
    """
    per_person = (
        fact.filter(F.col("delivery_days").isNotNull())
        .groupBy("customer_unique_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("delivery_days").alias("days"),
            F.count("delivery_days").alias("timed"),
            F.sum(F.col("is_delayed").cast("int")).alias("late"),
        )
    )
    return _delivery_report(
        _by_state(per_person, dim_customers, "total_orders", "days", "timed", "late")
    )


def delivery_performance_by_order(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """As :func:`delivery_performance`, counting each order once in every figure."""
    per_order = (
        fact.filter(F.col("delivery_days").isNotNull())
        .groupBy("customer_unique_id", "order_id")
        .agg(
            F.max("delivery_days").alias("delivery_days"),
            F.max(F.col("is_delayed").cast("int")).alias("late"),
        )
    )
    per_person = per_order.groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("delivery_days").alias("days"),
        F.count("delivery_days").alias("timed"),
        F.sum("late").alias("late"),
    )
    return _delivery_report(
        _by_state(per_person, dim_customers, "total_orders", "days", "timed", "late")
    )


def top_products(fact: DataFrame, dim_products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the highest revenue; ties go to the smaller id."""
    per_product = fact.groupBy("product_id").agg(
        _money(F.sum("price")).alias("total_revenue"), F.count(F.lit(1)).alias("units_sold")
    )
    return (
        per_product.join(dim_products.select("product_id", "category_english"), "product_id")
        .select("product_id", "category_english", "total_revenue", "units_sold")
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(n)
    )


def top_categories(fact: DataFrame, dim_products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with the highest revenue; ties go to the smaller name.

    One order may span categories, so its distinct count needs order and category
    together and the dimension is joined at line-item grain: broadcast if small,
    else a shuffle join whose hot products adaptive execution splits.
    """
    return (
        fact.join(dim_products.select("product_id", "category_english"), "product_id")
        .groupBy("category_english")
        .agg(
            _money(F.sum("price")).alias("total_revenue"),
            F.count_distinct("order_id").alias("total_orders"),
        )
        .orderBy(F.desc("total_revenue"), "category_english")
        .limit(n)
    )
