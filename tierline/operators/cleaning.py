"""Raw to clean: referential filtering, deduplication and safe typing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import is_present, to_type, to_whole_number
from tierline.operators.matching import compared, join_on
from tierline.schemas import AMOUNT, BINARY, CLEAN, collated_columns, conform


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order_by`` (ascending, NULLs first).

    Name every payload column in ``order_by`` and the survivor does not depend on
    row order; values that a collation holds equal are told apart by their bytes. Spark cuts each key to one row per map task before the shuffle
    (WindowGroupLimit), so a key that holds a third of the rows ships one row per
    task.
    """
    def of(columns: Sequence[str | Column]) -> list[Column]:
        return [compared(df, c) if isinstance(c, str) else c for c in columns]

    ranked = Window.partitionBy(*of(keys)).orderBy(*of(order_by or keys), *exact_order(df))
    return (
        df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
    )


def exact_order(df: DataFrame) -> list[Column]:
    """The bytes of collated columns, for the end of an order; nothing where there are none."""
    return [F.collate(name, BINARY) for name in collated_columns(df)]


def unique_keys(df: DataFrame, column: str, alias: str) -> DataFrame:
    """The distinct values of a key, for the lookup side of a join.

    Copies are dropped before the shuffle, so a value that fills a third of the
    rows is sent once per map task. Keeping the key and its hash distinct, not
    the key alone, leaves the join to shuffle by the key itself: only then can
    adaptive execution split a hot key on the join's other side.
    """
    key = F.col(column)
    hashed = df.select(key.alias(alias), F.xxhash64(key).alias("_hash"))
    return hashed.distinct().select(alias)


def keep_referenced(
    df: DataFrame, parent: DataFrame, on: str, *, collation: str | None = None
) -> DataFrame:
    """Rows whose key occurs in ``parent``. A NULL key occurs nowhere.

    ``collation`` compares the key under a Spark collation such as
    ``UNICODE_CI_AI`` instead of byte by byte. The join strategy is left to
    Spark, which broadcasts ``parent`` only when its size is under the threshold.
    """
    if collation is None:
        return join_on(df, parent.select(on), on, "left_semi")
    child_key = F.collate(df[on], collation)
    parent_key = F.collate(parent[on], collation)
    return df.join(parent, child_key == parent_key, "left_semi")


def drop_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every named column holds more than spaces."""
    for name in columns:
        df = df.filter(is_present(name))
    return df


def build_categories(raw: DataFrame) -> DataFrame:
    """Category lookup: one row per non-blank name.

    Of two translations of one name the first in text order stays, where a blank
    one comes last.
    """
    named = drop_blank(raw, ["product_category_name"]).select(*CLEAN["categories"].schema.names)
    english = "product_category_name_english"
    return dedup_first(named, ["product_category_name"], [~is_present(english), english])


def build_products(
    raw: DataFrame,
    categories: DataFrame,
    *,
    collation: str | None = None,
    drop_blank_keys: bool = False,
) -> DataFrame:
    """Products of known categories, one row per id, with numbers typed."""
    if drop_blank_keys:
        raw = drop_blank(raw, ["product_id"])
    known = keep_referenced(raw, categories, "product_category_name", collation=collation)
    measures = {
        "weight_g": "product_weight_g",
        "length_cm": "product_length_cm",
        "height_cm": "product_height_cm",
        "width_cm": "product_width_cm",
    }
    payload = ["product_category_name", "product_photos_qty", *measures.values()]
    unique = dedup_first(known.select("product_id", *payload), ["product_id"], payload)
    return conform(
        unique.select(
            "product_id",
            "product_category_name",
            to_whole_number("product_photos_qty", T.ShortType()).alias("photos_qty"),
            *[to_type(source, AMOUNT).alias(name) for name, source in measures.items()],
        ),
        CLEAN["products"].schema,
    )


def build_customers(raw: DataFrame, *, drop_blank_keys: bool = False) -> DataFrame:
    """Customer profiles, one per customer id, with place names tidied."""
    if drop_blank_keys:
        raw = drop_blank(raw, ["customer_id", "customer_unique_id"])
    known = raw.filter(F.col("customer_id").isNotNull() & F.col("customer_unique_id").isNotNull())
    payload = [
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ]
    unique = dedup_first(known.select("customer_id", *payload), ["customer_id"], payload)
    return conform(
        unique.select(
            "customer_id",
            "customer_unique_id",
            F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
            F.trim("customer_city").alias("city"),
            F.upper(F.trim("customer_state")).alias("state"),
        ),
        CLEAN["customers"].schema,
    )


def build_orders(
    raw: DataFrame, customers: DataFrame, *, drop_blank_keys: bool = False
) -> DataFrame:
    """Orders of known customers, one per order id, with delivery figures.

    ``delivery_days`` counts calendar days from purchase to delivery.
    ``is_delayed`` compares the delivery instant with the estimate as given,
    normally midnight, so a delivery during the estimated day is late. Both are
    NULL until the order is delivered.
    """
    if drop_blank_keys:
        raw = drop_blank(raw, ["order_id"])
    payload = [
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    known = keep_referenced(raw.select("order_id", *payload), customers, "customer_id")
    unique = dedup_first(known, ["order_id"], payload)

    instant = T.TimestampNTZType()
    purchased = to_type("order_purchase_timestamp", instant)
    delivered = to_type("order_delivered_customer_date", instant)
    promised = to_type("order_estimated_delivery_date", instant)
    arrived = is_present("order_delivered_customer_date")
    return conform(
        unique.select(
            "order_id",
            "customer_id",
            "order_status",
            purchased.alias("purchase_ts"),
            to_type("order_approved_at", instant).alias("approved_ts"),
            to_type("order_delivered_carrier_date", instant).alias("delivered_carrier_ts"),
            delivered.alias("delivered_customer_ts"),
            to_type("order_estimated_delivery_date", T.DateType()).alias(
                "estimated_delivery_date"
            ),
            F.when(arrived, F.datediff(F.to_date(delivered), F.to_date(purchased))).alias(
                "delivery_days"
            ),
            arrived.alias("is_delivered"),
            F.when(arrived, delivered > promised).alias("is_delayed"),
        ),
        CLEAN["orders"].schema,
    )
