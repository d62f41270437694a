"""Declared shapes and keys of every table in the three layers.

Column names, their order and the raw-column misspellings are fixed values: the
raw columns are bound to the CSV files by position, and the clean and star names
are what every report refers to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import BINARY

AMOUNT = T.DecimalType(10, 2)
# Sums are wider than a single amount: one person, product or month may hold a
# third of all line items, and a cast that overflows ends the job.
AMOUNT_SUM = T.DecimalType(20, 2)

_STRING = T.StringType()
_NTZ = T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, _STRING) for name in names])


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    """A typed table and the constraints its contents must satisfy."""

    schema: T.StructType
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()


LINEAGE = _struct(
    _ingested_at=T.TimestampType(), _source_file=_STRING, _is_malformed=T.BooleanType()
)
SOURCE_FILE, IS_MALFORMED = "_source_file", "_is_malformed"

RAW: dict[str, T.StructType] = {
    "product_category_translation": _strings(
        "product_category_name", "product_category_name_english"
    ),
    "products": _strings(
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "customers": _strings(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "orders": _strings(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": _strings(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
}

# File name patterns under the input directory, one per raw table. A table may
# arrive as one file or as many parts.
RAW_FILES: dict[str, str] = {
    "product_category_translation": "*category_name_translation.csv",
    "products": "*products_dataset.csv",
    "customers": "*customers_dataset.csv",
    "orders": "*orders_dataset.csv",
    "order_items": "*order_items_dataset.csv",
}

CLEAN: dict[str, Table] = {
    "categories": Table(
        _struct(product_category_name=_STRING, product_category_name_english=_STRING),
        key=("product_category_name",),
        not_null=("product_category_name_english",),
    ),
    "products": Table(
        _struct(
            product_id=_STRING,
            product_category_name=_STRING,
            photos_qty=T.ShortType(),
            weight_g=AMOUNT,
            length_cm=AMOUNT,
            height_cm=AMOUNT,
            width_cm=AMOUNT,
        ),
        key=("product_id",),
        foreign_keys=(
            ForeignKey("product_category_name", "categories", "product_category_name"),
        ),
    ),
    "customers": Table(
        _struct(
            customer_id=_STRING,
            customer_unique_id=_STRING,
            zip_code_prefix=_STRING,
            city=_STRING,
            state=_STRING,
        ),
        key=("customer_id",),
        not_null=("customer_unique_id",),
    ),
    "orders": Table(
        _struct(
            order_id=_STRING,
            customer_id=_STRING,
            order_status=_STRING,
            purchase_ts=_NTZ,
            approved_ts=_NTZ,
            delivered_carrier_ts=_NTZ,
            delivered_customer_ts=_NTZ,
            estimated_delivery_date=T.DateType(),
            delivery_days=T.IntegerType(),
            is_delivered=T.BooleanType(),
            is_delayed=T.BooleanType(),
        ),
        key=("order_id",),
        not_null=("customer_id", "order_status", "purchase_ts", "is_delivered"),
        foreign_keys=(ForeignKey("customer_id", "customers", "customer_id"),),
    ),
    "order_items": Table(
        _struct(
            order_id=_STRING,
            order_item_id=T.IntegerType(),
            product_id=_STRING,
            seller_id=_STRING,
            price=AMOUNT,
            freight_value=AMOUNT,
        ),
        key=("order_id", "order_item_id"),
        not_null=("product_id", "seller_id", "price", "freight_value"),
        foreign_keys=(
            ForeignKey("order_id", "orders", "order_id"),
            ForeignKey("product_id", "products", "product_id"),
        ),
    ),
    "quarantine_order_items": Table(
        _struct(
            order_id=_STRING,
            order_item_id=_STRING,
            product_id=_STRING,
            seller_id=_STRING,
            price=_STRING,
            freight_value=_STRING,
            rejection_reason=_STRING,
        )
    ),
}

STAR: dict[str, Table] = {
    "dim_products": Table(
        _struct(
            product_id=_STRING,
            category_english=_STRING,
            weight_g=AMOUNT,
            length_cm=AMOUNT,
            height_cm=AMOUNT,
            width_cm=AMOUNT,
        ),
        key=("product_id",),
    ),
    "dim_customers": Table(
        _struct(
            customer_unique_id=_STRING,
            city=_STRING,
            state=_STRING,
            total_orders=T.LongType(),
            total_spent=AMOUNT_SUM,
            avg_order_value=AMOUNT,
        ),
        key=("customer_unique_id",),
    ),
    "fact_order_items": Table(
        _struct(
            order_id=_STRING,
            order_item_id=T.IntegerType(),
            product_id=_STRING,
            customer_unique_id=_STRING,
            seller_id=_STRING,
            order_status=_STRING,
            purchase_ts=_NTZ,
            price=AMOUNT,
            freight_value=AMOUNT,
            delivery_days=T.IntegerType(),
            is_delayed=T.BooleanType(),
        ),
        key=("order_id", "order_item_id"),
        foreign_keys=(
            ForeignKey("product_id", "dim_products", "product_id"),
            ForeignKey("customer_unique_id", "dim_customers", "customer_unique_id"),
        ),
    ),
}


# Columns that identify or group rows. Under a collation these are compared by it.
KEY_TEXT = (
    "product_category_name",
    "product_category_name_english",
    "product_id",
    "customer_id",
    "customer_unique_id",
    "order_id",
    "category_english",
    "city",
    "state",
)


def collated(df: DataFrame, collation: str | None) -> DataFrame:
    """``df`` with its key columns compared under ``collation``; as it is without one.

    Joins, groups, dedup and distinct counts then follow the collation by themselves; where
    many rows meet, operators compare ``matching.compared`` instead, which is faster.
    """
    if collation is None:
        return df
    return df.select(*[F.collate(c, collation).alias(c) if c in KEY_TEXT else F.col(c) for c in df.columns])


def collated_columns(df: DataFrame) -> list[str]:
    """Text columns that are not compared byte by byte."""
    kinds = ((f.name, f.dataType) for f in df.schema.fields)
    return [name for name, kind in kinds if isinstance(kind, T.StringType) and kind.collation != BINARY]


def plain(df: DataFrame) -> DataFrame:
    """``df`` with all text compared byte by byte, as tables are stored."""
    there = set(collated_columns(df))
    if not there:
        return df
    return df.select(*[F.collate(c, BINARY).alias(c) if c in there else F.col(c) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, in its order, in its types."""
    have = {field.name: field.dataType for field in df.schema.fields}

    def column(field: T.StructField) -> Column:
        if have[field.name] == field.dataType:
            return F.col(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])
