"""The checks to run after each layer."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import quality, quarantine
from tierline.plans.checks import (
    Check,
    CountCheck,
    DomainCheck,
    KeyCheck,
    OrphanCheck,
    PairCheck,
    ReconcileCheck,
    RepeatCount,
    RowCheck,
)
from tierline.schemas import AMOUNT, CLEAN, IS_MALFORMED, STAR, Table

# Row counts to expect from the public order data set the raw
# layout was made for, and the text shapes the raw columns should have.
PUBLIC_DATA_ROWS: dict[str, int] = {
    "product_category_translation": 71,
    "products": 32_951,
    "customers": 99_441,
    "orders": 99_441,
    "order_items": 112_650,
}
LOOSE_DECIMAL = r"^[0-9]*\.?[0-9]*$"
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
STATE_CODE_BYTES = 2

# Types the text columns are cast to on the way to the clean layer.
PRODUCT_CASTS: dict[str, T.DataType] = {
    "product_weight_g": AMOUNT,
    "product_length_cm": AMOUNT,
    "product_height_cm": AMOUNT,
    "product_width_cm": AMOUNT,
}
ORDER_CASTS: dict[str, T.DataType] = {
    "order_purchase_timestamp": T.TimestampNTZType(),
    "order_approved_at": T.TimestampNTZType(),
    "order_delivered_carrier_date": T.TimestampNTZType(),
    "order_delivered_customer_date": T.TimestampNTZType(),
    "order_estimated_delivery_date": T.DateType(),
}

def delivered_without_date() -> Column:
    """An order says it is delivered but has no delivery date."""
    return quality.breaks_implication(
        F.col("order_status") == "delivered", ["order_delivered_customer_date"]
    )


def raw_suite(
    expected_rows: Mapping[str, int] | None = None,
    tolerance: float = 0.05,
    *,
    blank_is_missing: bool = True,
    check_all_casts: bool = False,
    malformed: bool = False,
) -> list[Check]:
    """Checks on the raw layer, before anything is cleaned.

    ``blank_is_missing`` extends the NULL checks to blank text, which is how the
    ingest spells an empty field. ``check_all_casts`` adds every other column that
    is cast later, ``malformed`` counts records that had another number of fields, which
    tables with lineage columns know.
    """
    expected_rows = expected_rows or {}
    lookup, products, customers = "product_category_translation", "products", "customers"
    orders, items = "orders", "order_items"

    checks: list[Check] = [
        CountCheck(table, "row count", expected_rows.get(table), tolerance)
        for table in (lookup, products, customers, orders, items)
    ]
    checks += [
        RowCheck(lookup, "missing name", quality.is_missing(["product_category_name"])),
        RowCheck(products, "missing id", quality.is_missing(["product_id"])),
        RowCheck(
            customers,
            "missing ids",
            quality.is_missing(["customer_id", "customer_unique_id"], blank_is_missing),
        ),
        RowCheck(
            orders,
            "missing ids or purchase time",
            quality.is_missing(
                ["order_id", "customer_id", "order_purchase_timestamp"], blank_is_missing
            ),
        ),
        RowCheck(
            items, "missing ids", quality.is_missing(["order_id", "product_id"], blank_is_missing)
        ),
        KeyCheck(lookup, "repeated names", ("product_category_name",)),
        KeyCheck(products, "repeated ids", ("product_id",)),
        KeyCheck(customers, "repeated ids", ("customer_id",)),
        KeyCheck(items, "repeated item numbers", ("order_id", "order_item_id")),
        OrphanCheck(
            products,
            "untranslated categories",
            "product_category_name",
            lookup,
            "product_category_name",
            ignore_null=True,
            distinct=True,
        ),
        RowCheck(
            products,
            "malformed measures",
            quality.breaks_pattern(
                {"product_weight_g": LOOSE_DECIMAL, "product_length_cm": LOOSE_DECIMAL}
            ),
        ),
        DomainCheck(orders, "distinct statuses", "order_status"),
        RowCheck(orders, "delivered without date", delivered_without_date()),
        RowCheck(
            orders,
            "malformed purchase time",
            quality.breaks_pattern({"order_purchase_timestamp": TIMESTAMP_SHAPE}),
        ),
        RowCheck(
            items,
            "malformed amounts",
            quality.breaks_pattern(
                {
                    "price": quarantine.UNSIGNED_DECIMAL,
                    "freight_value": quarantine.UNSIGNED_DECIMAL,
                }
            ),
        ),
    ]
    if malformed:
        checks += [
            RowCheck(table, "malformed records", F.col(IS_MALFORMED))
            for table in (lookup, products, customers, orders, items)
        ]
    if check_all_casts:
        checks += [
            RowCheck(products, f"{name} not castable", quality.loses_value({name: kind}))
            for name, kind in PRODUCT_CASTS.items()
        ]
        checks += [
            RowCheck(orders, f"{name} not castable", quality.loses_value({name: kind}))
            for name, kind in ORDER_CASTS.items()
        ]
        checks.append(RowCheck(items, "missing seller", quality.is_missing(["seller_id"])))
    return checks


def constraint_checks(tables: Mapping[str, Table]) -> list[Check]:
    """Key, not-null and foreign-key checks from the declared constraints."""
    checks: list[Check] = []
    for name, table in tables.items():
        if table.key:
            checks.append(KeyCheck(name, "repeated keys", table.key))
        required = [*table.key, *table.not_null]
        if required:
            checks.append(RowCheck(name, "null in required column", quality.is_missing(required, False)))
        for fk in table.foreign_keys:
            checks.append(
                OrphanCheck(
                    name,
                    f"{fk.column} not in {fk.parent}",
                    fk.column,
                    fk.parent,
                    fk.parent_column,
                    ignore_null=fk.column not in required,
                    unique_parent=tables[fk.parent].key == (fk.parent_column,),
                )
            )
    return checks


def clean_suite(
    expected_rows: Mapping[str, int] | None = None,
    tolerance: float = 0.05,
    *,
    exact: bool = False,
    strict: bool = False,
) -> list[Check]:
    """Checks on the clean layer: constraints, value ranges, reconciliation.

    Every raw line item must be accounted for: the tables include ``raw_order_items``
    and, as the default split leaves duplicates out, ``accepted_order_items``, the keys
    before dedup, by which these are counted. With ``exact`` they are in quarantine.
    ``tolerance`` is for ``expected_rows`` only.
    """
    expected_rows = expected_rows or {}
    items, rejected = "order_items", "quarantine_order_items"
    expected_items = expected_rows.get(items)
    checks = constraint_checks(CLEAN)
    checks += [
        RowCheck(
            "categories",
            "blank translation",
            quality.is_missing(["product_category_name_english"]),
        ),
        RowCheck(
            "products",
            "negative measures",
            quality.is_negative(["weight_g", "length_cm", "height_cm", "width_cm"]),
        ),
        RowCheck(
            "customers",
            "state code length",
            quality.has_wrong_length("state", STATE_CODE_BYTES),
        ),
        RowCheck("orders", "negative delivery days", quality.is_negative(["delivery_days"])),
        PairCheck(
            "orders",
            "delivered rows have delivery days",
            F.col("is_delivered"),
            F.col("delivery_days").isNotNull(),
        ),
        CountCheck("orders", "row count", expected_rows.get("orders"), tolerance),
        RowCheck(items, "negative amounts", quality.is_negative(["price", "freight_value"])),
        CountCheck(items, "row count"),
        CountCheck(rejected, "row count"),
    ]
    reasons = [
        quarantine.ORDER_NOT_FOUND,
        quarantine.PRODUCT_NOT_FOUND,
        quarantine.NOT_NUMERIC,
        quarantine.DUPLICATE_ITEM,
    ]
    if strict:
        reasons.append(quarantine.MALFORMED_RECORD)
    checks += [
        CountCheck(rejected, f"rows: {reason}", where=F.col(quarantine.REASON) == reason)
        for reason in reasons
    ]
    accounted = ReconcileCheck(
        items, "every raw row accounted for", (items, rejected), whole="raw_order_items"
    )
    if not exact:
        accepted, key = "accepted_order_items", CLEAN[items].key
        accounted = replace(accounted, repeats_in=accepted, keys=key)
        checks.append(RepeatCount(items, "left out as duplicates", accepted, key))
    checks.append(accounted)
    if expected_items is not None:
        checks.append(
            ReconcileCheck(
                items,
                "good and quarantined rows",
                (items, rejected),
                expected=expected_items,
                tolerance=tolerance,
            )
        )
    return checks


def star_suite() -> list[Check]:
    """Checks on the star layer: its keys, and no line item lost on the way."""
    return [
        *constraint_checks(STAR),
        ReconcileCheck(
            "fact_order_items", "one fact row per item", ("fact_order_items",), whole="order_items"
        ),
    ]
