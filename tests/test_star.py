import datetime as dt
from decimal import Decimal as D

import pytest

from helpers import bag, text_frame
from tierline.operators import star
from tierline.schemas import CLEAN, STAR


def table(spark, name, data):
    return spark.createDataFrame(data, CLEAN[name].schema)


DAY = dt.datetime(2018, 3, 1, 12, 0)


def order(oid, customer, days=None, late=None):
    return (oid, customer, "delivered", DAY, None, None, None, None, days, days is not None, late)


@pytest.fixture(scope="module")
def clean(spark):
    return {
        "customers": table(
            spark,
            "customers",
            [
                ("c1", "u1", "1", "Rio", "RJ"),
                ("c2", "u1", "1", "Ubatuba", "AA"),
                ("c3", "u2", "1", "Natal", "RN"),
                ("c4", "u3", "1", "Never", "XX"),
            ],
        ),
        "orders": table(
            spark,
            "orders",
            [order("o1", "c1", 3, True), order("o2", "c2"), order("o3", "c3", 1, False),
             order("o4", "c4")],
        ),
        "order_items": table(
            spark,
            "order_items",
            [
                ("o1", 1, "p1", "s1", D("10.00"), D("1.00")),
                ("o1", 2, "p2", "s1", D("20.00"), D("2.01")),
                ("o2", 1, "p1", "s1", D("5.00"), D("0.50")),
                ("o3", 1, "p1", "s2", D("7.00"), D("0.00")),
            ],
        ),
    }


def test_dim_products_keep_products_without_translation(spark):
    products = table(
        spark,
        "products",
        [("p1", "a", 1, D("1"), D("2"), D("3"), D("4")), ("p2", None, 1, None, None, None, None)],
    )
    categories = text_frame(spark, CLEAN["categories"].schema.names, [("a", "A"), ("b", "B")])
    got = star.build_dim_products(products, categories)
    assert got.schema.simpleString() == STAR["dim_products"].schema.simpleString()
    assert bag(got) == [
        ("p1", "A", D("1.00"), D("2.00"), D("3.00"), D("4.00")),
        ("p2", None, None, None, None, None),
    ]


def test_dim_customers_is_per_person(clean):
    got = star.build_dim_customers(clean["customers"], clean["orders"], clean["order_items"])
    assert got.schema.simpleString() == STAR["dim_customers"].schema.simpleString()
    # City and state are each the largest, even from different profiles, and the
    # average is per line item. A person without accepted items is not listed.
    assert bag(got) == [
        ("u1", "Ubatuba", "RJ", 2, D("38.51"), D("12.84")),
        ("u2", "Natal", "RN", 1, D("7.00"), D("7.00")),
    ]


def test_fact_has_one_row_per_item(clean):
    got = star.build_fact_order_items(clean["order_items"], clean["orders"], clean["customers"])
    assert got.schema.simpleString() == STAR["fact_order_items"].schema.simpleString()
    assert bag(got) == [
        ("o1", 1, "p1", "u1", "s1", "delivered", DAY, D("10.00"), D("1.00"), 3, True),
        ("o1", 2, "p2", "u1", "s1", "delivered", DAY, D("20.00"), D("2.01"), 3, True),
        ("o2", 1, "p1", "u1", "s1", "delivered", DAY, D("5.00"), D("0.50"), None, None),
        ("o3", 1, "p1", "u2", "s2", "delivered", DAY, D("7.00"), D("0.00"), 1, False),
    ]
