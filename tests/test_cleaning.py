import datetime as dt
from decimal import Decimal

from helpers import bag, final_plan, rows, text_frame
from tierline.operators import cleaning
from tierline.schemas import CLEAN, RAW


def raw(spark, table, data):
    return text_frame(spark, RAW[table].names, data)


def categories(spark, *names):
    return text_frame(spark, CLEAN["categories"].schema.names, [(n, "en " + n) for n in names])


def test_dedup_first_is_deterministic(spark):
    df = text_frame(
        spark, ["k", "p"], [("a", "2"), ("a", "1"), ("a", None), ("b", "x"), (None, "n"), (None, "m")]
    )
    wanted = [("a", None), ("b", "x"), (None, "m")]
    for partitions in (1, 3):
        got = cleaning.dedup_first(df.repartition(partitions), ["k"], ["p"])
        assert bag(got) == bag(spark.createDataFrame(wanted, "k string, p string"))


def test_dedup_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(9_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id AS string)) AS k", "cast(id AS string) AS p"
    )
    got = cleaning.dedup_first(df, ["k"], ["p"])
    assert final_plan(got).count("WindowGroupLimit") == 2  # before and after the exchange
    assert got.count() == 6001
    assert rows(got.filter("k = 'hot'")) == [("hot", "0")]


def test_keep_referenced_null_blank_and_collation(spark):
    df = text_frame(spark, ["k"], [("a",), ("A",), ("",), (None,), ("z",)])
    parent = text_frame(spark, ["k"], [("a",), ("",), ("",), (None,)])
    # Blank keys match each other, NULL keys nothing; a repeated parent key adds no rows.
    assert bag(cleaning.keep_referenced(df, parent, "k")) == [("",), ("a",)]
    relaxed = cleaning.keep_referenced(df, parent, "k", collation="UNICODE_CI_AI")
    assert bag(relaxed) == [("",), ("A",), ("a",)]


def test_categories_one_row_per_name(spark):
    got = cleaning.build_categories(
        raw(
            spark,
            "product_category_translation",
            [("a", "y"), ("a", "x"), ("a", "x"), ("a", " "), ("a", None), ("", "blank"),
             ("  ", "b"), (None, "n"), ("z", "")],
        )
    )
    assert bag(got) == [("a", "x"), ("z", "")]


def test_products(spark):
    got = cleaning.build_products(
        raw(
            spark,
            "products",
            [
                ("p1", "toys", "1", "1", "3.0", "100", "1.005", "", "x"),
                ("p2", "toys", "1", "1", "2", "9", "1", "1", "1"),
                ("p2", "toys", "1", "1", "1", "9", "1", "1", "1"),
                ("p3", "", "1", "1", "1", "1", "1", "1", "1"),
                ("p4", "unknown", "1", "1", "1", "1", "1", "1", "1"),
                ("p5", None, "1", "1", "1", "1", "1", "1", "1"),
            ],
        ),
        categories(spark, "toys"),
    )
    assert got.schema.simpleString() == CLEAN["products"].schema.simpleString()
    one = Decimal("1.00")
    assert bag(got) == [
        ("p1", "toys", 3, Decimal("100.00"), Decimal("1.01"), None, None),
        ("p2", "toys", 1, Decimal("9.00"), one, one, one),
    ]


def test_customers(spark):
    data = [
        ("c1", "u1", "0123", " Rio ", " rj "),
        ("c1", "u1", "0123", " Zed ", " rj "),
        (None, "u2", "1", "a", "b"),
        ("c3", None, "1", "a", "b"),
        ("", "u4", "1", "a", "b"),
    ]
    got = cleaning.build_customers(raw(spark, "customers", data))
    assert bag(got) == [("", "u4", "1", "a", "B"), ("c1", "u1", "0123", "Rio", "RJ")]
    strict = cleaning.build_customers(raw(spark, "customers", data), drop_blank_keys=True)
    assert bag(strict) == [("c1", "u1", "0123", "Rio", "RJ")]


def order(oid, bought, delivered, promised, customer="c1", status="delivered"):
    return (oid, customer, status, bought, "", "  ", delivered, promised)


def test_orders(spark):
    customers = text_frame(spark, CLEAN["customers"].schema.names, [("c1", "u", "z", "c", "s")])
    midnight = "2018-01-10 00:00:00"
    got = cleaning.build_orders(
        raw(
            spark,
            "orders",
            [
                # One second of elapsed time across midnight is one calendar day.
                order("o1", "2018-01-01 23:59:59", "2018-01-02 00:00:01", midnight),
                # During the promised day counts as late; at its midnight does not.
                order("o2", "2018-01-01 00:00:00", "2018-01-10 08:00:00", midnight),
                order("o3", "2018-01-01 00:00:00", midnight, midnight),
                order("o4", "2018-01-01 00:00:00", "   ", midnight, status="shipped"),
                order("o5", "2018-01-01 00:00:00", None, midnight, status="shipped"),
                # Delivered, but the date makes no sense.
                order("o6", "2018-01-01 00:00:00", "soon", midnight),
                order("o7", "2018-01-05 00:00:00", "2018-01-03 00:00:00", midnight),
                order("o8", "2018-01-01 00:00:00", midnight, midnight, customer="nobody"),
                order("o9", "2018-01-01 00:00:00", midnight, midnight, customer=None),
            ],
        ),
        customers,
    )
    assert got.schema.simpleString() == CLEAN["orders"].schema.simpleString()
    short = got.select("order_id", "delivery_days", "is_delivered", "is_delayed")
    assert bag(short) == [
        ("o1", 1, True, False),
        ("o2", 9, True, True),
        ("o3", 9, True, False),
        ("o4", None, False, None),
        ("o5", None, False, None),
        ("o6", None, True, None),
        ("o7", -2, True, False),
    ]
    first = got.filter("order_id = 'o1'").first()
    assert first.approved_ts is None and first.delivered_carrier_ts is None
    assert first.purchase_ts == dt.datetime(2018, 1, 1, 23, 59, 59)
    assert first.estimated_delivery_date == dt.date(2018, 1, 10)
