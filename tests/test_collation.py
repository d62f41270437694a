"""Keys that differ in case and accents, from raw tables to the star, by hand."""

import pytest
from pyspark.sql import functions as F

from tierline.functions.collation import _images
from tierline.operators import cleaning, quality, quarantine, star
from tierline.operators.matching import compared
from tierline.plans import build_clean, build_star, run_checks
from tierline.plans.suites import constraint_checks
from tierline.schemas import CLEAN, RAW, STAR, collated, collated_columns, plain

CI_AI = "UNICODE_CI_AI"
TIMES = ["2020-01-01 10:00:00", "", "", "", "2020-02-01 00:00:00"]
ROWS = {
    # Two spellings of one name: the translation that comes first stays, with its own spelling.
    "product_category_translation": [("Café", "Coffee"), ("CAFE", "Beans"), ("toys", "Toys")],
    # p1 and P1 are one product; its category is found in a third spelling.
    "products": [
        ("p1", "cafÉ", "", "", "1", "10", "1", "1", "1"),
        ("P1", "cafÉ", "", "", "2", "10", "1", "1", "1"),
        ("p2", "Toys", "", "", "1", "20", "1", "1", "1"),
        ("p3", "tools", "", "", "1", "20", "1", "1", "1"),
    ],
    "customers": [
        ("c1", "u1", "1", " Rio ", "rj"),
        ("C1", "u1", "1", " São Paulo ", "rj"),
        ("c2", "U1", "1", " RIO ", "rj"),
        ("c3", "ü2", "1", " Sao Paulo ", "sp"),
    ],
    "orders": [
        ("o1", "C1", "shipped", *TIMES),
        ("O1", "c1", "shipped", *TIMES),
        ("o2", "C2", "shipped", *TIMES),
        ("o3", "c9", "shipped", *TIMES),
    ],
    "order_items": [
        ("O1", "1", "P1", "s1", "", "10.00", "1.00"),
        ("o1", "1", "p1", "s1", "", "10.00", "1.00"),
        ("o2", "1", "P2", "s1", "", "20.00", "2.00"),
        ("O3", "1", "p1", "s1", "", "5.00", "1.00"),
        ("o1", "2", "p3", "s1", "", "5.00", "1.00"),
        ("o1", "3", "P1", "s1", "", "x", "1.00"),
    ],
}


@pytest.fixture(scope="module")
def raw(spark):
    return {name: spark.createDataFrame(rows, RAW[name]) for name, rows in ROWS.items()}


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("exact", [False, True])
def test_keys_meet_under_a_collation(spark, raw, scratch, exact):
    root = f"{scratch}/collated{exact}"
    clean = build_clean(spark, raw, root, exact=exact, collation=CI_AI)
    for name, df in clean.items():
        assert df.schema == CLEAN[name].schema
    assert rows(clean["categories"], "product_category_name", "product_category_name_english") == [
        ("CAFE", "Beans"),
        ("toys", "Toys"),
    ]
    # Of equal payloads the smaller one stays: photos_qty 1, whatever the id's spelling.
    assert rows(clean["products"], "product_id", "product_category_name", "photos_qty") == [
        ("p1", "cafÉ", 1),
        ("p2", "Toys", 1),
    ]
    assert rows(clean["customers"], F.lower("customer_id"), "customer_unique_id", "city") == [
        ("c1", "u1", "Rio"),
        ("c2", "U1", "RIO"),
        ("c3", "ü2", "Sao Paulo"),
    ]
    # O1 and o1 are one order; their rows differ in the customer's spelling only, so bytes decide.
    assert rows(clean["orders"], "order_id", "customer_id") == [("o1", "C1"), ("o2", "C2")]
    assert rows(clean["order_items"], "order_id", "order_item_id", "product_id") == [
        ("O1", 1, "P1"),
        ("o2", 1, "P2"),
    ]
    reasons = [
        ("O3", quarantine.ORDER_NOT_FOUND),
        ("o1", quarantine.NOT_NUMERIC),
        ("o1", quarantine.PRODUCT_NOT_FOUND),
    ]
    reasons += [("o1", quarantine.DUPLICATE_ITEM)] * exact
    assert rows(clean["quarantine_order_items"], "order_id", "rejection_reason") == sorted(reasons)

    gold = build_star(spark, clean, root, collation=CI_AI)
    for name, df in gold.items():
        assert df.schema == STAR[name].schema
    assert rows(gold["dim_products"], "product_id", "category_english") == [("p1", "Beans"), ("p2", "Toys")]
    # u1 and U1 are one person; the least spelling is stored, and the greatest city.
    assert rows(gold["dim_customers"], "customer_unique_id", "city", "total_orders", F.col("total_spent").cast("int")) == [
        ("U1", "Rio", 2, 33)
    ]
    assert rows(gold["fact_order_items"], "order_id", "customer_unique_id", F.col("price").cast("int")) == [
        ("O1", "u1", 10),
        ("o2", "U1", 20),
    ]
    for layer, tables, declared in (("silver", clean, CLEAN), ("gold", gold, STAR)):
        checks = constraint_checks(declared)
        seen = {n: collated(df, CI_AI) for n, df in tables.items()}
        assert run_checks(layer, seen, checks).where("NOT passed").count() == 0
        # Byte by byte the same tables hold orphans.
        assert run_checks(layer, tables, checks).where("NOT passed").count() > 0


def test_without_a_collation_spellings_differ(spark, raw, scratch):
    clean = build_clean(spark, raw, f"{scratch}/plain")
    assert clean["categories"].count() == 3 and clean["orders"].count() == 2
    assert clean["products"].count() == 0


def test_key_reports_follow_the_collation(spark, raw):
    items = collated(raw["order_items"], CI_AI)
    assert [r.n for r in quality.duplicate_keys(items, ["order_id", "order_item_id"]).collect()] == [2]
    assert quality.duplicate_keys(raw["order_items"], ["order_id", "order_item_id"]).count() == 0
    lost = quality.orphans(collated(raw["orders"], CI_AI), collated(raw["customers"], CI_AI), "customer_id")
    assert [r.customer_id for r in lost.collect()] == ["c9"]
    assert collated_columns(items) == ["order_id", "product_id"]
    assert plain(items).schema == raw["order_items"].schema and collated(items, None) is items
    assert star.build_dim_products(items.select("product_id").limit(0).crossJoin(
        collated(spark.createDataFrame([], CLEAN["products"].schema).drop("product_id"), CI_AI)
    ), collated(spark.createDataFrame([], CLEAN["categories"].schema), CI_AI)).schema == STAR["dim_products"].schema


ODD = ["", " ", "O12", "o12", "ó12", "O1 2", "o1 2 ", "straße", "STRASSE", "a-b", "a_b", "A_B", "a--b", "A_-b ", "_", "-", "a\u2010b", "x\n", "x", "\x00x", "Ａ1", "ﬁ", "FI", "ab", "Ab", "æ", "AE", "b", "9", "10", "中", "é", "E", None]


@pytest.mark.parametrize("collation", ["UNICODE_CI_AI", "UNICODE_CI", "UNICODE_AI", "UTF8_LCASE", "UNICODE_CI_AI_RTRIM"])
def test_sort_keys_compare_as_the_collation_does(spark, collation):
    made = [f"{a}{b}{c}" for a in "oO0 " for b in "zé-_7" for c in "A1 -ß"]
    texts = collated(spark.createDataFrame([(t,) for t in [*ODD, *made]], "order_id string"), collation)
    keyed = texts.select("order_id", compared(texts, "order_id").alias("key"))
    other = keyed.toDF("other", "other_key")
    own, key = F.col("order_id"), F.col("key")
    wrong = keyed.join(other, own.eqNullSafe(F.col("other")) != key.eqNullSafe(F.col("other_key")))
    wrong = wrong.unionByName(keyed.join(other, (own < F.col("other")) != (key < F.col("other_key"))))
    assert wrong.collect() == []


def test_plain_keys_need_no_collator(spark):
    assert {c: bool(_images(spark, c)) for c in ("UNICODE_CI_AI", "UTF8_LCASE", "UNICODE_CI", "UNICODE")} == {
        "UNICODE_CI_AI": True,
        "UTF8_LCASE": True,
        "UNICODE_CI": False,
        "UNICODE": False,
    }


def compared_types(node):
    """Types of what a plan joins, sorts and groups by."""

    def each(found):
        return [found.apply(i) for i in range(found.size())]

    kind, own = node.nodeName(), []
    if kind in ("Window", "WindowGroupLimit"):
        own = [*each(node.partitionSpec()), *each(node.orderSpec())]
    elif kind == "Aggregate":
        own = each(node.groupingExpressions())
    elif kind == "Join":
        own = each(node.condition().get().references().toSeq())
    return [e.dataType().sql() for e in own] + [t for child in each(node.children()) for t in compared_types(child)]


def test_nothing_is_joined_sorted_or_grouped_by_collated_text(spark, raw):
    clean = {n: collated(spark.createDataFrame([], t.schema), CI_AI) for n, t in CLEAN.items()}
    source = {n: collated(df, CI_AI) for n, df in raw.items()}
    orders = collated(raw["orders"].select("order_id", F.lit("u1").alias("customer_unique_id"), "order_status"), CI_AI)
    profiles = orders.withColumns({"city": F.lit("x"), "state": F.lit("y")})
    classified = quarantine.classify_order_items(source["order_items"], source["orders"], source["products"])
    items = source["order_items"].withColumn("price", F.lit(1)).withColumn("freight_value", F.lit(1))
    for df in (
        cleaning.build_products(source["products"], source["product_category_translation"]),
        cleaning.build_customers(source["customers"]),
        cleaning.build_orders(source["orders"], source["customers"]),
        classified,
        quarantine.build_order_items(classified),
        star.build_order_profiles(cleaning.build_orders(source["orders"], source["customers"]), cleaning.build_customers(source["customers"])),
        star.people_from_profiles(profiles, items),
    ):
        kinds = compared_types(df._jdf.queryExecution().optimizedPlan())
        assert "BINARY" in kinds and not [k for k in kinds if "COLLATE" in k]
