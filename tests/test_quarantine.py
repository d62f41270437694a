import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import bag, final_plan, plan, rows, text_frame
from tierline.operators import quarantine as q
from tierline.schemas import CLEAN, RAW

NAMES = RAW["order_items"].names


@pytest.fixture(scope="module")
def refs(spark):
    orders = text_frame(spark, ["order_id"], [("o1",), ("o2",), ("",)])
    products = text_frame(spark, ["product_id"], [("p1",), ("p2",)])
    return orders, products


def item(order="o1", number="1", product="p1", price="1.00", freight="2.00", seller="s", limit="d"):
    return (order, number, product, seller, limit, price, freight)


def reasons(spark, refs, items):
    got = q.classify_order_items(text_frame(spark, NAMES, items), *refs)
    return Counter(r[q.REASON] for r in got.collect())


def test_reason_priority_and_three_valued_traps(spark, refs):
    o, p, n = q.ORDER_NOT_FOUND, q.PRODUCT_NOT_FOUND, q.NOT_NUMERIC
    cases = [
        (item(), None),
        (item(order="zz", product="zz", price="x"), o),
        (item(product="zz", price="x"), p),
        (item(price="x"), n),
        (item(order=None), o),
        (item(product=None), p),
        (item(price=None), n),
        (item(number=None), n),
        (item(price=""), n),
        (item(price="."), n),
        (item(price=".5"), n),
        (item(price="-1"), n),
        (item(price="1e3"), n),
        (item(freight="1,5"), n),
        (item(number="1.0"), n),
        # Right shape, too large for its column.
        (item(number="99999999999"), n),
        (item(price="999999999999"), n),
        (item(price="12.5\r"), None),
        # Blank keys are values and match blank keys.
        (item(order=""), None),
    ]
    for row, wanted in cases:
        assert reasons(spark, refs, [row]) == {wanted: 1}, row
    every = reasons(spark, refs, [row for row, _ in cases])
    assert every == Counter(wanted for _, wanted in cases)


def test_repeated_reference_keys_add_no_rows(spark):
    df = text_frame(spark, ["k"], [("a",), ("b",), (None,)])
    parent = text_frame(spark, ["k"], [("a",), ("a",), ("a",), (None,), (None,)])
    got = q.classify(df, [q.Reference(parent, "k", "missing", unique=False)], [])
    assert bag(got) == [(None, "missing"), ("a", None), ("b", "missing")]


def test_items_are_typed_and_unique(spark, refs):
    classified = q.classify_order_items(
        text_frame(
            spark,
            NAMES,
            [
                item(product="p2"),
                item(product="p1", price="7"),
                item(number="01", product="p1", price="5"),
                item(number="2"),
                item(order="zz"),
            ],
        ),
        *refs,
    )
    got = q.build_order_items(classified)
    assert got.schema.simpleString() == CLEAN["order_items"].schema.simpleString()
    # '01' and '1' are the same item number.
    assert bag(got) == [
        ("o1", 1, "p1", "s", Decimal("5.00"), Decimal("2.00")),
        ("o1", 2, "p1", "s", Decimal("1.00"), Decimal("2.00")),
    ]
    bad = q.build_quarantine(classified)
    assert bag(bad) == [("zz", "1", "p1", "s", "1.00", "2.00", q.ORDER_NOT_FOUND)]


def skewed_items(n=6000):
    """A third of the rows share one key, and a third of those are exact copies."""
    rng = random.Random(7)
    items = []
    for i in range(n):
        if i % 9 == 0:
            items.append(item(number="1", price="3"))
        elif i % 3 == 0:
            items.append(item(number="1", price=str(rng.randrange(1, 500))))
        elif i % 10 == 1:
            items.append(item(order="zz", number=str(i)))
        else:
            items.append(item(order="o2", number=str(rng.randrange(0, 2500)), price=str(i % 50 + 1)))
    rng.shuffle(items)
    return items


@pytest.mark.parametrize("slices", [1, 3, 64, q.SLICES])
def test_exact_split_accounts_for_every_row(spark, refs, scratch, slices):
    items = skewed_items()
    raw = text_frame(spark, NAMES, items).repartition(7)
    path = f"{scratch}/classified-{slices}"
    q.with_slice(q.classify_order_items(raw, *refs), slices).write.mode("overwrite").parquet(path)
    classified = spark.read.parquet(path)

    good = bag(q.build_order_items(classified))
    quarantined = Counter(rows(q.build_exact_quarantine(classified)))

    # Brute force: first row of each key in text order stays, the rest is left over.
    groups, wanted = defaultdict(list), Counter()
    for o, number, p, s, limit, price, freight in items:
        if o == "zz":
            wanted[o, number, p, s, price, freight, q.ORDER_NOT_FOUND] += 1
        else:
            groups[o, int(number)].append((number, p, s, price, freight, limit))
    for (o, _), members in groups.items():
        for number, p, s, price, freight, _ in sorted(members)[1:]:
            wanted[o, number, p, s, price, freight, q.DUPLICATE_ITEM] += 1
    assert quarantined == wanted
    assert len(good) == len(groups)
    assert len(good) + sum(quarantined.values()) == len(items)

    q.rank_accepted(classified).write.parquet(f"{path}-ranked")
    ranked = spark.read.parquet(f"{path}-ranked")
    assert bag(q.first_items(ranked)) == good
    assert Counter(rows(q.build_exact_quarantine(classified, ranked))) == wanted

    row = q.reconcile(raw, q.build_order_items(classified), q.build_exact_quarantine(classified))
    assert rows(row) == [(len(good), len(items) - len(good), len(items), len(items), 0)]


def test_hot_key_is_ranked_in_slices(spark):
    """No ranking task sees more of a hot key than its slice and the slice winners."""
    df = q.with_slice(spark.range(40_000).selectExpr("concat('hot', id DIV 40000) AS k", "id % 100 AS v"), 50)
    sizes = df.groupBy("k", q.SLICE).count().agg({"count": "max"}).first()[0]
    assert sizes < 3 * 40_000 / 50
    marked = q.mark_duplicates(df, ["k"], ["v"])
    assert marked.filter("NOT is_duplicate").count() == 1
    assert marked.filter("NOT is_duplicate").first().v == 0
    assert marked.count() == 40_000


def test_default_split_leaves_duplicates_out(spark, refs):
    raw = text_frame(spark, NAMES, [item(), item(), item(order="zz")])
    classified = q.classify_order_items(raw, *refs)
    row = q.reconcile(raw, q.build_order_items(classified), q.build_quarantine(classified))
    assert rows(row) == [(1, 1, 2, 3, 1)]


def test_classify_splits_a_hot_reference_key(spark, settings):
    """Adaptive execution splits the hot side of the join, with equal results."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
    )
    facts = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 5000) END AS k",
        "uuid() AS payload",
    )
    keys = spark.range(2500).selectExpr("concat('k', id) AS k").union(
        spark.createDataFrame([("hot",)], "k string")
    )
    got = q.classify(facts, [q.Reference(keys, "k", "no key")], [])
    assert "skew=true" in final_plan(got)
    counts = dict(got.groupBy(q.REASON).count().collect())
    missing = sum(1 for i in range(60_000) if i % 3 and i % 5000 >= 2500)
    assert counts == {"no key": missing, None: 60_000 - missing}


@pytest.mark.parametrize("whole_rows", [10, 100, 100_000])
def test_counted_ranking_shuffles_rows_once_but_for_hot_keys(spark, scratch, whole_rows):
    """A null key, repeated keys and one that holds a third of the rows."""
    path = f"{scratch}/counted-{whole_rows}"
    keys = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 != 1, F.col("id").cast("string").substr(1, 3))
    rows_ = spark.range(3_000).select(keys.alias("k"), (F.col("id") % 4).alias("v"))
    q.with_slice(rows_).write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    marked = q.mark_duplicates_counted(df, ["k"], ["v"], whole_rows=whole_rows)
    assert marked.columns == [*df.columns, q.DUPLICATE]
    assert bag(marked.drop(q.SLICE)) == bag(q.mark_duplicates(df, ["k"], ["v"]).drop(q.SLICE))
    assert marked.filter(~F.col(q.DUPLICATE)).count() == df.select("k").distinct().count()
    evenly = df.filter("k != 'hot'")
    once = plan(q.mark_duplicates_counted(evenly, ["k"], ["v"], whole_rows=100))
    assert once.count("Exchange hashpartitioning") == 1
