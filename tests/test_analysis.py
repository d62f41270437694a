"""Reports against plain Python over a skewed random star schema."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal as D

import pytest

from helpers import rows
from tierline.operators import analysis as a
from tierline.schemas import STAR


def half_up(total, count, places):
    """Exact ratio rounded half away from zero; total is a Decimal with 2 places."""
    scaled = int(total * 100) * 10**places
    doubled = (2 * abs(scaled) + 100 * count) // (200 * count)
    return D(doubled if scaled >= 0 else -doubled) / 10**places


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    people = [("u0", "c", "S0", 0, D(0), D(0))] + [
        (f"u{i}", "c", rng.choice(["S1", "S2", "S3", None]), rng.randrange(1, 9),
         D(rng.randrange(0, 200_000)) / 100, D(0))
        for i in range(1, 40)
    ]
    products = [(f"p{i}", f"cat{i % 13}", None, None, None, None) for i in range(60)]
    fact = []
    for i in range(900):
        # One person, and one of their orders, hold a third of the rows.
        if i % 3 == 0:
            person, oid = "u0", "o0" if i % 2 else f"o{i}"
        else:
            k = rng.randrange(1, 200)
            person, oid = f"u{k % 39 + 1}", f"x{k}"
        order = random.Random(oid)
        bought = dt.datetime(2017, order.randrange(1, 13), order.randrange(1, 28), 3, 4, 5)
        days = order.choice([None, order.randrange(-2, 30)])
        late = None if days is None else order.random() < 0.4
        product = "p0" if i % 3 == 1 else f"p{rng.randrange(70)}"
        fact.append(
            (oid, i, product, person, "s", "delivered", bought,
             D(rng.randrange(1, 100_000)) / 100, D(1), days, late)
        )
    return fact, people, products


@pytest.fixture(scope="module")
def star(spark, data):
    fact, people, products = data
    frame = lambda name, d: spark.createDataFrame(d, STAR[name].schema)
    return {
        "fact": frame("fact_order_items", fact).repartition(5),
        "people": frame("dim_customers", people),
        "products": frame("dim_products", products),
    }


def test_monthly_and_running(star, data):
    orders, revenue = defaultdict(set), defaultdict(D)
    for f in data[0]:
        month = f[6].strftime("%Y-%m")
        orders[month].add(f[0])
        revenue[month] += f[7]
    wanted = [
        (m, len(orders[m]), revenue[m], half_up(revenue[m], len(orders[m]), 2))
        for m in sorted(revenue)
    ]
    assert rows(a.monthly_trend(star["fact"])) == wanted
    total, running = D(0), []
    for m in sorted(revenue):
        total += revenue[m]
        running.append((m, revenue[m], total))
    assert rows(a.running_revenue(star["fact"])) == running
    assert running[-1][2] == sum(f[7] for f in data[0])


def test_spend_segments(star, data):
    groups = defaultdict(list)
    for p in data[1]:
        tier = "High Value" if p[4] >= 1000 else "Mid Value" if p[4] >= 300 else "Low Value"
        groups[tier].append(p)
    wanted = [
        (t, len(g), half_up(sum(p[4] for p in g), len(g), 2),
         half_up(D(sum(p[3] for p in g)), len(g), 2))
        for t, g in groups.items()
    ]
    wanted.sort(key=lambda r: (-r[2], r[0]))
    assert rows(a.spend_segments(star["people"])) == wanted
    assert rows(a.spend_segments(star["people"], ()))[0][:2] == ("Low Value", len(data[1]))


def test_tier_starts_at_its_threshold(spark):
    df = spark.createDataFrame(
        [("a", D("1000.00"), 1), ("b", D("999.99"), 1), ("c", D("300.00"), 1),
         ("d", D("299.99"), 1), ("e", None, 1)],
        "customer_unique_id string, total_spent decimal(20,2), total_orders long",
    )
    got = {r[0]: r[1:] for r in rows(a.spend_segments(df))}
    assert got["High Value"] == (1, D("1000.00"), D("1.00"))
    assert got["Mid Value"] == (2, D("650.00"), D("1.00"))
    # Nothing spent on record falls to the lowest tier and out of the average.
    assert got["Low Value"] == (2, D("299.99"), D("1.00"))


def test_ranges(star, data):
    fact = data[0]
    assert rows(a.purchase_range(star["fact"])) == [(min(f[6] for f in fact), max(f[6] for f in fact))]
    prices = [f[7] for f in fact]
    assert rows(a.price_range(star["fact"])) == [
        (min(prices), max(prices), half_up(sum(prices), len(prices), 2))
    ]
    days = [f[9] for f in fact if f[9] is not None]
    assert rows(a.delivery_range(star["fact"])) == [(min(days), max(days))]


def test_ranges_of_nothing(star):
    empty = star["fact"].filter("order_id IS NULL")
    assert rows(a.price_range(empty)) == [(None, None, None)]
    assert rows(a.delivery_range(empty)) == [(None, None)]
    assert rows(a.monthly_trend(empty)) == []


def test_lists(star):
    states = [r[0] for r in rows(a.state_list(star["people"]))]
    assert states == [None, "S0", "S1", "S2", "S3"]
    categories = [r[0] for r in rows(a.category_list(star["products"]))]
    assert categories == sorted({f"cat{i}" for i in range(13)})


def by_state(data):
    state = {p[0]: p[2] for p in data[1]}
    groups = defaultdict(list)
    for f in data[0]:
        if f[3] in state:
            groups[state[f[3]]].append(f)
    return groups


def descending(found):
    return sorted(found, key=lambda r: (-r[-1], r[0] is not None, r[0] or ""))


def test_revenue_by_state(star, data):
    wanted = [
        (s, len({f[0] for f in g}), sum(f[7] for f in g)) for s, g in by_state(data).items()
    ]
    assert rows(a.revenue_by_state(star["fact"], star["people"])) == descending(wanted)


def test_delivery_performance(star, data):
    lines, per_order = [], []
    for s, g in by_state(data).items():
        g = [f for f in g if f[9] is not None]
        if not g:
            continue
        orders = {f[0]: f for f in g}
        n = len(orders)
        lines.append(
            (s, n, half_up(D(sum(f[9] for f in g)), len(g), 1),
             half_up(D(100 * sum(f[10] for f in g)), n, 2))
        )
        once = orders.values()
        per_order.append(
            (s, n, half_up(D(sum(f[9] for f in once)), n, 1),
             half_up(D(100 * sum(f[10] for f in once)), n, 2))
        )
    fact, people = star["fact"], star["people"]
    assert rows(a.delivery_performance(fact, people)) == descending(lines)
    assert rows(a.delivery_performance_by_order(fact, people)) == descending(per_order)
    assert all(r[3] <= 100 for r in per_order)


def test_top_products_and_categories(star, data):
    category = {p[0]: p[1] for p in data[2]}
    revenue, units = defaultdict(D), defaultdict(int)
    cat_revenue, cat_orders = defaultdict(D), defaultdict(set)
    for f in data[0]:
        if f[2] in category:
            revenue[f[2]] += f[7]
            units[f[2]] += 1
            cat_revenue[category[f[2]]] += f[7]
            cat_orders[category[f[2]]].add(f[0])
    wanted = sorted(
        ((p, category[p], revenue[p], units[p]) for p in revenue), key=lambda r: (-r[2], r[0])
    )
    assert rows(a.top_products(star["fact"], star["products"])) == wanted[:10]
    cats = sorted(
        ((c, cat_revenue[c], len(cat_orders[c])) for c in cat_revenue), key=lambda r: (-r[1], r[0])
    )
    assert rows(a.top_categories(star["fact"], star["products"])) == cats[:10]
    assert rows(a.top_categories(star["fact"], star["products"], n=3)) == cats[:3]


def test_top_products_ties_go_to_the_smaller_id(spark):
    fact = spark.createDataFrame(
        [(f"p{i:02d}", D("5.00"), "o") for i in range(20)],
        "product_id string, price decimal(10,2), order_id string",
    )
    dim = fact.selectExpr("product_id", "'c' AS category_english")
    got = [r[0] for r in rows(a.top_products(fact, dim))]
    assert got == [f"p{i:02d}" for i in range(10)]
