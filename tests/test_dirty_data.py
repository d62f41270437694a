"""The load on random dirty raw tables against the same steps in DuckDB SQL."""

import random

import duckdb
import pytest

from helpers import text_frame
from tierline.plans.pipeline import build_clean, build_star
from tierline.schemas import RAW
from tierline_queries import oracle

DUCK_RAW = oracle.RAW_NAMES
NUMBERS = ["", "  ", None, "x", "10", "2.5", "0", "1.005", "7.", "99999999999"]
TIMES = [None, "", "   ", "soon", "2018-02-30 00:00:00", "2018-01-01 00:00:00"]


def dirty(seed):
    rng = random.Random(seed)
    pick = rng.choice

    def key(prefix, n, missing=0.05):
        if rng.random() < missing:
            return pick([None, "", " "])
        # One key in three rows is always the same.
        return f"{prefix}0" if rng.random() < 1 / 3 else f"{prefix}{rng.randrange(n)}"

    def time():
        if rng.random() < 0.2:
            return pick(TIMES)
        return (
            f"2018-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d} "
            f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:{pick(['00', '59'])}"
        )

    def amount():
        if rng.random() < 0.2:
            return pick(NUMBERS)
        return f"{rng.randrange(900)}.{rng.randrange(100):02d}"

    def number():
        if rng.random() < 0.3:
            return pick(["1", "2", "01", "x", "", None, "3.0", "99999999999"])
        return str(rng.randrange(1, 5))

    return {
        "product_category_translation": [
            (key("cat", 6, 0.2), pick(["A", "B", "", None])) for _ in range(15)
        ],
        "products": [
            (key("p", 40), key("cat", 8), "1", "1", pick(["1", "2", "", None, "x"]),
             *[pick(NUMBERS) for _ in range(4)])
            for _ in range(80)
        ],
        "customers": [
            (key("c", 90), key("u", 30), "z", pick([" Rio ", "Rio", "", None]), pick([" rj", "SP ", "xyz", ""]))
            for _ in range(150)
        ],
        "orders": [
            (key("o", 150), key("c", 100), pick(["delivered", "shipped"]), time(), time(), time(),
             time(), time())
            for _ in range(250)
        ],
        "order_items": [
            (key("o", 160), number(), key("p", 45), key("s", 5), "d", amount(), amount())
            for _ in range(900)
        ],
    }


def bag(frame):
    return sorted(
        (tuple((v is not None, str(v)) for v in row) for row in frame), key=lambda row: row
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_load(spark, scratch, seed):
    data = dirty(seed)
    raw = {n: text_frame(spark, RAW[n].names, rows).repartition(3) for n, rows in data.items()}
    root = f"{scratch}/dirty-{seed}"
    clean = build_clean(spark, raw, root)
    exact = build_clean(spark, raw, f"{root}-exact", exact=True)
    gold = build_star(spark, clean, root)

    con = duckdb.connect()
    for name, rows in data.items():
        columns = ", ".join(f"{c} VARCHAR" for c in RAW[name].names)
        con.execute(f"CREATE TABLE {DUCK_RAW[name]} ({columns})")
        con.executemany(
            f"INSERT INTO {DUCK_RAW[name]} VALUES ({', '.join('?' * len(RAW[name]))})", rows
        )
    prefix = "WITH " + oracle.CLEAN_CTES + "," + oracle.STAR_CTES

    ours = {
        "clean_categories": clean["categories"],
        "clean_products": clean["products"],
        "clean_customers": clean["customers"],
        "clean_orders": clean["orders"],
        "clean_items": clean["order_items"],
        "quarantine": clean["quarantine_order_items"],
        "exact_quarantine": exact["quarantine_order_items"],
        **gold,
    }
    for name, df in ours.items():
        columns = ", ".join(df.columns)
        theirs = con.sql(f"{prefix} SELECT {columns} FROM {name}").fetchall()
        assert theirs, name
        assert bag(df.collect()) == bag(theirs), name
    assert len(data["order_items"]) == (
        exact["order_items"].count() + exact["quarantine_order_items"].count()
    )
