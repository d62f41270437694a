"""Loads that publish as their last step, appends by load id, accounting by file."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import bag
from tierline.__main__ import main
from tierline.operators import analysis, quarantine
from tierline.plans import clean_suite, pipeline, raw_suite, register, run, run_checks
from tierline.schemas import CLEAN, IS_MALFORMED, RAW, SOURCE_FILE
from tierline.sources import (
    append_load,
    current_path,
    current_version,
    drop_versions,
    new_version,
    publish,
    read_loads,
    read_table,
    version_path,
    versions,
    write_table,
)

FILES = {
    "product_category_translation": "a_category_name_translation.csv",
    "products": "a_products_dataset.csv",
    "customers": "a_customers_dataset.csv",
    "orders": "a_orders_dataset.csv",
    "order_items": "a_order_items_dataset.csv",
}
ROWS = {
    "product_category_translation": ["toys,Toys"],
    "products": ["p1,toys,1,1,1,10,1,1,1", "p2,toys,1,1,1,10,1,1,1"],
    "customers": ["c1,u1,1,rio,RJ", "c2,u1,1,rio,RJ", "c3,u2,2,\"sao, paulo\",SP"],
    "orders": [f"o{k},c{k},shipped,2020-01-0{k} 10:00:00,,,,2020-02-01 00:00:00" for k in (1, 2, 3)],
    "order_items": ["o1,1,p1,s1,2020-01-05 00:00:00,10.00,1.00", "o2,1,p2,s1,2020-01-05 00:00:00,20.00,1.00"],
}


def write_input(folder, **changed):
    os.makedirs(folder, exist_ok=True)
    for name, lines in {**ROWS, **changed}.items():
        with open(f"{folder}/{FILES[name]}", "w") as out:
            out.write("\n".join([",".join(RAW[name].names), *lines]) + "\n")
    return str(folder)


def revenue(spark, root):
    return pipeline.read_star(spark, root)["fact_order_items"].agg(F.sum("price")).first()[0]


def test_a_load_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    run(spark, write_input(tmp_path / "one"), root)
    before = current_version(spark, root)
    more = [*ROWS["order_items"], "o3,1,p1,s1,2020-01-05 00:00:00,5.00,1.00"]
    second = write_input(tmp_path / "two", order_items=more)
    with monkeypatch.context() as broken:
        broken.setattr(pipeline.star, "fact_from_profiles", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, second, root)
    assert current_version(spark, root) == before and revenue(spark, root) == 30
    assert len(os.listdir(f"{root}/loads")) == 2
    run(spark, second, root)
    assert revenue(spark, root) == 35 and versions(spark, root).count() == 2
    # The stopped load is older than the published one before it, so it stays until the next.
    run(spark, second, root)
    assert before not in os.listdir(f"{root}/loads") and len(os.listdir(f"{root}/loads")) == 2


def test_a_load_that_breaks_constraints_is_not_published(spark, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, write_input(tmp_path / "good"), root, enforce=True, catalog="audit_")
    soon = [ROWS["orders"][0].replace("2020-01-01 10:00:00", "soon"), *ROWS["orders"][1:]]
    with pytest.raises(AssertionError, match="null in required column"):
        run(spark, write_input(tmp_path / "bad", orders=soon), root, enforce=True, catalog="audit_")
    assert revenue(spark, root) == 30 and versions(spark, root).count() == 1
    assert spark.table("audit_gold.fact_order_items").count() == 2
    less = ROWS["order_items"][:1]
    run(spark, write_input(tmp_path / "less", order_items=less), root, enforce=True, catalog="audit_")
    assert spark.table("audit_gold.fact_order_items").count() == 1
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE audit_{layer} CASCADE")


def test_readers_of_an_older_version_can_finish(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = write_input(tmp_path / "one")
    run(spark, first, root)
    held = pipeline.read_star(spark, root)["fact_order_items"]
    run(spark, write_input(tmp_path / "two", order_items=ROWS["order_items"][:1]), root)
    assert held.count() == 2 and pipeline.read_star(spark, root)["fact_order_items"].count() == 1


def test_pointer_and_retention(spark, tmp_path):
    root = f"{tmp_path}/r/"
    assert current_version(spark, root) is None and current_path(spark, root) == root.rstrip("/")
    assert drop_versions(spark, root) == []
    names = [new_version() for _ in range(5)]
    assert names == sorted(names)
    for k, name in enumerate(names):
        write_table(spark.range(k + 1), f"{version_path(root, name)}/gold/t")
        if k != 1:
            publish(spark, root, name)
    assert current_version(spark, root) == names[4]
    assert read_table(spark, f"{current_path(spark, root)}/gold/t").count() == 5
    assert drop_versions(spark, root, keep=2) == names[:3]
    assert sorted(os.listdir(f"{root}loads")) == names[3:]


def test_appending_a_load_twice_adds_it_once(spark, tmp_path):
    path, schema = f"{tmp_path}/t", RAW["product_category_translation"]

    def load(*pairs):
        return spark.createDataFrame(list(pairs), schema)

    append_load(load(("a", "1"), ("b", "2")), path, "2020-01")
    append_load(load(("a", "1")), path, "007")
    append_load(load(("c", "3")), path, "2020-01")
    append_load(load(("c", "3"), ("d", "4")), path, "2020-01")
    append_load(load(), path, "2020-01")
    every = read_loads(spark, path, schema)
    assert sorted(map(tuple, every.collect())) == [("a", "1", "007"), ("c", "3", "2020-01"), ("d", "4", "2020-01")]
    assert read_loads(spark, path, schema, ["007"]).count() == 1


def test_raw_loads_grow_once_per_id(spark, tmp_path, capsys):
    root = f"{tmp_path}/lake"
    january = write_input(tmp_path / "jan")
    february = write_input(tmp_path / "feb", order_items=["o3,1,p1,s1,,5.00,1.00", "o3,2,p1,s1,,5.00,1.00,extra"])
    assert main(["append", january, root, "jan"]) == 0
    for _ in range(2):
        found = pipeline.append_raw(spark, february, root, "feb")["order_items"]
    assert found.groupBy("load_id").count().orderBy("load_id").collect() == [("feb", 2), ("jan", 2)]
    assert found.where(IS_MALFORMED).select("order_item_id", SOURCE_FILE).collect() == [("2", FILES["order_items"])]
    only = pipeline.read_appended(spark, root, loads=["jan"], tables=["orders", "order_items"])
    assert only["orders"].count() == 3 and only["order_items"].count() == 2


def items(seed):
    """Line items of two files with every kind of defect."""
    r, lines = random.Random(seed), []
    for _ in range(300):
        order, product = f"o{r.randint(1, 5)}", f"p{r.randint(1, 3)}"
        price = r.choice(["1.00", "2.50", "3", "", "x", "-1"])
        line = f"{order},{r.randint(1, 6)},{product},s{r.randint(1, 2)},,{price},1.00"
        lines.append(line + r.choice(["", "", "", ",extra"]))
    return lines


@pytest.mark.parametrize("strict, exact", [(True, True), (False, True), (True, False)])
def test_every_row_of_every_file_is_accounted_for(spark, tmp_path, capsys, strict, exact):
    root, folder = f"{tmp_path}/lake", write_input(tmp_path / "in", order_items=items(1))
    with open(f"{folder}/b_order_items_dataset.csv", "w") as out:
        out.write("\n".join([",".join(RAW["order_items"].names), *items(2)]) + "\n")
    run(spark, folder, root, exact=exact, strict=strict)
    want, seen = {}, set()
    rows = [(f"{p}_order_items_dataset.csv", line.split(",")) for p, s in (("a", 1), ("b", 2)) for line in items(s)]
    good = []
    for file, fields in rows:
        count = want.setdefault(file, [0] * 5)
        count[0] += 1
        order, item, product, seller, date, price = fields[:6]
        if strict and len(fields) > 7:
            count[4] += 1
        elif order not in ("o1", "o2", "o3") or product == "p3" or price in ("", "x", "-1"):
            count[2] += 1
        else:
            good.append(((order, item), (product, seller, price, "1.00", date, file)))
    for key, rest in sorted(good):
        want[rest[-1]][3 if key in seen else 1] += 1
        seen.add(key)
    got = pipeline.accounting_by_file(spark, root).collect()
    names = ["raw_rows", "good_rows", "quarantined_rows", "duplicate_rows", "malformed_rows"]
    assert {r.source_file: [r[n] for n in names] for r in got} == want
    assert all(r.unaccounted_rows == 0 for r in got)
    clean = pipeline.read_clean(spark, root)
    assert clean["order_items"].count() == sum(r.good_rows for r in got)
    if exact:
        everything = {**clean, "raw_order_items": pipeline.read_raw(spark, root)["order_items"]}
        found = {r.check_name: r for r in run_checks("silver", everything, clean_suite(exact=True, strict=strict)).collect()}
        assert found["every raw row accounted for"].passed
        if strict:
            assert found[f"rows: {quarantine.MALFORMED_RECORD}"].observed == sum(r.malformed_rows for r in got)
    assert main(["account", root]) == 0 and "b_order_items_dataset.csv" in capsys.readouterr().out
    bronze = run_checks("bronze", pipeline.read_raw(spark, root), raw_suite(malformed=True))
    malformed = bronze.where("check_name = 'malformed records' AND table_name = 'order_items'").first()
    assert malformed.observed == sum(len(f) > 7 for _, f in rows) and not malformed.passed


def test_files_of_equal_rows_keep_one_survivor(spark):
    raw = spark.createDataFrame(
        [("o1", "1", "p1", "s1", "", "1.00", "1.00", f, None) for f in ("b.csv", "a.csv", "b.csv")],
        "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, "
        "price string, freight_value string, _source_file string, _is_malformed boolean",
    )
    orders = spark.createDataFrame([("o1",)], "order_id string")
    products = spark.createDataFrame([("p1",)], "product_id string")
    classified = quarantine.with_slice(quarantine.classify_order_items(raw, orders, products, strict=True), 4)
    ranked = quarantine.rank_accepted(classified)
    got = quarantine.reconcile_by_file(raw, classified, ranked).orderBy("source_file").collect()
    assert [tuple(r) for r in got] == [("a.csv", 1, 1, 0, 0, 0, 0), ("b.csv", 2, 0, 0, 2, 0, 0)]
    assert CLEAN["quarantine_order_items"].schema == quarantine.build_exact_quarantine(classified, ranked).schema


@pytest.mark.parametrize("n", [0, 1, 400])
def test_running_totals_at_row_grain(spark, tmp_path, n):
    r = random.Random(n)
    # A third of the rows share one key; some keys and values are null.
    rows = [
        (i, None if r.random() < 0.05 else 7 if r.random() < 0.33 else r.randint(0, 200), r.choice([None, 1, 2, 5]))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "i int, k int, v long")
    written = iter(range(100))

    def keep(frame):
        path = f"{tmp_path}/k{next(written)}"
        write_table(frame, path)
        return read_table(spark, path, frame.schema)

    found = analysis.running_total(df, "k", "v", keep)
    got = sorted((tuple(x) for x in found.collect()), key=str)

    def before(k, other):
        return other is None or (k is not None and other <= k)

    def total(k):
        parts = [v for _, other, v in rows if before(k, other) and v is not None]
        return sum(parts) if parts else None

    assert got == sorted(((i, k, v, total(k)) for i, k, v in rows), key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_register_names_the_published_version(spark, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, write_input(tmp_path / "one"), root, fact_by_month=True)
    register(spark, root, prefix="month_")
    fact = spark.table("month_gold.fact_order_items")
    assert fact.where("purchase_month = '2020-01'").count() == 2
    assert bag(pipeline.read_star(spark, root)["dim_products"]) == bag(spark.table("month_gold.dim_products"))
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE month_{layer} CASCADE")
