"""CSV files to star tables, compared with the layers the queries use."""

import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tierline_queries.layers import layers, write_csv
from helpers import bag
from tierline.__main__ import main
from tierline.plans import assert_checks, clean_suite, register, run, run_checks, star_suite
from tierline.plans.pipeline import (
    build_star,
    count_malformed,
    read_accepted,
    read_clean,
    read_raw,
    read_star,
)
from tierline.plans.reports import REPORTS
from tierline.schemas import CLEAN, RAW, STAR
from tierline.session import RUNTIME_SETTINGS, sized, sizing_for
from tierline.sources import count_tables, create_layers, ingest_raw, list_layer, malformed_lines

PREFIXES = {
    "product_category_translation": "product_category_name_translation",
    "products": "shop_products_dataset",
    "customers": "shop_customers_dataset",
    "orders": "shop_orders_dataset",
    "order_items": "shop_order_items_dataset",
}


@pytest.fixture(scope="module")
def expected(spark, sf_dir):
    return layers(spark, sf_dir)


@pytest.fixture(scope="module")
def loaded(spark, expected, scratch):
    """All three layers from CSV files made of the mapped raw tables."""
    inputs, root = f"{scratch}/inputs", f"{scratch}/lake"
    for name, prefix in PREFIXES.items():
        write_csv(expected.raw(name), f"{inputs}/{prefix}.csv")
    run(spark, inputs, root)
    return inputs, root


def test_layers_match(spark, loaded, expected):
    _, root = loaded
    raw, clean, star = read_raw(spark, root), read_clean(spark, root), read_star(spark, root)
    for name in RAW:
        assert bag(raw[name].select(*RAW[name].names)) == bag(expected.raw(name)), name
        assert raw[name].filter("_ingested_at IS NULL OR _source_file = ''").count() == 0
    for name, table in CLEAN.items():
        assert bag(clean[name]) == bag(expected.clean(name)), name
        assert clean[name].schema == table.schema
    for name, table in STAR.items():
        assert bag(star[name]) == bag(expected.star(name)), name


def test_second_run_replaces_the_first(spark, loaded):
    inputs, root = loaded
    before = {n: df.count() for n, df in read_clean(spark, root).items()}
    again = run(spark, inputs, root)
    assert {n: df.count() for n, df in again["silver"].items()} == before
    assert again["gold"]["fact_order_items"].count() == before["order_items"]


def test_exact_run_accounts_for_every_row(spark, loaded, scratch):
    inputs, _ = loaded
    tables = run(spark, inputs, f"{scratch}/exact", exact=True)
    clean, raw_items = tables["silver"], tables["bronze"]["order_items"]
    everything = {**clean, "raw_order_items": raw_items}
    found = run_checks("silver", everything, clean_suite(exact=True))
    good = clean["order_items"].count()
    bad = clean["quarantine_order_items"].count()
    assert good + bad == raw_items.count()
    # Only the defects put into the raw tables on purpose remain.
    failed = {(r.table_name, r.check_name) for r in found.filter("NOT passed").collect()}
    assert failed == {("customers", "state code length"), ("orders", "negative delivery days")}
    star = {**tables["gold"], "order_items": clean["order_items"]}
    assert_checks(run_checks("gold", star, star_suite()))


def test_enforced_run_stops_at_a_missing_required_value(spark, loaded, expected, scratch):
    inputs, _ = loaded
    assert run(spark, inputs, f"{scratch}/enforced", enforce=True)["gold"]
    broken, root = f"{scratch}/broken", f"{scratch}/broken_lake"
    for name, prefix in PREFIXES.items():
        df = expected.raw(name)
        if name == "orders":
            time = "order_purchase_timestamp"
            least = df.agg(F.min("order_id")).first()[0]
            df = df.withColumn(time, F.when(df.order_id == least, "soon").otherwise(df[time]))
        write_csv(df, f"{broken}/{prefix}.csv")
    with pytest.raises(AssertionError, match="silver.orders null in required column: 1, expected 0"):
        run(spark, broken, root, enforce=True)
    assert not os.path.exists(f"{root}/gold")


def test_one_lost_row_fails_the_suite(spark, loaded):
    """Rows left out as duplicates are counted, so a row that is just gone shows."""
    _, root = loaded
    raw, clean = read_raw(spark, root)["order_items"], read_clean(spark, root)
    tables = {**clean, "raw_order_items": raw, "accepted_order_items": read_accepted(spark, root)}

    def accounted(tables):
        found = run_checks("silver", tables, clean_suite({"order_items": raw.count()}))
        by_name = {r.check_name: r for r in found.collect()}
        return by_name["every raw row accounted for"], by_name["left out as duplicates"].observed

    line, duplicates = accounted(tables)
    assert line.passed and duplicates > 0
    lost = clean["order_items"].first()
    short = clean["order_items"].filter(
        f"order_id <> '{lost.order_id}' OR order_item_id <> {lost.order_item_id}"
    )
    line, _ = accounted({**tables, "order_items": short})
    assert not line.passed and line.observed == line.expected - 1


def test_line_breaks_and_malformed_records(spark, scratch):
    folder = f"{scratch}/breaks"
    os.makedirs(folder)
    header = ",".join(RAW["customers"].names)
    with open(f"{folder}/one.csv", "wb") as out:
        out.write(
            b"\xef\xbb\xbf" + header.encode() + b'\r\nc1,u1,1,"sao,\npaulo",SP\r\nc2,u2,2,rio,RJ,extra\r\n'
        )
    with open(f"{folder}/two.csv", "w") as out:
        out.write(header + "\nc3,u3,3,rio,RJ\nc4,u4\n")
    schema = RAW["customers"]
    back = ingest_raw(spark, folder, schema, multi_line=True)
    found = {tuple(r) for r in back.select("customer_id", "customer_city", "_source_file").collect()}
    assert found == {
        ("c1", "sao,\npaulo", "one.csv"),
        ("c2", "rio", "one.csv"),
        ("c3", "rio", "two.csv"),
        ("c4", "", "two.csv"),
    }
    counts = malformed_lines(spark, folder, schema, multi_line=True)
    assert bag(counts) == bag(
        spark.createDataFrame([("one.csv", 2, 1), ("two.csv", 2, 1)], counts.schema)
    )


def test_run_keeps_line_breaks_and_counts_malformed(spark, loaded, scratch):
    inputs, _ = loaded
    per_table = count_malformed(spark, inputs).groupBy("table_name").sum("malformed_lines")
    assert dict(per_table.collect()) == {name: 0 for name in RAW}


def test_no_checks_no_rows(spark, loaded):
    some = run_checks("gold", read_star(spark, loaded[1]), star_suite()[:1])
    none = run_checks("gold", {}, [])
    assert none.count() == 0
    assert [(f.name, f.dataType) for f in none.schema] == [(f.name, f.dataType) for f in some.schema]


def test_settings_come_back(spark, loaded):
    _, root = loaded
    name = "spark.sql.shuffle.partitions"
    before = {n: spark.conf.get(n, None) for n in [*RUNTIME_SETTINGS, *sizing_for(0)]}
    spark.conf.set(name, "1")
    try:
        with sized(spark, root, max_partitions=4) as inside:
            assert inside.conf.get("spark.sql.files.maxPartitionBytes")
        assert spark.conf.get(name) == "1"
        assert sizing_for(10**14, 10)[name] == "10"
    finally:
        spark.conf.set(name, before[name])
    assert {n: spark.conf.get(n, None) for n in before} == before


def test_report_and_check_are_sized(spark, loaded, monkeypatch):
    seen = []

    @contextmanager
    def recorded(session, *paths, **_):
        seen.append(paths)
        with sized(session, *paths) as inside:
            yield inside

    monkeypatch.setattr("tierline.__main__.sized", recorded)
    assert main(["report", loaded[1], "monthly_trend"]) == 0
    main(["check", loaded[1], "silver"])
    assert seen == [(loaded[1],)] * 2


def test_fact_by_month(spark, loaded, scratch):
    clean = read_clean(spark, loaded[1])
    star = build_star(spark, clean, f"{scratch}/monthly", fact_by_month=True)
    fact = star["fact_order_items"]
    assert bag(fact.drop("purchase_month")) == bag(read_star(spark, loaded[1])["fact_order_items"])
    assert fact.filter("purchase_month <> date_format(purchase_ts, 'yyyy-MM')").count() == 0


def test_registered_layers_answer_sql(spark, loaded):
    """The kind of statement a user of the original brings along, in plain SQL."""
    _, root = loaded
    register(spark, root, prefix="unit_")
    star = read_star(spark, root)
    ranking = spark.sql(
        """
        SELECT category_english, round(sum(price), 2) AS revenue
        FROM unit_gold.fact_order_items JOIN unit_gold.dim_products USING (product_id)
        GROUP BY category_english ORDER BY revenue DESC, category_english LIMIT 10
        """
    )
    wanted = REPORTS["top_categories"](star).select("category_english", "total_revenue")
    assert [tuple(r) for r in ranking.collect()] == [tuple(r) for r in wanted.collect()]
    missing = spark.sql(
        """
        SELECT i.order_id FROM unit_silver.order_items i
        LEFT JOIN unit_silver.orders o ON i.order_id = o.order_id WHERE o.order_id IS NULL
        """
    )
    assert missing.count() == 0
    assert spark.table("unit_bronze.order_items").count() == read_raw(spark, root)["order_items"].count()
    assert bag(list_layer(spark, "unit_gold")) == bag(count_tables(star))
    create_layers(spark, ["unit_bronze", "unit_silver", "unit_gold"], drop_existing=True)
    # Dropping a registered layer leaves its files alone.
    assert star["fact_order_items"].count() > 0


def test_command_line(spark, loaded, scratch, capsys):
    inputs, _ = loaded
    root = f"{scratch}/cli"
    assert main(["load", inputs, root, "--exact"]) == 0
    assert main(["check", root, "gold"]) == 0
    assert main(["check", root, "silver", "--exact"]) == 1
    assert "FAILED orders: negative delivery days" in capsys.readouterr().out
    assert main(["check", root, "bronze", "--public-volumes"]) == 1
    assert "FAILED orders: row count" in capsys.readouterr().out
    for name in REPORTS:
        assert main(["report", root, name]) == 0
    assert "running_total_revenue" in capsys.readouterr().out
