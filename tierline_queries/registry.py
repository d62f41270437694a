"""The registered queries: one operator each, over its written inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline_queries.layers import Layers, layers, write_csv, write_files
from tierline.functions import month_of
from tierline.operators import analysis, quality, quarantine, star
from tierline.plans import (
    build_clean,
    build_star,
    clean_suite,
    measure_load,
    raw_suite,
    run_checks,
    run_stored_checks,
    star_suite,
)
from tierline.plans.checks import CountCheck
from tierline.plans.pipeline import read_star, write_classified, write_ranked
from tierline.plans.reports import FOOTER_REPORTS, REPORTS
from tierline.schemas import AMOUNT, RAW
from tierline.sources import (
    append_load,
    count_tables,
    create_layers,
    ingest_raw,
    layer_path,
    list_layer,
    malformed_lines,
    new_version,
    publish,
    publish_table,
    read_footers,
    read_loads,
    register_table,
    version_path,
    versions,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]


# Expected rows and tolerance; some fail at any size, so that both outcomes are compared.
EXPECTED_ROWS = {
    "product_category_translation": (8, 0.25),
    "products": (2_000, 0.0),
    "customers": (15_000, 0.0625),
    "orders": (12_000, 0.125),
    "order_items": (60_000, 0.0),
}


def _csv_round_trip(t: Layers, name: str) -> DataFrame:
    """Write a raw table as CSV files and ingest them again."""
    path = f"{t.root}/csv/{name}"
    write_csv(t.raw(name), path)
    back = ingest_raw(t.spark, path, RAW[name])
    lineage = F.col("_ingested_at").isNotNull() & F.col("_source_file").endswith(".csv")
    return back.select(*RAW[name].names, lineage.alias("has_lineage"))


def _csv_line_breaks(t: Layers) -> DataFrame:
    """Customers whose quoted city holds a line break and a comma, written and ingested."""
    path = f"{t.root}/csv/line_breaks"
    city = F.concat("customer_city", F.lit(",\n"), "customer_state")
    write_csv(t.raw("customers").withColumn("customer_city", city), path)
    back = ingest_raw(t.spark, path, RAW["customers"], multi_line=True)
    return back.select(*RAW["customers"].names)


def _malformed_lines(t: Layers) -> DataFrame:
    """Orders ending in 7 get a field too many, those in 3 one too few; all files together."""
    orders, last = t.raw("orders"), F.col("order_id").substr(-1, 1)
    path = f"{t.root}/csv/malformed"
    write_csv(orders.filter(~last.isin("3", "7")), f"{path}/whole")
    write_csv(orders.filter(last == "7").withColumn("surplus", F.lit("x")), f"{path}/longer")
    write_csv(orders.filter(last == "3").select(*orders.columns[:-1]), f"{path}/shorter")
    per_file = malformed_lines(t.spark, f"{path}/*", RAW["orders"])
    return per_file.agg(
        F.sum("n_lines").alias("n_lines"), F.sum("malformed_lines").alias("malformed_lines")
    )


def _quoted(c: Column, by: Column) -> Column:
    """A field in quotes; quotes inside are doubled or follow a backslash, as ``by`` says."""
    safe = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    escape = F.when(by, F.lit('""')).otherwise(F.lit('\\"'))
    return F.concat(F.lit('"'), F.replace(safe, F.lit('"'), escape), F.lit('"'))


def _both_escapes(t: Layers) -> DataFrame:
    """Customers in files that mix both escapes, with line breaks, CRLF ends and a byte-order mark."""
    names, number = RAW["customers"].names, F.col("customer_id").substr(-1, 1).cast("int")
    city = F.concat(F.lit('"'), F.trim("customer_city"), F.lit('", \n\\'), "customer_state")
    rows = t.raw("customers").withColumn("customer_city", city)
    fields = [_quoted(F.col(n), number % 2 == 0) for n in names]
    lines = rows.select(
        F.concat(F.lit("customers_"), F.lpad((number % 3).cast("string"), 2, "0"), F.lit(".csv")).alias("file"),
        F.lit(1).alias("place"),
        F.concat(F.concat_ws(",", *fields), F.when(number > 4, F.lit("\r")).otherwise("")).alias("line"),
    )
    header = F.lit("\ufeff" + ",".join(names) + "\r")
    headers = lines.select("file").distinct().select("file", F.lit(0).alias("place"), header.alias("line"))
    path = f"{t.root}/csv/both_escapes"
    write_files(lines.unionByName(headers), path)
    back = ingest_raw(t.spark, path, RAW["customers"], escape="both", multi_line=True)
    return back.select(*names, F.col("_source_file").alias("source_file"))


def _items_by_file(t: Layers) -> DataFrame:
    """Line items in five files, some with a field too many, ingested and accounted for."""
    names, supplier = RAW["order_items"].names, F.expr("CAST(substr(seller_id, 2) AS BIGINT)")
    lines = t.raw("order_items").select(
        F.concat(F.lit("items_"), (supplier % 5).cast("string"), F.lit(".csv")).alias("file"),
        F.lit(1).alias("place"),
        F.concat(F.concat_ws(",", *names), F.when(supplier % 53 == 4, F.lit(",surplus")).otherwise("")).alias("line"),
    )
    header = F.lit(",".join(names)).alias("line")
    headers = lines.select("file").distinct().select("file", F.lit(0).alias("place"), header)
    path = f"{t.root}/csv/items_by_file"
    write_files(lines.unionByName(headers), path)
    raw = t.keep(ingest_raw(t.spark, path, RAW["order_items"], mark_malformed=True), "items_by_file")
    classified = write_classified(
        t.spark,
        raw,
        t.clean("orders"),
        t.clean("products"),
        f"{t.root}/work/classified_by_file",
        strict=True,
    )
    ranked = write_ranked(t.spark, classified, f"{t.root}/work/ranked_by_file")
    return quarantine.reconcile_by_file(raw, classified, ranked)


def _append_by_load(t: Layers) -> DataFrame:
    """Orders appended in two loads; the second stops after a third of its rows and is repeated twice."""
    orders, path = t.raw("orders"), f"{t.root}/appended/orders"
    even = F.col("order_id").substr(-1, 1).cast("int") % 2 == 0
    append_load(orders.filter(even), path, "even")
    append_load(orders.filter(~even & (F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0)), path, "odd")
    for _ in range(2):
        append_load(orders.filter(~even), path, "odd")
    return (
        read_loads(t.spark, path, RAW["orders"])
        .groupBy("load_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("order_id").alias("n_orders"),
            F.min("order_id").alias("first_order"),
            F.max("order_id").alias("last_order"),
        )
    )


def _versioned_reload(t: Layers) -> DataFrame:
    """The fact published in part, published whole, then begun once more but not published."""
    root, fact = f"{t.root}/versions-{uuid.uuid4().hex[:8]}", t.star("fact_order_items")
    for rows, last in ((fact.filter("order_item_id = 1"), True), (fact, True), (fact.filter("price < 0"), False)):
        version = new_version()
        write_table(rows, layer_path(version_path(root, version), "gold", "fact_order_items"))
        if last:
            publish(t.spark, root, version)
    current = read_star(t.spark, root, ["fact_order_items"])["fact_order_items"]
    return current.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.sum("price").cast("decimal(20,2)").alias("total_revenue"),
        F.lit(versions(t.spark, root).count()).cast("long").alias("n_versions"),
    )


def _footers(t: Layers) -> dict[str, DataFrame]:
    """The star tables, read for what their files' footers know."""
    return {name: read_footers(t.spark, t.star_path(name), df.schema) for name, df in t.all_star().items()}


def _published_layer(t: Layers) -> DataFrame:
    """Publish the star tables as managed tables of a dropped and created layer, twice; list it."""
    layer = "published_" + t.root.rsplit("-", 1)[-1]
    for _ in range(2):
        create_layers(t.spark, [layer], root=f"{t.root}/catalog", drop_existing=True)
        for name, df in t.all_star().items():
            publish_table(df, layer, name)
    return list_layer(t.spark, layer)


def _top_categories_wide(t: Layers) -> DataFrame:
    """Top categories where there are more than ten: each is told apart by length."""
    tens = F.floor(F.col("length_cm") / 10).cast("string")
    products = t.star("dim_products").withColumn(
        "category_english", F.concat("category_english", F.lit(" "), tens)
    )
    return analysis.top_categories(t.star("fact_order_items"), products)


def _negative_measures(t: Layers) -> DataFrame:
    """Products whose measures are taken down until some are negative."""
    lower = {"weight_g": 2500, "length_cm": 25, "height_cm": 40, "width_cm": 0}
    products = t.clean("products").select(
        "product_id", *[(F.col(n) - by).cast(AMOUNT).alias(n) for n, by in lower.items()]
    )
    return quality.negative_rows(products, list(lower))


def _cased(c: str, flag: Column) -> Column:
    """The key in small letters in some rows, as it is in the others."""
    return F.when(flag, F.lower(c)).otherwise(F.col(c)).alias(c)


def _fact_collated(t: Layers) -> DataFrame:
    """The fact from raw tables whose keys and names differ in case and accents from row to row."""
    raw = t.all_raw()
    items, orders, customers, products = (
        raw[n] for n in ("order_items", "orders", "customers", "products")
    )
    even = F.col("order_item_id").cast("int") % 2 == 0
    name = F.col("product_category_name")
    accent = F.when(F.col("product_id").endswith("3"), F.replace(name, F.lit("e"), F.lit("É"))).otherwise(name)
    raw |= {
        "order_items": items.withColumns(
            {c: _cased(c, flag) for c, flag in (("order_id", even), ("product_id", ~even))}
        ),
        "orders": orders.withColumn("customer_id", F.lower("customer_id")),
        "customers": customers.withColumn(
            "customer_unique_id", _cased("customer_unique_id", F.col("customer_id").endswith("5"))
        ),
        "products": products.withColumn("product_category_name", accent),
    }
    root = f"{t.root}/collated-{uuid.uuid4().hex[:8]}"
    clean = build_clean(t.spark, raw, root, collation="UNICODE_CI_AI")
    fact = build_star(t.spark, clean, root, collation="UNICODE_CI_AI")["fact_order_items"]
    keys = ("order_id", "product_id", "customer_unique_id")
    return fact.withColumns({c: F.lower(c) for c in keys})


def _suite_by_load(t: Layers) -> DataFrame:
    """The bronze suite over three loads, each measured by itself, one of them twice."""
    path, checks = f"{t.root}/measures", raw_suite()
    parts = {name: df.withColumn("_load", F.pmod(F.xxhash64(*df.columns), F.lit(3))) for name, df in t.all_raw().items()}
    for load in (0, 1, 2, 1):
        rows = {name: df.filter(F.col("_load") == load).drop("_load") for name, df in parts.items()}
        measure_load(rows, checks, path, f"load{load}")
    return run_stored_checks(t.spark, "bronze", checks, path)


def _report(name: str) -> Callable[[Layers], DataFrame]:
    return lambda t: REPORTS[name](t.all_star())


def _table_listing(t: Layers) -> DataFrame:
    """Register the star layer in the catalog, then list it from there."""
    layer = "gold_" + t.root.rsplit("-", 1)[-1]
    create_layers(t.spark, [layer], root=f"{t.root}/catalog")
    for name in t.all_star():
        register_table(t.spark, layer, name, t.star_path(name))
    return list_layer(t.spark, layer)


def _registered_fact_by_month(t: Layers) -> DataFrame:
    """Store the fact by month, load it twice, register it and report from the catalog."""
    layer, path = "months_" + t.root.rsplit("-", 1)[-1], f"{t.root}/by_month/fact_order_items"
    create_layers(t.spark, [layer], root=f"{t.root}/catalog")
    by_month = t.star("fact_order_items").withColumn("purchase_month", month_of("purchase_ts"))
    for _ in range(2):
        write_table(by_month, path, ["purchase_month"])
        fact = register_table(t.spark, layer, "fact_order_items", path)
    return fact.groupBy("purchase_month").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.sum("price").cast("decimal(20,2)").alias("total_revenue"),
    )


OPERATORS: dict[str, Callable[[Layers], DataFrame]] = {
    "raw_categories": lambda t: t.mapped("product_category_translation"),
    "raw_products": lambda t: t.mapped("products"),
    "raw_customers": lambda t: t.mapped("customers"),
    "raw_orders": lambda t: t.mapped("orders"),
    "raw_order_items": lambda t: t.mapped("order_items"),
    "csv_ingest_roundtrip": lambda t: _csv_round_trip(t, "order_items"),
    "csv_ingest_orders": lambda t: _csv_round_trip(t, "orders"),
    "csv_ingest_customers": lambda t: _csv_round_trip(t, "customers"),
    "csv_ingest_products": lambda t: _csv_round_trip(t, "products"),
    "csv_ingest_categories": lambda t: _csv_round_trip(t, "product_category_translation"),
    "csv_ingest_line_breaks": _csv_line_breaks,
    "csv_ingest_both_escapes": _both_escapes,
    "dq_malformed_lines": _malformed_lines,
    "dq_reconciliation_by_file": _items_by_file,
    "append_by_load": _append_by_load,
    "versioned_reload": _versioned_reload,
    "published_layer": _published_layer,
    "table_listing_footers": lambda t: FOOTER_REPORTS["table_listing"](_footers(t)),
    "delivery_range_footers": lambda t: FOOTER_REPORTS["delivery_range"](_footers(t)),
    "clean_categories": lambda t: t.build_clean("categories"),
    "clean_products": lambda t: t.build_clean("products"),
    "clean_customers": lambda t: t.build_clean("customers"),
    "clean_orders": lambda t: t.build_clean("orders"),
    "accepted_items": lambda t: t.build_clean("order_items"),
    "quarantined_items": lambda t: quarantine.build_quarantine(t.classify_live()),
    "quarantine_exact": lambda t: t.exact_quarantine(),
    "fact_collated": _fact_collated,
    "ranked_items": lambda t: quarantine.rank_accepted(t.classified()),
    "dim_products": lambda t: t.build_star("dim_products"),
    "dim_customers": lambda t: star.build_dim_customers(
        t.clean("customers"), t.clean("orders"), t.clean("order_items")
    ),
    "fact_order_items": lambda t: star.build_fact_order_items(
        t.clean("order_items"), t.clean("orders"), t.clean("customers")
    ),
    **{name: _report(name) for name in REPORTS},
    "table_listing": _table_listing,
    "registered_fact_by_month": _registered_fact_by_month,
    "running_revenue_by_order": lambda t: analysis.running_revenue_by_order(
        t.star("fact_order_items"), lambda df: t.keep(df, "revenue_ranges")
    ),
    "top_categories_wide": _top_categories_wide,
    "spend_segments": lambda t: analysis.spend_segments(
        t.star("dim_customers"), (("High Value", 1_500_000), ("Mid Value", 900_000))
    ),
    "spend_segments_default": lambda t: analysis.spend_segments(t.star("dim_customers")),
    "dq_duplicate_keys": lambda t: quality.duplicate_keys(
        t.raw("order_items"), ["order_id", "order_item_id"]
    ),
    "dq_missing_rows": lambda t: quality.missing_rows(
        t.raw("orders"), ["order_id", "customer_id", "order_delivered_customer_date"]
    ),
    "dq_missing_nulls": lambda t: quality.missing_rows(
        t.clean("orders"), ["order_id", "delivered_customer_ts"], blank=False
    ),
    "dq_orphans": lambda t: quality.orphans(
        t.raw("orders").select("order_id", "customer_id"), t.raw("customers"), "customer_id"
    ),
    "dq_orphan_categories": lambda t: quality.orphans(
        t.raw("products"),
        t.raw("product_category_translation"),
        "product_category_name",
        ignore_null=True,
        distinct=True,
    ),
    "dq_pattern": lambda t: quality.pattern_violations(
        t.raw("order_items"),
        {"price": quarantine.UNSIGNED_DECIMAL, "freight_value": quarantine.UNSIGNED_DECIMAL},
    ),
    "dq_negative": lambda t: quality.negative_rows(t.clean("orders"), ["delivery_days"]),
    "dq_negative_measures": _negative_measures,
    "dq_domain": lambda t: quality.distinct_values(t.raw("orders"), "order_status"),
    "dq_length": lambda t: quality.length_violations(t.clean("customers"), "state", 2),
    "dq_implication": lambda t: quality.implication_violations(
        t.raw("orders"), F.col("order_status") == "delivered", ["order_delivered_customer_date"]
    ),
    "dq_count_pair": lambda t: quality.count_pair(
        t.clean("orders"),
        delivered_true=F.col("is_delivered"),
        delivery_days_not_null=F.col("delivery_days").isNotNull(),
    ),
    "dq_row_counts": lambda t: count_tables(t.all_raw()),
    "dq_row_expectations": lambda t: run_checks(
        "bronze",
        t.all_raw(),
        [CountCheck(name, "row count", *wanted) for name, wanted in EXPECTED_ROWS.items()],
    ),
    "dq_reason_tally": lambda t: quality.tally(
        t.clean("quarantine_order_items"), "rejection_reason"
    ),
    "dq_reconciliation": lambda t: quarantine.reconcile(
        t.raw("order_items"), t.clean("order_items"), t.clean("quarantine_order_items")
    ),
    "dq_reconciliation_exact": lambda t: quarantine.reconcile(
        t.raw("order_items"), quarantine.first_items(t.ranked()), t.exact_quarantine()
    ),
    "dq_cast_losses": lambda t: quality.cast_losses(
        t.raw("order_items"),
        {
            "price": AMOUNT,
            "freight_value": AMOUNT,
            "shipping_limit_date": T.TimestampNTZType(),
        },
    ),
    "dq_suite_bronze": lambda t: run_checks("bronze", t.all_raw(), raw_suite()),
    "dq_suite_bronze_by_load": _suite_by_load,
    "dq_suite_silver": lambda t: run_checks(
        "silver",
        {
            **t.all_clean(),
            "raw_order_items": t.raw("order_items"),
            "accepted_order_items": quarantine.accepted_keys(t.classified()),
        },
        clean_suite(),
    ),
    "dq_suite_gold": lambda t: run_checks(
        "gold", {**t.all_star(), "order_items": t.clean("order_items")}, star_suite()
    ),
}


def _over_layers(operator: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(layers(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _over_layers(operator) for name, operator in OPERATORS.items()}
