"""The physical plans the operators are meant to have."""

import re

import pytest

from tierline_queries.layers import layers
from tierline_queries.registry import OPERATORS
from tierline.operators.quarantine import first_items, rank_accepted
from tierline.plans import run_checks
from tierline.plans.checks import CountCheck, KeyCheck, OrphanCheck, ReconcileCheck, RowCheck
from tierline.plans.suites import constraint_checks
from tierline.schemas import CLEAN
from helpers import final_plan, plan


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return layers(spark, sf_dir)


@pytest.fixture()
def shuffled(settings):
    """No broadcast joins, as with large tables."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


def exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def keys(text):
    return [re.sub(r"#\d+L?", "", e).rsplit(", ", 1)[0] for e in exchanges(text)]


# Records that span lines are cut by Arrow batches; nothing else leaves the JVM.
CUT_RECORDS = {"csv_ingest_line_breaks", "csv_ingest_both_escapes"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_cross_joins_and_no_python(tables, name, shuffled):
    text = plan(OPERATORS[name](tables))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "Python"):
        assert bad not in text
    assert ("InArrow" in text) == (name in CUT_RECORDS)
    assert "BroadcastHashJoin" not in text  # nothing is broadcast unless its size allows


@pytest.mark.parametrize("name", ["clean_products", "clean_customers", "clean_orders", "accepted_items"])
def test_dedup_limits_groups_on_both_sides_of_the_shuffle(tables, name, shuffled):
    assert final_plan(OPERATORS[name](tables)).count("WindowGroupLimit") == 2


def test_classification_reads_items_once_and_keys_only(tables, shuffled):
    text = final_plan(tables.classify_live())
    assert text.count("FileScan") == 3
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert sorted(len(s.split(",")) for s in scans) == [1, 1, 7]
    assert len(exchanges(text)) == 4  # items and keys, once for each reference


def test_each_half_of_the_split_reads_its_own_files(tables):
    for name, condition in (("order_items", "NOT is_rejected"), ("quarantine_order_items", "is_rejected")):
        text = tables.build_clean(name)._jdf.queryExecution().toString()
        partition = re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
        assert condition in re.sub(r"#\d+", "", partition)


def test_exact_outputs_read_one_ranking(tables, shuffled):
    ranked = tables.ranked()
    assert exchanges(final_plan(first_items(ranked))) == []
    assert exchanges(final_plan(tables.exact_quarantine())) == []
    assert len(exchanges(final_plan(rank_accepted(tables.classified())))) == 2


def test_key_and_orphan_checks_share_a_shuffle(tables, shuffled):
    """The items are read once for both and once for the rows and counts."""
    kept = (KeyCheck, OrphanCheck, RowCheck, CountCheck, ReconcileCheck)
    checks = [
        c
        for c in constraint_checks(CLEAN)
        if c.table == "order_items" and isinstance(c, kept) and getattr(c, "on", "order_id") == "order_id"
    ]
    checks.append(ReconcileCheck("order_items", "all", ("order_items",), whole="orders"))
    text = final_plan(run_checks("silver", tables.all_clean(), checks))
    assert text.count("ReusedExchange") == 1
    assert len([s for s in text.split("FileScan")[1:] if "order_item_id#" in s.split("\n")[0]]) == 2


def test_fact_shuffles_items_once(tables, shuffled):
    items = tables.clean("order_items")
    text = final_plan(tables.build_star("fact_order_items"))
    assert keys(text) == ["order_id", "order_id"]
    assert len(items.columns) == 6


def test_dim_customers_sums_items_before_the_join(tables, shuffled):
    text = final_plan(tables.build_star("dim_customers"))
    assert sorted(keys(text)) == ["customer_unique_id", "order_id", "order_id"]
    assert re.search(r"partial_sum\(\(price#\d+ \+ freight_value", text)


def test_state_reports_join_one_row_per_person(tables, shuffled):
    for name in ("revenue_by_state", "delivery_performance"):
        text = final_plan(OPERATORS[name](tables))
        join = text.index("Join")
        # Below the join, the fact has already been aggregated to people.
        assert "HashAggregate(keys=[customer_unique_id" in text[join:]


def test_top_lists_never_sort_everything(tables):
    for name in ("top_products", "top_categories"):
        text = final_plan(OPERATORS[name](tables))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_scans_are_pruned_and_filtered(tables):
    text = OPERATORS["delivery_range"](tables)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<delivery_days:int>" in text
    assert "PushedFilters: [IsNotNull(delivery_days)]" in text


@pytest.mark.parametrize(
    "name, pushed", [("table_listing_footers", "COUNT(*)"), ("delivery_range_footers", "MIN(delivery_days), MAX(delivery_days)")]
)
def test_footers_answer_counts_and_ranges(spark, tables, name, pushed):
    text = plan(OPERATORS[name](tables))
    assert text.count(f"PushedAggregation: [{pushed}]") == (3 if "table" in name else 1)
    # Only what the footers hold is read, no column of the rows.
    assert not re.search(r"ReadSchema: struct<(order_id|price|state)", text)
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert "parquet" in listed.split(",")
    fact = tables.star("fact_order_items")
    assert "PushedAggregation" not in plan(fact.filter("price > 5").groupBy("order_status").count())


def test_running_totals_stay_in_their_ranges(tables):
    text = plan(OPERATORS["running_revenue_by_order"](tables))
    assert "SinglePartition" not in text and text.count("Window [") <= 1
