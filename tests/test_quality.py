import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import bag, final_plan, rows, text_frame
from tierline.operators import quality
from tierline.plans import (
    CountCheck,
    DomainCheck,
    KeyCheck,
    OrphanCheck,
    PairCheck,
    ReconcileCheck,
    RowCheck,
    assert_checks,
    run_checks,
)
from tierline.schemas import AMOUNT


@pytest.fixture(scope="module")
def df(spark):
    return text_frame(
        spark,
        ["k", "v"],
        [("a", "1"), ("a", "x"), ("b", ""), ("b", "  "), ("c", None), (None, "."), (None, "-3")],
    )


def test_duplicate_keys(df):
    assert bag(quality.duplicate_keys(df, ["k"])) == [(None, 2), ("a", 2), ("b", 2)]
    assert bag(quality.duplicate_keys(df, ["k", "v"])) == []


def test_missing_rows(df):
    assert bag(quality.missing_rows(df, ["k"])) == [(None, "-3"), (None, ".")]
    assert bag(quality.missing_rows(df, ["v"])) == [("b", ""), ("b", "  "), ("c", None)]
    assert bag(quality.missing_rows(df, ["v"], blank=False)) == [("c", None)]


def test_orphans(spark, df):
    parent = text_frame(spark, ["id"], [("a",), ("a",), (None,)])
    found = quality.orphans(df, parent, "k", parent_key="id")
    assert bag(found.select("k")) == [(None,), (None,), ("b",), ("b",), ("c",)]
    known = quality.orphans(df, parent, "k", parent_key="id", ignore_null=True)
    assert bag(known.select("k")) == [("b",), ("b",), ("c",)]
    keys = quality.orphans(df, parent, "k", parent_key="id", ignore_null=True, distinct=True)
    assert bag(keys) == [("b",), ("c",)]


def test_orphans_with_hot_keys_on_both_sides(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
    )
    key = "if(id % 3 = 0, 'hot', concat('k', id % 5000)) AS k"
    child = spark.range(0, 60_000, 1, 8).selectExpr(key, "uuid() AS payload")
    parent = spark.range(0, 30_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'other', concat('k', id % 2500)) AS k"
    )
    found = quality.orphans(child, parent, "k")
    text = final_plan(found)
    # The child's hot key is split; the parent's copies go before its first shuffle.
    assert "skew=true" in text
    assert text.count("HashAggregate(keys=[_parent_key") == 2
    wanted = sum(1 for i in range(60_000) if i % 3 == 0 or i % 5000 >= 2500)
    assert found.count() == wanted


def test_patterns(df):
    strict = quality.pattern_violations(df, {"v": r"^[0-9]+(\.[0-9]+)?$"})
    assert bag(strict.select("v")) == [("",), ("  ",), ("-3",), (".",), ("x",)]
    # The loose shape lets '' and '.' through.
    loose = quality.pattern_violations(df, {"v": r"^[0-9]*\.?[0-9]*$"})
    assert bag(loose.select("v")) == [("  ",), ("-3",), ("x",)]


def test_negative_length_domain(spark, df):
    numbers = df.select(F.col("v").try_cast("int").alias("n"), "k")
    assert bag(quality.negative_rows(numbers, ["n"])) == [(-3, None)]
    codes = text_frame(spark, ["state"], [("RJ",), ("SPX",), ("é",), ("A",), ("A",), (None,)])
    # Bytes, not characters: one accented letter is two bytes long.
    assert bag(quality.length_violations(codes, "state", 2)) == [("A",), ("SPX",)]
    assert bag(quality.distinct_values(codes, "state"))[0] == (None,)


def test_implication_pair_tally_and_casts(df):
    broken = quality.implication_violations(df, F.col("k") == "b", ["v"])
    assert bag(broken) == [("b", ""), ("b", "  ")]
    pair = quality.count_pair(df, keyed=F.col("k").isNotNull(), valued=F.col("v").isNotNull())
    assert rows(pair) == [(5, 6)]
    assert rows(quality.row_count(df)) == [(7,)]
    assert bag(quality.tally(df, "k")) == [(None, 2), ("a", 2), ("b", 2), ("c", 1)]
    lost = quality.cast_losses(df, {"v": AMOUNT, "k": T.DateType()})
    assert bag(lost) == [("k", 5), ("v", 2)]


def test_checks_fail_and_pass(spark, df):
    tables = {
        "t": df,
        "p": text_frame(spark, ["k"], [("a",), ("b",)]),
        "half": df.filter("k = 'a'"),
        "rest": df.filter("k IS NULL OR k <> 'a'"),
    }
    checks = [
        RowCheck("t", "blank", quality.is_missing(["v"])),
        RowCheck("p", "blank", quality.is_missing(["k"])),
        CountCheck("t", "rows"),
        CountCheck("t", "rows near", 8, 0.2),
        CountCheck("t", "rows far", 80, 0.2),
        CountCheck("t", "a rows", 2, where=F.col("k") == "a"),
        PairCheck("t", "pair", F.col("k").isNotNull(), F.col("v").isNotNull()),
        KeyCheck("t", "key", ("k",)),
        KeyCheck("p", "key", ("k",)),
        OrphanCheck("t", "orphans", "k", "p", "k"),
        OrphanCheck("t", "orphans known", "k", "p", "k", ignore_null=True),
        OrphanCheck("half", "orphans", "k", "p", "k"),
        DomainCheck("t", "values", "k"),
        DomainCheck("t", "allowed", "k", ("a", "b")),
        ReconcileCheck("t", "adds up", ("half", "rest"), whole="t"),
        ReconcileCheck("t", "short", ("half",), whole="t"),
        ReconcileCheck("t", "given", ("half",), expected=2),
    ]
    got = {(r[1], r[2]): r[3:] for r in rows(run_checks("layer", tables, checks))}
    assert got == {
        ("t", "blank"): (3, 0, False),
        ("p", "blank"): (0, 0, True),
        ("t", "rows"): (7, None, None),
        ("t", "rows near"): (7, 8, True),
        ("t", "rows far"): (7, 80, False),
        ("t", "a rows"): (2, 2, True),
        ("t", "pair"): (5, 6, False),
        ("t", "key"): (3, 0, False),
        ("p", "key"): (0, 0, True),
        ("t", "orphans"): (3, 0, False),
        ("t", "orphans known"): (1, 0, False),
        ("half", "orphans"): (0, 0, True),
        ("t", "values"): (4, None, None),
        ("t", "allowed"): (2, 0, False),
        ("t", "adds up"): (7, 7, True),
        ("t", "short"): (2, 7, False),
        ("t", "given"): (2, 2, True),
    }
    assert_checks(run_checks("layer", tables, [checks[1], checks[2], checks[3]]))
    with pytest.raises(AssertionError, match="layer.t blank: 3, expected 0"):
        assert_checks(run_checks("layer", tables, checks[:1]))


def test_row_checks_of_a_table_share_one_scan(spark, scratch):
    path = f"{scratch}/one-scan"
    spark.range(10).selectExpr("id AS k", "id AS v").write.parquet(path)
    t = spark.read.parquet(path)
    checks = [
        RowCheck("t", "k", F.col("k") < 0),
        RowCheck("t", "v", F.col("v") > 5),
        CountCheck("t", "rows", 10),
        PairCheck("t", "pair", F.col("k") > 1, F.col("v") > 1),
    ]
    assert final_plan(run_checks("l", {"t": t}, checks)).count("FileScan") == 1
