"""Check measures stored per load: merged they equal the suite over all rows."""

import pytest
from pyspark.sql import functions as F

from helpers import bag
from tierline.plans import KeyCheck, RowCheck, measure_load, raw_suite, run_checks, run_stored_checks
from tierline.plans.checks import CountCheck, DomainCheck, OrphanCheck, PairCheck, ReconcileCheck, RepeatCount
from tierline.schemas import RAW

def checks():
    return [
        RowCheck("a", "negative", F.col("n") < 0),
        CountCheck("a", "row count", 9),
        CountCheck("a", "ones", where=F.col("n") == 1),
        PairCheck("a", "pairs", F.col("n") == 1, F.col("k") == "x"),
        DomainCheck("a", "values", "k"),
        DomainCheck("a", "allowed values", "k", ("x", "y")),
        KeyCheck("a", "repeated", ("k", "n")),
        KeyCheck("b", "repeated", ("k",)),
        OrphanCheck("a", "lost", "k", "b", "k"),
        OrphanCheck("a", "lost keys", "k", "b", "k", ignore_null=True, distinct=True),
        RepeatCount("a", "surplus", "a", ("k", "n")),
        ReconcileCheck("a", "all rows", ("a", "b"), whole="c"),
    ]


LOADS = {
    "one": ([("x", 1), ("y", 2), ("x", 1)], ["x", "x"], 5),
    "two": ([("x", 1), (None, -1)], [], 0),
    "three": ([("z", 3), ("y", 2)], ["z", "y", "x"], 5),
}


def tables(spark, loads):
    a = [r for name in loads for r in LOADS[name][0]]
    b = [(k,) for name in loads for k in LOADS[name][1]]
    n = sum(LOADS[name][2] for name in loads)
    return {
        "a": spark.createDataFrame(a, "k string, n int"),
        "b": spark.createDataFrame(b, "k string"),
        "c": spark.range(n).toDF("i"),
    }


def test_merged_measures_equal_the_suite(spark, tmp_path):
    path = str(tmp_path)
    for name in ("one", "two", "two", "three"):
        measure_load(tables(spark, [name]), checks(), path, name)
    found = run_stored_checks(spark, "x", checks(), path)
    assert bag(found) == bag(run_checks("x", tables(spark, LOADS), checks()))
    part = run_stored_checks(spark, "x", checks(), path, ["one", "three"])
    assert bag(part) == bag(run_checks("x", tables(spark, ["one", "three"]), checks()))


def test_only_stored_measures_are_read(spark, tmp_path):
    raw = {n: spark.createDataFrame([], s) for n, s in RAW.items()}
    for name, df in raw.items():
        df.write.parquet(f"{tmp_path}/raw/{name}")
    raw = {n: spark.read.schema(s).parquet(f"{tmp_path}/raw/{n}") for n, s in RAW.items()}
    path = f"{tmp_path}/measures"
    measure_load(raw, raw_suite(), path, "first")
    found = run_stored_checks(spark, "bronze", raw_suite(), path)
    read = found.inputFiles()
    assert read and all("/measures/" in file for file in read)
    assert bag(found) == bag(run_checks("bronze", raw, raw_suite()))


def test_measures_must_be_there_and_named(spark, tmp_path):
    path, some = str(tmp_path), tables(spark, ["one"])
    measure_load(some, checks()[:2], path, "one")
    with pytest.raises(KeyError, match="a/ones"):
        run_stored_checks(spark, "x", checks()[:3], path)
    with pytest.raises(ValueError, match="names of their own"):
        measure_load(some, [checks()[0], checks()[0]], path, "one")
    assert run_stored_checks(spark, "x", [], path).count() == 0
