"""Data-quality reports, each generic over tables and columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import is_present, to_type
from tierline.operators.cleaning import unique_keys


def any_of(conditions: Sequence[Column]) -> Column:
    """True where at least one condition is true; NULL conditions count as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


# -- row conditions, also used by the check suites -----------------------------


def is_missing(columns: Sequence[str], blank: bool = True) -> Column:
    return any_of([~is_present(c) if blank else F.col(c).isNull() for c in columns])


def breaks_pattern(patterns: Mapping[str, str]) -> Column:
    """A value is present and does not match. NULL is not a format error."""
    return any_of([~F.col(name).rlike(pattern) for name, pattern in patterns.items()])


def is_negative(columns: Sequence[str]) -> Column:
    return any_of([F.col(name) < 0 for name in columns])


def has_wrong_length(column: str, length: int) -> Column:
    """Length is counted in bytes."""
    return F.coalesce(F.octet_length(column) != length, F.lit(False))


def breaks_implication(condition: Column, required: Sequence[str]) -> Column:
    """The condition holds while a required column is NULL or blank."""
    return F.coalesce(condition, F.lit(False)) & is_missing(required)


def loses_value(types: Mapping[str, T.DataType]) -> Column:
    """A present value that its target type cannot hold."""
    return any_of(
        [is_present(name) & to_type(name, kind).isNull() for name, kind in types.items()]
    )


# -- reports ------------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_rows(df: DataFrame, columns: Sequence[str], blank: bool = True) -> DataFrame:
    """Rows in which a required column is NULL, or also blank."""
    return df.filter(is_missing(columns, blank))


def orphans(
    child: DataFrame,
    parent: DataFrame,
    on: str,
    *,
    parent_key: str | None = None,
    ignore_null: bool = False,
    distinct: bool = False,
    unique_parent: bool = False,
) -> DataFrame:
    """Child rows whose key is not in ``parent``; with ``distinct`` only the keys.

    A NULL child key is an orphan unless ``ignore_null``. Repeated parent keys, and
    with ``distinct`` repeated child keys, are dropped before the shuffle; a parent
    that is known to hold each key once goes straight into the join.
    """
    if ignore_null:
        child = child.filter(F.col(on).isNotNull())
    if distinct:
        child = child.select(on).distinct()
    column = parent_key or on
    if unique_parent:
        known = parent.select(F.col(column).alias("_parent_key"))
    else:
        known = unique_keys(parent, column, "_parent_key")
    return child.join(known, child[on] == known["_parent_key"], "left_anti")


def pattern_violations(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    return df.filter(breaks_pattern(patterns))


def negative_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(is_negative(columns))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def length_violations(df: DataFrame, column: str, length: int) -> DataFrame:
    """Distinct values of ``column`` that are not ``length`` bytes long."""
    return df.filter(has_wrong_length(column, length)).select(column).distinct()


def implication_violations(
    df: DataFrame, condition: Column, required: Sequence[str]
) -> DataFrame:
    return df.filter(breaks_implication(condition, required))


def count_pair(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows for which each named condition holds."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def tally(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def cast_losses(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """``column_name, lost``: present values that become NULL in their type."""
    counted = df.agg(
        *[F.count_if(loses_value({name: kind})).alias(name) for name, kind in types.items()]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(name).alias("lost"))
            for name in types
        ]
    )
    return counted.select(F.inline(pairs))
