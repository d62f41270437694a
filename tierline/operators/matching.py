"""Keys as joins, groups and sorts compare them, under a collation or without one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import sort_key
from tierline.schemas import collated_columns


def compared(df: DataFrame, name: str) -> Column:
    """The column itself; under a collation the bytes that compare as it does."""
    if name not in collated_columns(df):
        return F.col(name)
    return sort_key(df.sparkSession, name, df.schema[name].dataType.collation)


def join_on(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join on a column of both sides, which comes out first, as the left side spells it."""
    if on not in collated_columns(left):
        return left.join(right, on, how)
    known = right.withColumn("_match", compared(right, on)).drop(on)
    joined = left.withColumn("_match", compared(left, on)).join(known, "_match", how).drop("_match")
    return joined.select(on, *[c for c in joined.columns if c != on])
