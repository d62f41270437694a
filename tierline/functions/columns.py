"""Column expressions shared by the operators. All are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """The value without surrounding spaces; NULL where nothing is left."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def is_present(c: ColumnOrName) -> Column:
    """True where the value is neither NULL nor only spaces; never NULL itself."""
    return F.coalesce(F.trim(_col(c)) != "", F.lit(False))


def matches(c: ColumnOrName, pattern: str) -> Column:
    """Regular-expression match where a NULL value counts as no match."""
    return F.coalesce(_col(c).rlike(pattern), F.lit(False))


def to_type(c: ColumnOrName, kind: T.DataType) -> Column:
    """Text to ``kind``. Blank and malformed text give NULL instead of an error."""
    return blank_to_null(c).try_cast(kind)


def to_whole_number(c: ColumnOrName, kind: T.DataType) -> Column:
    """Text to an integer type, dropping a fraction as in ``'3.0'``."""
    return blank_to_null(c).try_cast(T.DecimalType(38, 18)).try_cast(kind)


def half_up_ratio(total: Column, count: Column, scale: int, precision: int = 20) -> Column:
    """``total / count`` rounded half away from zero, computed in decimals.

    ``total`` is narrowed to 20 digits first, which leaves the quotient at least
    18 decimal places: a quotient that is not an exact tie stays on its own side.
    """
    digits = T.DecimalType(20, 2)
    quotient = total.cast(digits) / F.nullif(count.cast(T.LongType()), F.lit(0).cast("long"))
    return F.round(quotient, scale).cast(T.DecimalType(precision, scale))


def month_of(ts: ColumnOrName) -> Column:
    """``yyyy-MM`` of a zoneless timestamp, whatever the session time zone is."""
    return F.date_format(F.to_date(_col(ts)), "yyyy-MM")
