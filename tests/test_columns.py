from decimal import Decimal

from hypothesis import HealthCheck, given
from hypothesis import settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows, text_frame
from tierline import functions as fn
from tierline.schemas import AMOUNT


def one(spark, column, value):
    return text_frame(spark, ["v"], [(value,)]).select(column.alias("r")).first()["r"]


def test_blank_to_null_and_presence(spark):
    df = text_frame(spark, ["v"], [("a ",), ("",), ("  ",), (None,), ("\t",)])
    got = rows(df.select(fn.blank_to_null("v"), fn.is_present("v")))
    # Only spaces are trimmed, so a tab is a value.
    assert got == [("a", True), (None, False), (None, False), (None, False), ("\t", True)]


def test_matches_counts_null_as_no_match(spark):
    df = text_frame(spark, ["v"], [("12",), ("x",), (None,)])
    assert rows(df.select(fn.matches("v", r"^[0-9]+$"))) == [(True,), (False,), (False,)]


def test_casts_never_fail(spark):
    cases = [
        ("1.005", AMOUNT, Decimal("1.01")),
        ("12.5\r", AMOUNT, Decimal("12.50")),
        ("", AMOUNT, None),
        (".", AMOUNT, None),
        ("N/A", AMOUNT, None),
        ("999999999999", AMOUNT, None),
        ("99999999999", T.IntegerType(), None),
        ("2018-02-30 00:00:00", T.TimestampNTZType(), None),
    ]
    for text, kind, wanted in cases:
        assert one(spark, fn.to_type("v", kind), text) == wanted, text


def test_whole_numbers_drop_fractions(spark):
    for text, wanted in [("3", 3), ("3.0", 3), ("3.9", 3), ("-2.7", -2), ("70000", None), ("x", None)]:
        assert one(spark, fn.to_whole_number("v", T.ShortType()), text) == wanted, text


def test_month_does_not_depend_on_the_time_zone(spark, settings):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2018-11-04 00:30:00'),"
        "(TIMESTAMP_NTZ'2017-12-31 23:59:59'), (TIMESTAMP_NTZ'2018-10-01 00:00:00') AS t(ts)"
    )
    for zone in ("UTC", "America/Sao_Paulo", "Pacific/Apia", "Asia/Tokyo"):
        settings(spark__sql__session__timeZone=zone)
        assert rows(df.select(fn.month_of("ts"))) == [("2018-11",), ("2017-12",), ("2018-10",)]


@limits(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**9)), min_size=30, max_size=30
    )
)
def test_half_up_ratio_is_exact(spark, pairs):
    # Halves on purpose: an odd total over 2 is a tie at the last digit.
    pairs = pairs + [(2 * t + 1, 200) for t, _ in pairs]
    data = [(Decimal(t) / 100, n) for t, n in pairs]
    df = spark.createDataFrame(data, "total decimal(20,2), n long")
    got = rows(df.select(fn.half_up_ratio(F.col("total"), F.col("n"), 2)))
    for (total, n), (value,) in zip(pairs, got):
        # Exact rational half-up, away from zero.
        doubled = (2 * abs(total) + n) // (2 * n)
        assert value == Decimal(doubled if total >= 0 else -doubled) / 100


def test_half_up_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None, 0)], "total decimal(20,2), n long")
    assert rows(df.select(fn.half_up_ratio(F.col("total"), F.col("n"), 2))) == [(None,)]
