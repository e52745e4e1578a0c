from datetime import date, datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tillwise.functions import domains, text, times
from tillwise.functions.numbers import exact_sum, mean, round_to, share


def doubles(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def one(df):
    return df.collect()[0][0]


@pytest.mark.parametrize("value, places, expected", [
    (1.005, 1, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13), (-0.125, 2, -0.13),
    (1e300, 2, 1e300), (1.005, 2, 1.0), (0.285, 2, 0.28), (None, 2, None), (math.inf, 2, math.inf), (1234.5678, 4, 1234.5678)])
def test_round_half_away_from_zero(spark, value, places, expected):
    assert one(doubles(spark, value).select(round_to("x", places))) == expected


def test_round_keeps_nan(spark):
    assert math.isnan(one(doubles(spark, math.nan).select(round_to("x", 2))))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=60))
def test_exact_sum_is_exact_in_any_layout(spark, cents):
    df = doubles(spark, *(c / 100 for c in cents))
    for parts in (1, 7):
        assert one(df.repartition(parts).agg(exact_sum("x"))) == sum(cents) / 100


def test_exact_sum_counts_by_weight(spark):
    df = spark.createDataFrame([(1.25, 3), (2.0, 1), (None, 9)], "x double, w long")
    row = df.agg(exact_sum("x", F.col("w")), mean("x", F.col("w"))).collect()[0]
    assert row[0] == 5.75 and row[1] == 5.75 / 4


def test_exact_sum_shows_what_has_no_units(spark):
    assert math.isnan(one(doubles(spark, 1.0, math.nan).agg(exact_sum("x"))))
    assert one(doubles(spark, 1.0, math.inf).agg(exact_sum("x"))) == math.inf
    assert one(doubles(spark, 1.0, 1e18).agg(exact_sum("x"))) == 1.0 + 1e18
    # each value has units, their sum has more than 64 bits
    assert one(doubles(spark, *[9e14] * 4).agg(exact_sum("x"))) == 3.6e15
    assert one(doubles(spark, -2.5, 1e300, -0.25).agg(exact_sum("x"))) == 1e300


def test_exact_sum_loses_no_fine_value(spark):
    fine = spark.range(100_000).select(F.lit(0.00003).alias("x"))
    thirds = spark.range(3_000).select((F.lit(1.0) / 3).alias("x"))
    assert one(fine.agg(exact_sum("x"))) == pytest.approx(3.0, abs=1e-9)
    assert one(fine.agg(mean("x"))) == pytest.approx(0.00003, abs=1e-15)
    assert one(thirds.agg(exact_sum("x"))) == pytest.approx(1000.0, abs=1e-9)
    weighted = thirds.withColumn("w", F.lit(7).cast("long"))
    assert one(weighted.agg(exact_sum("x", F.col("w")))) == pytest.approx(7000.0, abs=1e-8)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e12, max_value=1e12), min_size=1, max_size=30))
def test_exact_sum_is_near_fsum(spark, values):
    assert one(doubles(spark, *values).agg(exact_sum("x"))) == pytest.approx(math.fsum(values), rel=1e-9, abs=1e-3)


def test_sums_and_means_of_nothing_are_null(spark):
    assert doubles(spark, None, None).agg(exact_sum("x"), mean("x")).collect()[0] == (None, None)


def test_share_takes_null_as_not_true(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "s string")
    assert one(df.agg(share(F.col("s") == "a"))) == 0.5


@pytest.mark.parametrize("last, days", [
    ("2024-03-01 12:00:00", 60), ("2024-02-29 12:00:00", 61), ("2024-03-01 12:00:01", 59)])
def test_whole_days(spark, last, days):
    df = spark.createDataFrame([(datetime.fromisoformat(last),)], "t timestamp")
    assert one(df.select(times.whole_days("t", times.moment("2024-04-30 12:00:00")))) == days


def test_iso_week_starts_on_monday(spark):
    df = spark.createDataFrame([(datetime(2024, 9, 1, 23),), (datetime(2024, 9, 2),)],
                               "t timestamp")
    assert [r[0] for r in df.select(times.iso_week("t")).collect()] == [date(2024, 8, 26),
                                                                        date(2024, 9, 2)]


NUMBERS = [" 12.5 ", " 1\t", "1e3", "+.5", "5.", "1_000.5", "nan", "Infinity", "-inf",
           '"NaN"', '"Infinity"', "1.0d", "1f", "0x1p3", "abc", "", "1__0", "_1", "--1", "1e",
           "true", ".", "1 2", "\"5\""]


def test_to_number_takes_what_python_takes(spark):
    df = spark.createDataFrame([(n,) for n in NUMBERS], "s string")
    for word, number in df.select("s", text.to_number(F.col("s"))).collect():
        bare = word.strip('"') if word in ('"NaN"', '"Infinity"') else word
        try:
            expected = float(bare)
        except ValueError:
            expected = None
        assert str(number) == str(expected), word


def test_strip_is_pythons_strip(spark):
    words = ["\t a b\n", "　x ", "\x1cq\x85", "plain", "", " \r\n"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    assert [r[0] for r in df.select(text.strip(F.col("s"))).collect()] == [w.strip() for w in words]


def test_white_space_is_pythons():
    assert set(text.WHITE_SPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_region_of(spark):
    df = spark.createDataFrame([("France",), ("Japan",), (None,)], "c string")
    assert [r[0] for r in df.select(domains.region_of(F.col("c"))).collect()] == [
        "Europe-West", "Other", "Other"]


def test_inside_band(spark):
    df = spark.createDataFrame([("/cart", 20.0), ("/cart", 181.0), ("/new", 1.0), (None, 1.0)],
                               "p string, d double")
    result = df.select(domains.inside(F.col("d"), F.col("p"), domains.PAGE_DURATION_BAND))
    assert [r[0] for r in result.collect()] == [True, False, None, None]
