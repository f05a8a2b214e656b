"""Column expressions, with the edge values that differ between engines."""

import datetime as dt
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions import calendar, exact, labels, lenient
from marquee.functions.genres import genre_names


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_means_round_half_up(spark):
    df = spark.createDataFrame([("2.01", 2, 1.01), ("1", 8, 0.13), ("-2.01", 2, -1.01), ("5", 0, None), ("0.012", 3, 0.0), ("25.107", 3, 8.37)], "s string, n bigint, e double")
    assert all(r.got == r.e for r in df.select("e", exact.mean(F.col("s").cast("decimal(38,12)"), "n", 2).alias("got")).collect())


def test_percent_and_ratio(spark):
    df = spark.createDataFrame([(1, 3), (-1, 8), (1, 0), (-13000, -3000)], "a bigint, b bigint")
    got = df.select(exact.percent("a", "b", 1), exact.ratio("a", "b", 2)).collect()
    assert [tuple(r) for r in got] == [(33.3, 0.33), (-12.5, -0.13), (None, None), (433.3, 4.33)]


def test_odd_doubles_are_missing(spark):
    values = [0.004, 8.369, 1e17, 1e21, float("inf"), float("nan"), None]
    got = column(spark, values, "double", exact.unfixed(exact.fixed("v")))
    assert got == [0.004, 8.369, 1e17, None, None, None, None]


def test_large_operands_take_the_decimal_way(spark):
    big = 9 * 10**18
    df = spark.createDataFrame([(big, 7), (-big, 7), (3, big), (big, big - 1)], "a bigint, b bigint")
    got = [r[0] for r in df.select(exact.ratio("a", "b", 2)).collect()]
    assert got == [big / 7, -big / 7, 0.0, 1.0]
    assert df.select(exact.percent("a", "b", 1)).collect()[2][0] == 0.0


@settings(max_examples=20, deadline=None)
@given(st.integers(-(10**18), 10**18), st.integers(1, 10**17), st.sampled_from([0, 1, 2, 4]))
def test_ratio_against_exact_fractions(spark, top, bottom, digits):
    df = spark.createDataFrame([(top, bottom)], "a bigint, b bigint")
    scaled = Fraction(abs(top) * 10**digits, bottom)
    units = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    expected = (-units if top < 0 else units) / 10**digits
    assert df.select(exact.ratio("a", "b", digits)).first()[0] == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10**7), min_size=1, max_size=40))
def test_sums_do_not_depend_on_partitions(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    sums = {df.repartition(n).agg(F.sum(exact.fixed("v"))).first()[0] for n in (1, 3)}
    assert {float(s) for s in sums} == {sum(cents) / 100} and len(sums) == 1


def test_week_labels_around_new_year(spark):
    days = [dt.date(2025, 12, 28), dt.date(2025, 12, 29), dt.date(2026, 1, 1), dt.date(2026, 1, 4), dt.date(2027, 1, 1)]
    assert column(spark, days, "date", calendar.iso_week_label("v")) == [
        "2025-W52", "2026-W01", "2026-W01", "2026-W01", "2026-W53",
    ]
    assert column(spark, days, "date", calendar.week_start("v"))[1:4] == [dt.date(2025, 12, 29)] * 3


def test_month_and_epoch_keys(spark):
    days = [dt.date(1970, 1, 2), dt.date(2024, 2, 29)]
    assert column(spark, days, "date", calendar.epoch_day("v")) == [1, 19782]
    assert column(spark, days, "date", calendar.month_start("v")) == [dt.date(1970, 1, 1), dt.date(2024, 2, 1)]
    assert column(spark, days, "date", calendar.month_label("v")) == ["1970-01", "2024-02"]


def test_lenient_parsing(spark):
    texts = ["12.5", " 7 ", "n/a", "", None, "NaN"]
    assert column(spark, texts, "string", lenient.lenient_number("v")) == [12.5, 7.0, None, None, None, None]
    assert column(spark, texts, "string", lenient.number_or_zero("v")) == [12.5, 7.0, 0.0, 0.0, 0.0, 0.0]
    whole = ["10", "10.0", "1e3", "-7.9", "9007199254740993", "99999999999999999999", "x"]
    assert column(spark, whole, "string", lenient.lenient_number("v", "bigint")) == [
        10, 10, 1000, -7, 9007199254740993, None, None,
    ]
    dates = ["2010-07-16", "2010-13-16", "", None, "soon"]
    assert column(spark, dates, "string", lenient.lenient_date("v")) == [dt.date(2010, 7, 16), None, None, None, None]
    assert column(spark, ["", "a"], "string", lenient.blank_to_null("v")) == [None, "a"]


def test_money_labels(spark):
    amounts = [1.25e9, 999_999_999.0, 160e6, 2.5e6, 3.5e6, 12345.0, 0.4, 0.0, -5.0, None, 1.5e12]
    assert column(spark, amounts, "double", labels.money_label("v")) == [
        "$1.2B", "$1000M", "$160M", "$2M", "$4M", "$12,345", "$0", "N/A", "N/A", "N/A", "$1500.0B",
    ]
    assert column(spark, [1.25e9, 5e5], "double", labels.money_label("v", billions=False)) == ["$1250M", "$500,000"]


def test_stars(spark):
    scores = [8.4, 9.0, 10.0, 0.0, None, 0.9, 1.0]
    assert column(spark, scores, "double", labels.star_rating("v")) == [
        "★★★★☆", "★★★★½", "★★★★★", "☆☆☆☆☆", "☆☆☆☆☆", "☆☆☆☆☆", "½☆☆☆☆",
    ]


def test_direction_and_size(spark):
    assert column(spark, [2, -1, 0, None], "int", labels.trend_arrow("v")) == ["↑", "↓", "→", "→"]
    assert column(spark, [2, -1, 0, None], "int", labels.trend_class("v"))[:3] == [
        "trend-up", "trend-down", "trend-neutral",
    ]
    assert column(spark, [-1234567], "int", labels.thousands_label("v")) == ["-1,234,567"]
    assert column(spark, [-3], "int", labels.magnitude("v")) == [3]
    assert column(spark, [0.0, 100.0, -900.0], "double", labels.bubble_size("v")) == [8.0, 18.0, 30.0]


def test_image_urls(spark):
    url = labels.image_url("v", "https://img.example.org", "w500")
    assert column(spark, ["/a.jpg", "", None], "string", url) == ["https://img.example.org/w500/a.jpg", "", ""]


@pytest.mark.parametrize(
    "ids, names",
    [([28, 878, 12], ["Action", "Adventure", "Science Fiction"]), ([28, 28, -1, None], ["Action"]), ([], []), (None, [])],
)
def test_genre_names(spark, ids, names):
    assert column(spark, [ids], "array<int>", genre_names("v")) == [names]
