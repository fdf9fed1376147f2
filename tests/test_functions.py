import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidecart.functions import dates, features, parsing


def test_parse_number(column_of):
    texts = ["$1,234.56", "USD 12", "(5)", "1e5", "1-2", "1.2.3", "5.", ".5", "-", " N/A ", "none", "", None, "-3.5", "."]
    assert column_of(parsing.parse_number, texts) == [
        1234.56, 12.0, 5.0, 15.0, None, None, 5.0, 0.5, None, None, None, None, None, -3.5, None]


def test_parse_money(column_of):
    texts = ["$1,234.56", "12 USD", "1e5", "€5", " £7.5 ", "NA", "null", "", None, "1d", "nan", "1_000", "(5)", "+3.",
             "\xa05", "1__0", "_1", "1 2", "-.5e-1", "Infinity", ".", "1_0.2_5", "5\u2003", "1e5f"]
    assert column_of(parsing.parse_money, texts) == [
        1234.56, None, 100000.0, 5.0, 7.5, None, None, None, None, None, None, 1000.0, None, 3.0,
        5.0, None, None, None, -0.05, float("inf"), None, 10.25, 5.0, None]


def test_clean_text(column_of):
    texts = ["NA", " NA ", "--é!", "²", "!?...", "a  \n b", None, "null", "x_", "  (Hello,   World)  ", "a!!b!!"]
    assert column_of(parsing.clean_text, texts) == [
        "Unknown", "NA", "é", "²", "Unknown", "a b", "Unknown", "Unknown", "x_", "Hello, World", "a!!b"]


def test_clean_text_matches_the_plain_rule(column_of):
    import re

    samples = ["".join(p) for p in
               [("  ", "«é", " ", "x»", "."), ("\x1c", "a"), ("́a", "́"), ("_", "-"), ("9", "୲", "!")]]
    want = []
    for s in samples:
        t = re.sub(r"\s+", " ", s.strip())
        want.append(re.sub(r"^\W+|\W+$", "", t) or "Unknown")
    assert column_of(parsing.clean_text, samples) == want


def test_flags(column_of):
    texts = ["true", "True", "TRUE", "t", "T", "1", "false", "0", "yes", "", "tRuE", None]
    assert column_of(parsing.parse_flag, texts) == [True] * 6 + [False] * 6


def test_discount(column_of):
    assert column_of(parsing.parse_discount, ["$12.34", "5", None]) == [12.34, 5.0, None]
    assert column_of(lambda c: parsing.parse_discount(c, "null"), ["1,200", "$3"]) == [None, 3.0]
    with pytest.raises(PySparkException):
        column_of(parsing.parse_discount, ["1,200"])


def test_null_markers(column_of):
    assert column_of(parsing.null_markers_to_null, ["", "NA", "nan", "Na", " NA", "x"]) == [
        None, None, None, "Na", " NA", "x"]


def test_mojibake_and_cp1252(column_of):
    broken = "Müller €".encode().decode("latin-1")
    assert column_of(parsing.repair_mojibake, [broken, "plain", "ÿ"]) == ["Müller €", "plain", "�"]
    assert column_of(parsing.latin1_to_cp1252, ["\u0080 \u0093x\u0094 é"]) == ["€ “x” é"]


def test_zoned_timestamps(column_of):
    texts = ["2019-03-01 23:30:00 -0500", "2019-03-01 10:20:30 +05:30", "2019-03-03 01:00:00 +0000",
             "2019-03-01 10:20:30", "junk", None, "2019-02-30 10:00:00 +0000", "2019-03-01 10:20:30 Z"]
    seconds = column_of(lambda c: F.unix_seconds(dates.parse_zoned_timestamp(c)), texts)
    def at(*a):
        return int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp())
    assert seconds == [at(2019, 3, 2, 4, 30), at(2019, 3, 1, 4, 50, 30), at(2019, 3, 3, 1), None, None, None, None,
                       at(2019, 3, 1, 10, 20, 30)]
    days = column_of(lambda c: F.struct(*dates.crawl_parts(dates.zoned_wall_clock(c)).values()), texts[:3] + texts[4:5])
    assert [tuple(d) for d in days] == [(2019, 3, 1, 4), (2019, 3, 1, 4), (2019, 3, 3, 6), (None,) * 4]


def test_any_timestamp(column_of):
    texts = ["2019-03-01 23:30:00 -0500", "2019-03-01", "2019-03-01T10:00:00", "junk"]
    days = column_of(lambda c: F.dayofmonth(dates.any_wall_clock(c)), texts)
    assert days == [1, 1, 1, None]
    assert [v is not None for v in column_of(dates.parse_any_timestamp, texts)] == [True, True, True, False]


def test_short_dates(column_of):
    texts = ["01-05-69", "12-31-68", "1-5-24", "13-01-20", "", "2024-01-05", "02-29-72", "02-29-71", None]
    assert column_of(dates.parse_short_date, texts) == [
        dt.date(1969, 1, 5), dt.date(2068, 12, 31), dt.date(2024, 1, 5), None, None, None,
        dt.date(1972, 2, 29), None, None]
    names = column_of(lambda c: dates.purchase_parts(dates.parse_short_date(c))["DayOfWeek"], ["01-05-69", "x"])
    assert names == ["Sunday", None]


def test_buckets(column_of):
    prices = [-1.0, 0.0, 0.01, 50.0, 50.01, 100.0, 200.0, 500.0, 500.01, None]
    assert column_of(features.price_range, prices, "double") == [
        None, None, "Budget", "Budget", "Mid", "Mid", "Premium", "High-end", "Luxury", None]
    ratings = [0.0, 2.0, 2.5, 4.0, 5.0, 5.1, None]
    assert column_of(features.rating_quality, ratings, "double") == [
        None, "Poor", "Fair", "Good", "Excellent", None, None]
    rank = lambda c: features.bucket_rank(features.price_range(c), features.PRICE_LABELS)
    assert column_of(rank, [10.0, 1000.0, -1.0], "double") == [0, 4, None]


def test_small_features(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (0.0, -1.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    rows = df.select(features.total_of([a, b]), features.positive_flag(a), features.review_density(a, b),
                     features.price_per_rating(a, b), features.clip(a, F.lit(0.5), F.lit(0.7))).collect()
    assert tuple(rows[0]) == (3.0, 1, 1 / 3, 1 / 2.1, 0.7)
    assert tuple(rows[1]) == (None, 0, None, None, None)
    assert rows[2][0] == -1.0 and rows[2][2] is None and rows[2][4] == 0.5


def test_offer_price(column_of, spark):
    texts = ["{'offer_price': 9.5, 'min_price': 3}", "{'offer_price': 0, 'min_price': 3.0}",
             "{'offer_price': None, 'min_price': 4.5, 'sale': True}", "{'min_price': 2}", "{}", "[1, 2]", "junk", None,
             "{'offer_id': 'None', 'offer_price': 7.25, 'currency': '$'}"]
    assert column_of(features.offer_price_from_text, texts) == [9.5, 3.0, 4.5, 2.0, None, None, None, None, 7.25]
    df = spark.createDataFrame([((0.0, 5.0),), ((2.0, 1.0),), ((None, None),)],
                               "offer struct<offer_price:double,min_price:double>")
    assert [r[0] for r in df.select(features.offer_price(F.col("offer"))).collect()] == [5.0, 2.0, None]
