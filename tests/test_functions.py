import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (convert_currency, parse_count_text, parse_date, parse_flag, parse_list,
                              parse_percent, parse_price, safe_ratio, valid_email, year_of)


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_parse_price(spark):
    assert _one(spark, ["$1,234.50", "$0.00", "", None, "abc"], parse_price) == [1234.5, 0.0, None, None, None]


def test_parse_percent(spark):
    assert _one(spark, ["93%", "100%", "N/A", None, "5"], parse_percent) == [93.0, 100.0, None, None, 5.0]


def test_parse_bathrooms(spark):
    got = _one(spark, ["Half-bath", " 1.5 baths", "Shared half-bath", "Private bath", "", None, "2 baths"],
               parse_count_text)
    assert got == [0.5, 1.5, 0.5, None, None, None, 2.0]


def test_parse_flag_both_null_modes(spark):
    vals = ["t", "f", "T", "", None]
    assert _one(spark, vals, parse_flag) == [True, False, False, False, None]
    assert _one(spark, vals, lambda c: parse_flag(c, null_as_false=True)) == [True, False, False, False, False]


def test_parse_date(spark):
    got = _one(spark, ["2015-02-11T00:00:00Z", "2015-02-11", "01-Jan-2014", "11/02/2015", None], parse_date)
    assert got == [dt.date(2015, 2, 11), dt.date(2015, 2, 11), None, None, None]
    assert _one(spark, ["2019-05-01", "junk", None], year_of) == [2019, None, None]


def test_parse_list(spark):
    vals = ['["Wifi", "Hot tub"]', "[]", '["a, b"]', None]
    assert _one(spark, vals, parse_list) == [["Wifi", "Hot tub"], [], ["a", "b"], None]
    # trim_items=False reproduces the reference's leading spaces
    assert _one(spark, vals[:1], lambda c: parse_list(c, trim_items=False)) == [["Wifi", " Hot tub"]]
    # a plain split turns "[]" into one empty item
    assert _one(spark, ["[]"], lambda c: parse_list(c, trim_items=False, empty_as_empty=False)) == [[""]]


def test_valid_email(spark):
    got = _one(spark, ["a.b@c.org", "a@b", "@c.org", "a@b.c", None], valid_email)
    assert got == [True, False, False, False, False]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(3, 4), (0, 4), (3, 0), (None, 4)], "a int, b int")
    got = [r[0] for r in df.select(safe_ratio("a", "b")).collect()]
    assert got == [0.75, 0.0, None, None]


def test_convert_currency(spark):
    df = spark.createDataFrame([("London", 100.0), ("Tokyo", 1000.0), ("Tokyo", 0.0), ("Paris", 5.0),
                                ("London", None)], "area string, price double")
    got = [r[0] for r in df.select(convert_currency("price", "area", {"London": 0.5, "Tokyo": 0.01})).collect()]
    assert got == [50.0, 10.0, 0.0, 5.0, None]
