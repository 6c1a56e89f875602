import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmart import functions as fn


def evaluate(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_trending_date(spark):
    raw = ["69.01.01", "70.01.01", "18.30.02", "18.1.01", "2018-01-01", "17.14.11\n", None, "17.14.11", "00.29.02"]
    got = evaluate(spark, raw, fn.parse_trending_date)
    assert got == [
        dt.date(2069, 1, 1), dt.date(1970, 1, 1), None, None, None, None, None, dt.date(2017, 11, 14),
        dt.date(2000, 2, 29),
    ]


def test_publish_time(spark):
    raw = [
        "2017-11-13T10:20:00.1Z", "2017-11-13T10:20:00.123456Z", "2017-11-13T10:20:00Z",
        "2017-11-13T10:20:00.123456789Z", "", "garbage", None, " 2017-1-3T1:2:3.000Z", "2017-02-30T00:00:00.0Z",
        "2017-11-13T10:20:00.1Z\n", "2017-11-13T25:20:00.1Z",
    ]
    at = lambda us: dt.datetime(2017, 11, 13, 10, 20, 0, us)
    assert evaluate(spark, raw, fn.parse_publish_time) == [
        at(100000), at(123456), None, None, None, None, None, dt.datetime(2017, 1, 3, 1, 2, 3), None, None, None
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_publish_time_ignores_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:  # 02:30 does not exist in New York on that day
        got = evaluate(spark, ["2018-03-11T02:30:00.5Z"], fn.parse_publish_time)
        assert got == [dt.datetime(2018, 3, 11, 2, 30, 0, 500000)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_profile_publish_time(spark):
    raw = ["2017-11-13T10:00:00Z", "2017-11-13T10:00:00.12Z", "2017-1-3T10:00:00Z", "2017-11-13T10:00:00.1234567Z", ""]
    got = evaluate(spark, raw, fn.profile_publish_time)
    assert got == [dt.datetime(2017, 11, 13, 10), dt.datetime(2017, 11, 13, 10, 0, 0, 120000), None, None, None]


def test_booleans(spark):
    raw = [" TRUE ", "t", "1", "F", "0", "false", "yes", "", None, "\ttrue"]
    assert evaluate(spark, raw, fn.normalize_boolean) == [True] * 3 + [False] * 3 + [None] * 4
    raw = ["True", "true", "TRUE", "False", " true", "t", "1", None]
    assert evaluate(spark, raw, fn.profile_boolean) == [True] * 3 + [False] + [None] * 4


def test_tags(spark):
    raw = ['"a"||"b"', "a|b|", " [None] ", "   ", '""', None, "", "x", "|a", "[NONE]", "a|||b||c"]
    assert evaluate(spark, raw, fn.normalize_tags) == [
        "a|b", "a|b|", None, None, "", None, None, "x", "|a", None, "a|b|c"
    ]
    assert evaluate(spark, raw, fn.tag_count) == [2, 3, 0, 0, 1, 0, 0, 1, 2, 0, 3]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (None, 2), (1, None), (0, 5), (1, 4)], "a bigint, b bigint")
    assert [r[0] for r in df.select(fn.safe_divide(F.col("a"), F.col("b"))).collect()] == [None, None, None, 0.0, 0.25]


def test_validity(spark):
    rows = [(None, None, 5), (None, None, 0), (None, None, None), (None, True, 5), (True, False, 5), (False, False, 1)]
    df = spark.createDataFrame(rows, "video_error_or_removed boolean, ratings_disabled boolean, views bigint")
    got = [r[0] for r in df.select(fn.has_valid_engagement()).collect()]
    assert got == [True, False, False, False, False, True]


def test_rates_are_computed_on_invalid_rows(spark):
    df = spark.createDataFrame([(10, 1, 2, None)], "views bigint, likes bigint, dislikes bigint, comment_count bigint")
    row = df.select(*[c.alias(n) for n, c in fn.engagement_rates().items()]).first()
    assert (row.like_rate, row.dislike_rate, row.comment_rate, row.engagement_rate) == (0.1, 0.2, None, None)


def test_days_between(spark):
    df = spark.sql("select timestamp_ntz'2018-01-02 23:59:59' a, date'2018-01-01' b")
    assert df.select(fn.days_between(F.col("a"), F.col("b"))).first()[0] == -1


def test_surrogate_key(spark):
    import hashlib

    df = spark.createDataFrame([("CA", None, 5)], "a string, b string, c int")
    got = df.select(fn.surrogate_key("a", "b", "c")).first()[0]
    assert got == hashlib.md5(b"CA-_dbt_utils_surrogate_key_null_-5").hexdigest()


def test_profile_integer(spark):
    assert evaluate(spark, ["5", "-3", "", "x", "1.5", None], fn.profile_integer) == [5, -3, None, None, None, None]
