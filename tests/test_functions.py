import hashlib

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from lakeloom.functions import exact, text, times


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_weekday_conventions(spark):
    sunday, monday = F.lit("2018-11-25").cast("date"), F.lit("2018-11-26").cast("date")
    for style, expected in times.WEEKDAY_STYLES.items():
        assert tuple(one(spark, times.weekday(sunday, style), times.weekday(monday, style))) == expected
    with pytest.raises(ValueError):
        times.weekday(sunday, "other")


def test_epoch(spark):
    ms = F.lit(1541121934796)
    got = one(
        spark, times.epoch_seconds(ms).cast("string"), times.epoch_millis(ms).cast("string"), times.epoch_date(ms).cast("string")
    )
    assert tuple(got) == ("2018-11-02 01:25:34", "2018-11-02 01:25:34.796", "2018-11-02")
    assert one(spark, F.hour(times.epoch_millis(ms)))[0] == 1
    assert one(spark, times.epoch_seconds(F.lit(-1)).cast("string"))[0] == "1969-12-31 23:59:59"


def test_year_filter_reaches_the_scan(tables):
    assert "GreaterThanOrEqual(o_orderdate" in plan_text(tables.orders.where(times.in_year(F.col("o_orderdate"), 1997)))


def test_month_filter(tables):
    december = tables.orders.where(times.in_month(F.col("o_orderdate"), 1997, 12))
    assert december.count() == tables.orders.where("year(o_orderdate) = 1997 and month(o_orderdate) = 12").count()


def test_texts(spark):
    assert one(spark, text.full_name(F.lit("Ann"), F.lit(None), F.lit("Lee")))[0] == "Ann Lee"
    assert one(spark, text.integer_or_null(F.lit("-")))[0] is None
    assert one(spark, text.zero_for_dash(F.lit("-")))[0] == "0"
    assert one(spark, text.text_key(F.lit("a"), F.lit("b")))[0] == hashlib.md5(b"a|b").hexdigest()


def test_exact_sums(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("v"), (-F.col("id") / 100).alias("w"))
    assert df.agg(exact.total("v", 2)).first()[0] == 100.0
    assert df.agg(exact.total("w", 2)).first()[0] == -4995.0
    assert df.agg(exact.mean("v", 2)).first()[0] == 0.1
    assert str(one(spark, exact.amount(F.lit(218.5), 0))[0]) == "219"


def test_exact_sums_lose_nothing(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert small.agg(exact.total("v", 3)).first()[0] == 4.0
    with pytest.raises(Exception, match="more than 2 digits"):
        small.agg(exact.total("v", 2)).collect()
    odd = spark.createDataFrame([(float("nan"), 1.0), (1.0, float("inf")), (None, 2.0)], "v double, w double")
    nan, inf = odd.agg(exact.total("v", 2), exact.total("w", 2)).first()
    assert nan != nan and inf == float("inf")
    assert spark.range(0).select(F.lit(1.0).alias("v")).agg(exact.total("v", 2)).first()[0] is None


def test_one_rounding_rule(spark):
    for value in (0.285, -0.125, 2.675, -0.005, 1e12 + 0.25):
        cents = F.round(F.lit(value), 2)
        assert one(spark, exact.amount(cents))[0] * 100 == one(spark, exact.units(cents, 2))[0]
    assert str(one(spark, exact.amount(F.lit(-0.125)))[0]) == "-0.13"


def test_keys_of_parts_that_hold_the_separator(spark):
    key = lambda *parts: one(spark, text.text_key(*map(F.lit, parts)))[0]
    assert len({key("a|b", "c"), key("a", "b|c"), key("a", "b", "c"), key("a\\", "b|c"), key("a\\|b", "c")}) == 5
    assert key("\\N", "x") != key(None, "x")
