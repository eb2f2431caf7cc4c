"""D-rows of SURVEY §1.5 and the clock parser (fixture F5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from opsgrain.functions import tsql


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("v")).collect()]


def test_concat_treats_null_as_empty(spark):
    out = one(spark, tsql.concat_text(F.col("a"), F.lit("|"), F.col("b")), [(1, None), (None, 2)], "a bigint, b bigint")
    assert out == ["1|", "|2"]


def test_ms_between_counts_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0, 999900), dt.datetime(2024, 1, 1, 0, 0, 1, 0))]
    assert one(spark, tsql.ms_between("a", "b"), rows, "a timestamp, b timestamp") == [1]
    assert one(spark, tsql.seconds_between("a", "b"), rows, "a timestamp, b timestamp") == [1]


def test_format_n_rounds_half_away(spark):
    out = one(spark, tsql.format_n(F.col("x"), 2), [(0.125,), (2.345,)], "x double")
    assert out == ["0.13", "2.35"]
    assert one(spark, tsql.format_n(F.col("x"), 0), [(1234567.0,)], "x double") == ["1,234,567"]


def test_hour_label(spark):
    rows = [(dt.datetime(2024, 1, 1, 13, 5),), (dt.datetime(2024, 1, 1, 0, 5),)]
    assert one(spark, tsql.hour_label("t"), rows, "t timestamp") == ["1 PM", "12 AM"]


def test_json_value_scalars_only(spark):
    rows = [('{"User":"a","o":{"x":1},"l":[1]}',)]
    df = spark.createDataFrame(rows, "j string")
    r = df.select(tsql.json_value("j", "$.User"), tsql.json_value("j", "$.o"), tsql.json_value("j", "$.l")).first()
    assert tuple(r) == ("a", None, None)


def test_weeknum_sunday(spark):
    days = [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2023, 1, 1),)]
    assert one(spark, tsql.weeknum_sunday("d"), days, "d date") == [1, 1, 2, 1]


def test_clock_ms_fixture_f5(spark):
    rows = [("00:00:12.500",), ("12:30",), ("bad",), (None,), ("25:00:00",), ("23:59:59.9999999",)]
    out = one(spark, tsql.clock_ms("c"), rows, "c string")
    assert out == [12500, 45000000, None, None, None, 86399999]


def test_divide_blank_on_zero(spark):
    assert one(spark, tsql.divide("a", "b"), [(1, 0), (4, 2)], "a bigint, b bigint") == [None, 2.0]
