"""Items that run on generated or fixed dimension tables only (tested here,
not registered as queries): P38 calendar, S10 template names, S08 / M95 port
sort, P39 date hierarchy edge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from opsgrain.plans import measures as M
from opsgrain.plans import pages as P
from opsgrain.sources import staging as S


def test_calendar_p38(spark):
    cal = P.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 10))
    rows = {r.Date: r for r in cal.collect()}
    assert len(rows) == 10
    r = rows[dt.date(2024, 1, 7)]                     # a Sunday: week 2 under WEEKNUM(d, 1)
    assert (r.day, r.week, r.month, r.year, r.quarter) == (7, 2, 1, 2024, 1)
    assert (r.yearMonth, r.yearQuarter, r.yearweek) == ("2024/01", "2024/Q1", "2024/Week2")
    assert (r.yearNow, r.years, r.upcoming, r.DateOnly) == (1, "Current year", "0", dt.date(2024, 1, 7))


def test_template_names_s10(spark):
    tmpl = spark.createDataFrame([(1, "Autostore 1/8", True), (2, "Autostore 2/8", True), (3, "Plain", False), (4, "", True)],
                                 "PrimaryKey bigint, TemplateName string, IsGoodsToPerson boolean")
    comps = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (2, 11), (4, 11)], "TemplatePrimaryKey bigint, CompartmentSizePrimaryKey bigint")
    sizes = spark.createDataFrame([(10, "Small"), (11, "Medium")], "PrimaryKey bigint, Name string")
    out = {r.PrimaryKey: (r.CompartmentName, r.CombinedName) for r in S.template_names(tmpl, comps, sizes).collect()}
    assert out[1] == ("Small", "Small (1/8)")
    assert out[2] == (None, " (2/8)")        # several sizes: the single-value lookup fails -> blank name
    assert out[3] == (None, None)            # not goods-to-person
    assert out[4] == ("Medium", "Medium ()")


def test_port_sort_forms(spark):
    df = spark.createDataFrame([("P4",), ("P12",), ("No Data",), ("X",), (None,)], "Ports string")
    got = [tuple(r) for r in df.select(S.port_sort(F.col("Ports")), M.older_port_sort(F.col("Ports"))).collect()]
    assert got == [(4, 4.0), (12, 12.0), (999999, -1.0), (999999, None), (999999, None)]


def test_hour_label_and_sort(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 30),), (dt.datetime(2024, 1, 1, 13, 0),)], "t timestamp")
    got = [tuple(r) for r in S.hour_columns(df, "t").select("Hour", "HourSort").collect()]
    assert got == [("12 AM", 0), ("1 PM", 13)]
