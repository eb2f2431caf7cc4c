"""Typed telemetry with malformed payloads, and consolidation rows with every defect."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

from opsgrain.plans import items_quality as IQ
from opsgrain.plans import measures as M
from opsgrain.plans import quality as Q
from opsgrain.sources import staging as S
from opsgrain.sources.optional import OptionalSources, optional

METRICS = "SourceDatabase string, SourceTable string, SourcePriority int, SourcePrimaryKey long, DataDescription string, JsonData string, EventTimestamp timestamp"


def test_malformed_payloads_keep_their_rows(spark):
    at = dt.datetime(2026, 1, 1)
    payloads = ['{"User":"u1","LocationPrimaryKey":"3","Quantity":4}', '{"User":"u1"', "", None, '[1,2]', '"text"', '{"User":{"a":1},"LocationPrimaryKey":"x","Quantity":[1]}',
                '{"User":null,"LocationPrimaryKey":9007199254740993}', "{}"]
    rows = [("db1", "T", 1, k, "Pick", p, at) for k, p in enumerate(payloads)]
    got = {r.PrimaryKey: (r.User, r.LocationPrimaryKey, r.Quantity, r.Malformed) for r in S.typed_telemetry(spark.createDataFrame(rows, METRICS)).collect()}
    assert got == {0: ("u1", 3, 4, False), 1: (None, None, None, True), 2: (None, None, None, True), 3: (None, None, None, False), 4: (None, None, None, True), 5: (None, None, None, True),
                   6: (None, None, None, False), 7: (None, 9007199254740993, None, False), 8: (None, None, None, False)}


def test_sessions_of_malformed_telemetry(spark):
    at = dt.datetime(2026, 1, 1, 8)
    js = '{"User":"u1","LocationPrimaryKey":"3"}'
    rows = [("db1", "T", 1, 1, "Pick-SignIn", js, at), ("db1", "T", 1, 2, "Pick-SignIn", '{"User":"u1"', at), ("db2", "T", 2, 3, "Pick-SignOut", js, at + dt.timedelta(hours=1)),
            ("db1", "T", 1, 4, "PutAway-SignOut", js, at + dt.timedelta(hours=2)), ("db1", "T", 1, 5, "Pick", js, at)]
    got = S.raw_work_sessions(spark.createDataFrame(rows, METRICS)).collect()
    assert [(r.WorkType, r.SignInSourcePrimaryKey, r.SignOutSourcePrimaryKey, r.SessionMs, r.SignOutSourceDatabase) for r in got] == [("Pick", 1, 3, 3_600_000, "db2")]


ROWS = [("A", "Small", 10, 2, 30), (None, "Small", 1, 1, 1), ("B", "", 1, 1, 1), ("C", "Small", None, 1, 1), ("D", "Small", 5, None, 2), ("E", "Small", 5, 1, None),
        ("F", "Small", -1, 1, 9), ("G", "Small", 4, 1, -4), ("H", "Small", -5, 1, 2), ("I", "Small", 3, -1, 1), ("A", "Small", 10, 2, 30)]


def test_every_defect_of_a_consolidation_row(spark):
    columns = "Sku string, CompartmentSizeName string, Quantity long, TotalCompartments long, TotalUnrealizedCapacity long"
    df = spark.createDataFrame(ROWS, columns)
    wrong = {(r.Sku, r.Quantity): set(r.wrong) for r in Q.with_defects(df).collect()}
    assert wrong == {("A", 10): set(), (None, 1): {"label"}, ("B", 1): {"label"}, ("C", None): {"label"}, ("D", 5): {"capacity"}, ("E", 5): {"capacity"}, ("F", -1): {"negative", "scale"},
                     ("G", 4): {"negative", "denominator"}, ("H", -5): {"negative", "denominator", "scale"}, ("I", 3): {"negative"}}
    for rows in (ROWS, ROWS[:1], ROWS[4:6], []):
        df = spark.createDataFrame(rows, columns)
        con = duckdb.connect()
        con.execute("create table defrag_detail (Sku varchar, CompartmentSizeName varchar, Quantity bigint, TotalCompartments bigint, TotalUnrealizedCapacity bigint)")
        if rows:
            con.executemany("insert into defrag_detail values (?, ?, ?, ?, ?)", rows)
        want = con.execute(IQ.Q34_SQL)
        names = [d[0] for d in want.description]
        want = dict(zip(names, want.fetchone(), strict=True))
        got = Q.visible_consolidation(df, df).first().asDict()
        for c in ("SourceRows", "ReportRows", "Status", "Details"):
            assert got[c] == want[c], (c, len(rows))


def test_inventory_records_of_payloads(spark):
    at = dt.datetime(2026, 1, 1)
    payloads = ['{"InventoryRecords":[{"InventoryStatus":"Pending","ProductQuantity":3},{"ProductQuantity":2},null]}', '{"InventoryRecords":[]}', '{"ContainerBarcode":"C1"}', "{broken", None,
                '{"InventoryRecords":[{"InventoryStatus":"Available","ProductQuantity":0},{"InventoryStatus":"Available","ProductQuantity":null},{"InventoryStatus":null,"ProductQuantity":7}]}']
    df = spark.createDataFrame([(k, at, p) for k, p in enumerate(payloads)], "PrimaryKey long, TimeStamp timestamp, JsonData string")
    records = S.inventory_records(df)
    assert sorted((r.CloseBinPrimaryKey, r.Position, r.InventoryStatus, r.ProductQuantity) for r in records.collect()) == [
        (0, 0, "Pending", 3), (0, 1, None, 2), (0, 2, None, None), (5, 0, "Available", 0), (5, 1, "Available", None), (5, 2, None, 7)]

    class Model:
        by = ()
        close_bin_records = records

    assert M.num_bins_occupied(Model()).first()[0] == 2
    Model.close_bin_records = records.limit(0)
    assert M.num_bins_occupied(Model()).first()[0] == 0


def test_optional_sources(spark, tmp_path):
    schema = spark.createDataFrame([], "PrimaryKey long, JsonData string").schema
    spark.createDataFrame([(1, "x")], "PrimaryKey int, Other string").write.parquet(str(tmp_path / "there"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"no parquet")
    found = OptionalSources(spark, {"there": str(tmp_path / "there"), "absent": str(tmp_path / "absent")}, schema)
    assert [tuple(r) for r in found.status().collect()] == [("there", True, 1), ("absent", False, 0)]
    assert [tuple(r) for r in found.tables["there"].collect()] == [(1, None)] and found.tables["absent"].schema == schema
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        optional(spark, str(tmp_path / "broken"), schema).collect()


def test_open_work_and_kpi_sources_shuffle_no_more_than_they_need(spark, monkeypatch):
    """Both cycle-count series come from one join, keys of other series are not
    compared, and a week's containers meet their lines and tasks by broadcast."""
    from opsgrain.plans import pages as P
    from opsgrain.plans.items_pages import AS_OF_DATE, daily_of, open_rows_of
    from opsgrain.sources.adapter import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    rows = open_rows_of(t)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 2
    twice = spark.createDataFrame([("Orders Cycle Count", dt.datetime(2024, 1, 1), k) for k in (7, 7, None, 8)] + [("Lines Put", dt.datetime(2024, 1, 2), k) for k in (5, 5, None)],
                                  "MetricName string, LastUpdatedDate timestamp, ItemKey bigint")
    assert {r["MetricName"]: r["SourceRows"] for r in P.open_work(twice).collect()} == {"Orders Cycle Count": 2, "Lines Put": 3}
    assert {r["MetricName"]: r["OpenWork"] for r in P.open_work_trend(twice).collect()} == {"Orders Cycle Count": 2, "Lines Put": 3}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = Q.visible_kpi_expected(t, daily_of(t), AS_OF_DATE)
        assert small._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") >= 3
        got = sorted(map(str, small.collect()))
        monkeypatch.setattr(Q, "KEY_ROWS", 0)
        assert sorted(map(str, Q.visible_kpi_expected(t, daily_of(t), AS_OF_DATE).collect())) == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
