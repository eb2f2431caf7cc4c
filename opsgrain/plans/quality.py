"""Coverage, reconciliation and gates (Q items) as DataFrames.

Gates are one-row aggregates; several one-row results are placed side by side
with scalar subqueries (``functions.frames.beside``), never with a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain.functions.frames import beside, broadcast_if_small
from opsgrain.sources.staging import EVENT_DESCRIPTIONS


def _one_row_join(*dfs: DataFrame) -> DataFrame:
    """One-row aggregates side by side (scalar subqueries, no join)."""
    return beside(*dfs)


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


# ---- Q01-Q04 (v1 diagnostics) -------------------------------------------------------------

def coverage(t) -> DataFrame:
    """Q01: rows / with user / with port / with timestamp / bounds for the six v1 sources."""
    def part(name, df, ts, user=None, port=None):
        return df.agg(
            F.lit(name).alias("SourceName"), F.count(F.lit(1)).alias("TotalRows"),
            (_cnt(F.col(user).isNotNull()) if user else F.lit(None).cast("bigint")).alias("RowsWithUser"),
            (_cnt(F.col(port).isNotNull()) if port else F.lit(None).cast("bigint")).alias("RowsWithPort"),
            _cnt(F.col(ts).isNotNull()).alias("RowsWithTimestamp"),
            F.min(ts).alias("MinTimestamp"), F.max(ts).alias("MaxTimestamp"))
    pick_in = t.sign_in.filter(F.col("WorkType") == "Pick")
    pick_out = t.sign_out.filter(F.col("WorkType") == "Pick")
    done = t.status_history.filter(F.col("Status") == "Completed")
    parts = [
        part("Pick", t.pick, "TimeStamp", "UserName", "LocationBarcode"),
        part("BinPresented", t.bin_presented, "TimeStamp", None, "LocationBarcode"),
        part("CloseBin", t.close_bin, "TimeStamp", None, "LocationBarcode"),
        part("Pick-SignIn", pick_in, "TimeStamp", "UserName", "LocationPrimaryKey"),
        part("Pick-SignOut", pick_out, "TimeStamp", "UserName", "LocationPrimaryKey"),
        part("FulfillmentOrderStatusHistory Completed", done, "StatusDate", "UserName", None),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def coverage_by_task_type(bin_presented: DataFrame) -> DataFrame:
    """Q02."""
    return bin_presented.groupBy(F.coalesce(F.col("LocationTaskType"), F.lit("(NULL)")).alias("LocationTaskType")).agg(
        F.count(F.lit(1)).alias("Rows"), _cnt(F.col("LocationBarcode").isNotNull()).alias("RowsWithPort"),
        F.min("TimeStamp").alias("MinTimestamp"), F.max("TimeStamp").alias("MaxTimestamp"))


def event_diagnostics(ev1: DataFrame) -> DataFrame:
    """Q03: v1 events by type and attribution."""
    return ev1.groupBy("EventType", "AttributionMethod").agg(
        F.count(F.lit(1)).alias("EventRows"), _cnt(F.col("UserName").isNotNull()).alias("RowsWithUser"),
        _cnt(F.col("Port").isNotNull()).alias("RowsWithPort"), _cnt(F.col("DurationSeconds").isNotNull()).alias("RowsWithDuration"),
        F.min("StartTime").alias("MinStartTime"), F.max("StartTime").alias("MaxStartTime"))


def report_data_diagnostics(report_data: DataFrame) -> DataFrame:
    """Q04."""
    return report_data.groupBy(F.coalesce(F.col("DataDescription"), F.lit("(NULL)")).alias("DataDescription")).agg(
        F.count(F.lit(1)).alias("Rows"), F.min("PrimaryKey").alias("MinPrimaryKey"), F.max("PrimaryKey").alias("MaxPrimaryKey"),
        F.min("TimeStamp").alias("MinTimestamp"), F.max("TimeStamp").alias("MaxTimestamp"),
        F.min("BatchId").alias("MinBatchId"), F.max("BatchId").alias("MaxBatchId"))


# ---- Q05-Q09, Q14, Q42 (raw telemetry) -------------------------------------------------------

def source_diagnostics(sources: DataFrame) -> DataFrame:
    """Q05: telemetry coverage per database / table / description."""
    return sources.groupBy("SourceDatabase", "SourceTable", "DataDescription").agg(
        F.count(F.lit(1)).alias("SourceRows"), F.min("SourcePrimaryKey").alias("MinSourcePrimaryKey"),
        F.max("SourcePrimaryKey").alias("MaxSourcePrimaryKey"), F.min("EventTimestamp").alias("MinEventTimestamp"),
        F.max("EventTimestamp").alias("MaxEventTimestamp"))


def dedup_diagnostics(deduped: DataFrame) -> DataFrame:
    """Q06: kept rows and removed copies per description."""
    return deduped.groupBy("DataDescription").agg(
        F.count(F.lit(1)).alias("DedupedRows"), F.sum(F.col("DuplicateSourceRows") - 1).cast("bigint").alias("RemovedDuplicateRows"),
        F.min("EventTimestamp").alias("MinEventTimestamp"), F.max("EventTimestamp").alias("MaxEventTimestamp"))


def raw_event_summary(deduped: DataFrame) -> DataFrame:
    """Q07: JSON field presence per description."""
    from opsgrain.functions.tsql import json_value
    return deduped.groupBy("DataDescription").agg(
        F.count(F.lit(1)).alias("EventRows"), _cnt(json_value("JsonData", "$.User").isNotNull()).alias("RowsWithUser"),
        _cnt(json_value("JsonData", "$.LocationBarcode").isNotNull()).alias("RowsWithPort"),
        F.min("EventTimestamp").alias("MinEventTimestamp"), F.max("EventTimestamp").alias("MaxEventTimestamp"))


def source_coverage(sources: DataFrame) -> DataFrame:
    """The optional-source coverage table (db, table, description, rows, bounds)."""
    return sources.groupBy("SourceDatabase", "SourceTable", "DataDescription").agg(
        F.count(F.lit(1)).alias("Rows"), F.min("SourcePrimaryKey").alias("MinPrimaryKey"),
        F.max("SourcePrimaryKey").alias("MaxPrimaryKey"), F.min("EventTimestamp").alias("MinTimestamp"),
        F.max("EventTimestamp").alias("MaxTimestamp"))


def source_rollup(cov: DataFrame) -> DataFrame:
    """Q08: coverage rolled up per source."""
    return cov.groupBy("SourceDatabase", "SourceTable").agg(
        F.sum("Rows").cast("bigint").alias("Rows"), F.min("MinPrimaryKey").alias("MinPrimaryKey"),
        F.max("MaxPrimaryKey").alias("MaxPrimaryKey"), F.min("MinTimestamp").alias("MinTimestamp"),
        F.max("MaxTimestamp").alias("MaxTimestamp"))


def only_descriptions(df: DataFrame, col: str = "DataDescription") -> DataFrame:
    """Q42: keep the 15 known event kinds."""
    return df.filter(F.col(col).isin(EVENT_DESCRIPTIONS))


def latest_source(cov: DataFrame) -> DataFrame:
    """Q09: per description, the source with the latest timestamp (ties by
    database, table)."""
    best = cov.groupBy("DataDescription").agg(F.min_by(
        F.struct("SourceDatabase", "SourceTable", "Rows", "MinPrimaryKey", "MaxPrimaryKey", "MinTimestamp", "MaxTimestamp"),
        F.struct((-F.unix_micros("MaxTimestamp")).alias("t"), F.col("SourceDatabase"), F.col("SourceTable"))).alias("b"))
    return best.select("DataDescription", F.col("b.SourceDatabase").alias("LatestSourceDatabase"),
                       F.col("b.SourceTable").alias("LatestSourceTable"), "b.Rows", "b.MinPrimaryKey", "b.MaxPrimaryKey",
                       "b.MinTimestamp", "b.MaxTimestamp")


def session_totals(raw_sessions: DataFrame) -> DataFrame:
    """Q14: raw session totals per work type / user / location."""
    return raw_sessions.groupBy("WorkType", "UserName", "LocationPrimaryKey").agg(
        F.count(F.lit(1)).alias("SessionRows"), F.sum("SessionMs").cast("bigint").alias("SessionMs"),
        F.min("SignInTime").alias("MinSignInTime"), F.max("SignOutTime").alias("MaxSignOutTime"))


# ---- Q10-Q13 (feed readiness, raw-vs-event, promotion gate) ------------------------------------

def readiness(t, sessions: DataFrame) -> DataFrame:
    """Q10: one row of feed counts and presence flags."""
    rd = t.report_data.agg(F.count(F.lit(1)).alias("ReportDataRows"), F.min("PrimaryKey").alias("ReportDataMinPrimaryKey"),
                           F.max("PrimaryKey").alias("ReportDataMaxPrimaryKey"), F.min("TimeStamp").alias("ReportDataMinTimestamp"),
                           F.max("TimeStamp").alias("ReportDataMaxTimestamp"))
    cnt = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    sign = lambda df, wt, name: cnt(df.filter(F.col("WorkType") == wt), name)
    o = t.order_rows.agg(F.count(F.lit(1)).alias("OrderRows"), _cnt(F.col("CompletedDate").isNotNull()).alias("CompletedOrderRows"))
    j = _one_row_join(
        rd, cnt(t.pick, "PickRows"), o, cnt(t.bin_presented, "BinPresentedRows"), cnt(t.close_bin, "CloseBinRows"),
        sign(t.sign_in, "Pick", "PickSignInRows"), sign(t.sign_out, "Pick", "PickSignOutRows"),
        sign(t.sign_in, "PutAway", "PutAwaySignInRows"), sign(t.sign_out, "PutAway", "PutAwaySignOutRows"),
        sign(t.sign_in, "CycleCount", "CycleCountSignInRows"), sign(t.sign_out, "CycleCount", "CycleCountSignOutRows"),
        cnt(sessions, "_sessions"),
    )
    return j.select(
        "*", (F.col("PickRows") > 0).alias("HasPickRows"), (F.col("OrderRows") > 0).alias("HasOrderRows"),
        (F.col("BinPresentedRows") > 0).alias("HasBinPresentedRows"), (F.col("_sessions") > 0).alias("HasPairedWorkSessions"),
    ).drop("_sessions")


RAW_VS_EVENT_CHECKS = ["Bin presentations", "Completed pick lines", "Completed pick units", "Reported order rows",
                       "Paired session seconds"]


def raw_vs_event(t, sessions: DataFrame, ev: DataFrame) -> DataFrame:
    """Q11: raw source totals against the event stream (CheckName, RawValue, EventValue)."""
    act, req = F.coalesce(F.col("ActualPickQuantity"), F.lit(0)), F.coalesce(F.col("RequiredPickQuantity"), F.lit(0))
    raw = _one_row_join(
        t.bin_presented.agg(F.count(F.lit(1)).cast("double").alias("r0")),
        t.pick.agg(_cnt(act >= req).cast("double").alias("r1"),
                   F.coalesce(F.sum(F.when(act >= req, F.col("ActualPickQuantity")).otherwise(0)), F.lit(0)).cast("double").alias("r2")),
        t.order_rows.agg(_cnt(F.col("CompletedDate").isNotNull()).cast("double").alias("r3")),
        sessions.agg((F.coalesce(F.sum("SessionMs"), F.lit(0)) / F.lit(1000)).alias("r4")),
    )
    e = ev.agg(
        F.coalesce(F.sum(F.when(F.col("EventType") == "BIN_PRESENTATION", F.col("BinPresentationCount"))), F.lit(0)).cast("double").alias("e0"),
        F.coalesce(F.sum(F.when(F.col("SourceName") == "Pick", F.col("LineCompletedCount"))), F.lit(0)).cast("double").alias("e1"),
        F.coalesce(F.sum(F.when(F.col("SourceName") == "Pick", F.col("UnitCompletedCount"))), F.lit(0)).cast("double").alias("e2"),
        F.coalesce(F.sum(F.when(F.col("SourceName") == "Order", F.col("OrderCompletedCount"))), F.lit(0)).cast("double").alias("e3"),
        (F.coalesce(F.sum(F.when(F.col("EventType") == "SESSION", F.col("RateDenominatorMs"))), F.lit(0)) / F.lit(1000)).alias("e4"),
    )
    j = _one_row_join(raw, e)
    rows = F.array(*[F.struct(F.lit(n).alias("CheckName"), F.col(f"r{i}").alias("RawValue"), F.col(f"e{i}").alias("EventValue"))
                     for i, n in enumerate(RAW_VS_EVENT_CHECKS)])
    return j.select(F.explode(rows).alias("c")).select("c.*")


def promotion_gate(checks: DataFrame, ready: DataFrame, by_user_work_type: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Q12: PASS when every raw-vs-event check agrees within ``tolerance``,
    Pick rows exist and every Pick aggregate row uses the SESSION denominator."""
    vf = checks.agg(_cnt(F.abs(F.col("RawValue") - F.col("EventValue")) > tolerance).alias("FailedValidationChecks"))
    pick = by_user_work_type.filter(F.col("WorkType") == "Pick")
    pd = pick.agg(F.count(F.lit(1)).alias("PickAggregateRows"),
                  _cnt(F.col("RateDenominatorSource") == "SESSION").alias("PickRowsWithSessionDenominator"),
                  _cnt(F.col("RateDenominatorSource") != "SESSION").alias("PickRowsWithoutSessionDenominator"))
    j = _one_row_join(vf, ready, pd)
    ok = (F.col("FailedValidationChecks") == 0) & F.col("HasPickRows") & (F.col("PickAggregateRows") > 0) \
        & (F.col("PickRowsWithoutSessionDenominator") == 0)
    return j.select(
        F.when(ok, "PASS").otherwise("REVIEW").alias("DropInPatchPromotionGate"), "FailedValidationChecks", "HasPickRows",
        "HasOrderRows", "HasBinPresentedRows", "HasPairedWorkSessions", "PickAggregateRows", "PickRowsWithSessionDenominator",
        "PickRowsWithoutSessionDenominator", "ReportDataRows", "ReportDataMinPrimaryKey", "ReportDataMaxPrimaryKey",
        "ReportDataMinTimestamp", "ReportDataMaxTimestamp")


def event_reconcile(ev: DataFrame) -> DataFrame:
    """Q13: the event stream by work type / event type / source / attribution."""
    return ev.groupBy("WorkType", "EventType", "SourceName", "AttributionMethod").agg(
        F.count(F.lit(1)).alias("EventRows"), F.sum("OrderCompletedCount").cast("bigint").alias("OrdersCompleted"),
        F.sum("BinPresentationCount").cast("bigint").alias("BinPresentationsCompleted"),
        F.sum("LineCompletedCount").cast("bigint").alias("LinesCompleted"),
        F.sum("UnitCompletedCount").cast("bigint").alias("UnitsCompleted"),
        (F.sum("RateDenominatorMs") / F.lit(1000)).alias("RateDenominatorSeconds"),
        (F.sum("HandleMs") / F.lit(1000)).alias("HandleSeconds"),
        (F.sum("MachineWaitMs") / F.lit(1000)).alias("MachineWaitSeconds"),
        F.min("StartTime").alias("MinStartTime"), F.max("StartTime").alias("MaxStartTime"))


# ---- Q43-Q48 (operational checks) ----------------------------------------------------------------

def freshness(tables: dict, stamp: str, out: str = "Latest") -> DataFrame:
    """Q43 / Q44: rows and latest stamp per table."""
    parts = [df.agg(F.lit(name).alias("TableName"), F.count(F.lit(1)).alias("Rows"), F.max(stamp).alias(out))
             for name, df in tables.items()]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def source_bounds(live: DataFrame) -> DataFrame:
    """Q45 (a): bounds of the live telemetry table."""
    return live.agg(F.count(F.lit(1)).alias("SourceRows"), F.min("PrimaryKey").alias("MinPrimaryKey"),
                    F.max("PrimaryKey").alias("MaxPrimaryKey"), F.min("TimeStamp").alias("MinTimestamp"),
                    F.max("TimeStamp").alias("MaxTimestamp"))


def source_top_descriptions(live: DataFrame, n: int = 50) -> DataFrame:
    """Q45 (b): the top ``n`` descriptions by rows (the limit is the report's)."""
    g = live.groupBy("DataDescription").agg(
        F.count(F.lit(1)).alias("Rows"), F.min("PrimaryKey").alias("MinPrimaryKey"), F.max("PrimaryKey").alias("MaxPrimaryKey"),
        F.min("TimeStamp").alias("MinTimestamp"), F.max("TimeStamp").alias("MaxTimestamp"))
    return g.orderBy(F.col("Rows").desc(), F.col("DataDescription")).limit(n)


def historical_totals(views: dict) -> DataFrame:
    """Q46: date bounds and totals of the historical dailies."""
    parts = [df.agg(F.lit(name).alias("ViewName"), F.min("Date").alias("MinDate"), F.max("Date").alias("MaxDate"),
                    F.sum(df.columns[1]).cast("bigint").alias("TotalValue")) for name, df in views.items()]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def throughput_totals(t: DataFrame) -> DataFrame:
    """Q47."""
    return t.groupBy("Date", "Hour", "Ports", "OrderCategory").agg(
        F.sum("OrdersCompleted").cast("bigint").alias("OrdersCompleted"),
        F.sum("LinesCompleted").cast("bigint").alias("LinesCompleted"),
        F.sum("BinPresentationsCompleted").cast("bigint").alias("BinPresentationsCompleted"))


def helper_counts(views: dict) -> DataFrame:
    """Q48: row counts of helper views."""
    parts = [df.agg(F.lit(name).alias("ViewName"), F.count(F.lit(1)).alias("Rows")) for name, df in views.items()]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


# ---- Q15-Q17: helper-view reconciliation and the import-view gate ----------------------------------

def _expected_value(src: str, kind: str) -> Column:
    """Value of a helper view as the validator recomputes it from the roll-up."""
    if kind == "rate":
        return F.when(F.col("RateDenominatorSource") == "SESSION", F.col(src)).cast("double")
    if kind == "minutes":
        return F.round(F.col(src), 0)
    if kind == "float":
        return F.col(src).cast("double")
    return F.col(src)


def _views_of(dim: str):
    from opsgrain.plans.pages import HELPER_VIEWS
    return [v for v in HELPER_VIEWS if v[1] == dim]


def reconcile_totals(rollups: dict, helpers_wide: dict, tolerance: float = 0.001) -> DataFrame:
    """Q15: per helper view, expected rows / value total from the Pick roll-up
    against the helper view's rows / total.  ``rollups`` maps 'Users'/'Ports'
    to R05/R06; ``helpers_wide`` maps the dimension to its helper views as
    columns of one frame (all views of a dimension share one row set), so each
    side is a single aggregate per dimension."""
    out = None
    for dim, grain in (("Users", "User"), ("Ports", "Port")):
        views = _views_of(dim)
        pick = rollups[dim].filter(F.col("WorkType") == "Pick")
        exp = pick.agg(F.count(F.lit(1)).alias("_en"), *[
            F.coalesce(F.sum(_expected_value(src, kind)), F.lit(0)).alias(f"e_{name}") for name, _, _, src, kind in views])
        act = helpers_wide[dim].agg(F.count(F.lit(1)).alias("_an"), *[
            F.coalesce(F.sum(F.col(f"`{name}`")), F.lit(0)).alias(f"a_{name}") for name, *_ in views])
        pairs = F.array(*[F.struct(
            F.lit(name).alias("HelperView"), F.col("_en").cast("decimal(19,4)").alias("ExpectedRows"),
            F.col("_an").cast("decimal(19,4)").alias("ActualRows"), F.col(f"e_{name}").cast("decimal(19,4)").alias("ExpectedValue"),
            F.col(f"a_{name}").cast("decimal(19,4)").alias("ActualValue")) for name, *_ in views])
        rows = _one_row_join(exp, act).select(F.lit(grain).alias("Grain"), F.explode(pairs).alias("p")).select("Grain", "p.*")
        out = rows if out is None else out.unionByName(rows)
    return out.select(
        "*", (F.col("ActualRows") - F.col("ExpectedRows")).alias("RowDifference"),
        (F.col("ActualValue") - F.col("ExpectedValue")).alias("ValueDifference"),
        F.when((F.abs(F.col("ActualRows") - F.col("ExpectedRows")) <= tolerance)
               & (F.abs(F.col("ActualValue") - F.col("ExpectedValue")) <= tolerance), "PASS").otherwise("REVIEW").alias("CheckStatus"))


def reconcile_rows(rollups: dict, helpers_wide: dict, tolerance: float = 0.001) -> DataFrame:
    """Q16: per helper view and label, expected (roll-up) against actual
    (helper) values, NULL-safe.  All views of a dimension share one key set, so
    one full outer join per dimension feeds all eleven views."""
    out = None
    for dim, grain in (("Users", "User"), ("Ports", "Port")):
        views = _views_of(dim)
        pick = rollups[dim].filter(F.col("WorkType") == "Pick")
        key = F.col(dim) if dim == "Users" else F.when(F.col(dim) == "Unattributed", "No Data").otherwise(F.col(dim))
        exp = pick.select(key.alias("_ek"), *[_expected_value(src, kind).alias(f"e_{name}") for name, _, _, src, kind in views])
        act = helpers_wide[dim].select(F.col(dim).alias("_ak"), *[F.col(f"`{name}`").alias(f"a_{name}") for name, *_ in views])
        j = exp.join(act, F.col("_ek") == F.col("_ak"), "full")
        pairs = F.array(*[F.struct(F.lit(name).alias("HelperView"),
                                   F.col(f"e_{name}").cast("decimal(19,4)").alias("ExpectedValue"),
                                   F.col(f"a_{name}").cast("decimal(19,4)").alias("ActualValue")) for name, *_ in views])
        rows = j.select(F.lit(grain).alias("Grain"), F.coalesce("_ek", "_ak").alias("LabelValue"), F.explode(pairs).alias("p")) \
            .select("Grain", "p.HelperView", "LabelValue", "p.ExpectedValue", "p.ActualValue")
        out = rows if out is None else out.unionByName(rows)
    e, a = F.col("ExpectedValue"), F.col("ActualValue")
    return out.select("*", (a - e).alias("ValueDifference"), F.when(e.isNull() & a.isNull(), "PASS").when(
        e.isNotNull() & a.isNotNull() & (F.abs(a - e) <= tolerance), "PASS").otherwise("REVIEW").alias("CheckStatus"))


def patch_gate(totals: DataFrame, rows: DataFrame, daily: DataFrame) -> DataFrame:
    """Q17: the import-view profile and the PASS / REVIEW gate."""
    ft = totals.agg(_cnt(F.col("CheckStatus") != "PASS").alias("FailedHelperViewChecks"))
    fr = rows.agg(_cnt(F.col("CheckStatus") != "PASS").alias("FailedHelperViewRowChecks"))
    prof = daily.agg(F.count(F.lit(1)).alias("DailyAggregateRowsAvailable"), F.min("EventDate").alias("DailyAggregateMinEventDate"),
                     F.max("EventDate").alias("DailyAggregateMaxEventDate"),
                     F.count_distinct("WorkType").alias("DailyAggregateWorkTypes"), F.count_distinct("Users").alias("DailyAggregateUsers"),
                     F.count_distinct("Ports").alias("DailyAggregatePorts"))
    j = _one_row_join(ft, fr, prof)
    ok = (F.col("FailedHelperViewChecks") == 0) & (F.col("FailedHelperViewRowChecks") == 0) & (F.col("DailyAggregateRowsAvailable") > 0)
    return j.select(F.when(ok, "PASS").otherwise("REVIEW").alias("PowerBIPatchValidationGate"), *j.columns)


# ---- Q36-Q41: Daily-KPI diagnostics -------------------------------------------------------------------

def _col(df: DataFrame, name: str, typ: str = "timestamp") -> Column:
    """A column of ``df`` or a typed NULL when the table does not carry it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


# KPI view source names per matrix metric.
KPI_SOURCE_NAMES = {
    "Total SKUs On Hand": "Total_SKUs_On_Hand", "Total Units On Hand": "Total_Units_On_Hand",
    "Total Locations Occupied": "Total_Locations_Occupied", "Orders Putaway": "Orders_Putaway",
    "Units Putaway": "Units_Putaway", "Skus Putaway": "Skus_Putaway", "Presentations Putaway": "Presentations_Putaway",
    "Distinct bins inventory added": "Distinct_bins_inventory_added",
    "Distinct bin compartments that had inventory": "Distinct_bin_compartments_that_had_inventory",
    "Customer Orders Picked": "Customer_Orders_Picked", "Customer Order Lines": "Customer_Order_Lines",
    "Units Picked": "Units_Picked", "Distinct Skus Picked": "Distinct_Skus_Picked",
}


def _kpi_labels(kpi_long: DataFrame) -> DataFrame:
    from opsgrain.plans.measures import KPI_ROWS
    m = F.create_map(*[x for g, n, _, _, v in KPI_ROWS for x in (F.lit(v), F.lit(n))])
    g = F.create_map(*[x for g, n, _, _, v in KPI_ROWS for x in (F.lit(v), F.lit(g))])
    s = F.create_map(*[x for v, src in KPI_SOURCE_NAMES.items() for x in (F.lit(v), F.lit(src))])
    return kpi_long.select(g[F.col("Metric")].alias("GroupName"), m[F.col("Metric")].alias("MetricName"),
                           s[F.col("Metric")].alias("SourceName"), "Date", "Value")


def kpi_window(kpi_long: DataFrame, as_of, days: int = 14) -> DataFrame:
    """Q36: KPI view rows dated on or after ``as_of - days``, long form."""
    start = F.date_sub(F.lit(as_of), days)
    k = _kpi_labels(kpi_long).filter(F.col("Date") >= start)
    return k.select("GroupName", "MetricName", "Date", F.col("Value").cast("decimal(19,4)").alias("MetricValue"))


def kpi_coverage(kpi_long: DataFrame, as_of, default_days: int = 7) -> DataFrame:
    """Q37: per KPI source: rows, date bounds, rows and value in the report's default window."""
    start = F.date_sub(F.lit(as_of), default_days)
    k = _kpi_labels(kpi_long)
    inw = F.col("Date") >= start
    return k.groupBy("GroupName", "SourceName").agg(
        F.count(F.lit(1)).alias("TotalRows"), F.min("Date").alias("MinDate"), F.max("Date").alias("MaxDate"),
        _cnt(inw).alias("RowsInPowerBIDefaultWindow"),
        F.sum(F.when(inw, F.col("Value")).otherwise(0)).cast("decimal(19,4)").alias("ValueInPowerBIDefaultWindow"))


def date_ranges(tables: dict) -> DataFrame:
    """Q38: snapshot-date and business-date ranges per table."""
    parts = []
    for name, df in tables.items():
        snap, biz = F.to_date(_col(df, "LastUpdatedDate")), F.to_date(_col(df, "LastUpdatedDateInventory"))
        parts.append(df.agg(F.lit(name).alias("SourceName"), F.count(F.lit(1)).alias("Rows"), F.min(snap).alias("MinSnapshotDate"),
                            F.max(snap).alias("MaxSnapshotDate"), F.min(biz).alias("MinBusinessLastUpdatedDate"),
                            F.max(biz).alias("MaxBusinessLastUpdatedDate"),
                            F.max(_col(df, "Snapshot_Id", "bigint")).cast("bigint").alias("MaxSnapshotId")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def survival_inventory(inventory: DataFrame, containers: DataFrame) -> DataFrame:
    """Q39: rows left after each Daily-KPI filter, per inventory snapshot date.
    Every inventory row counts once per container snapshot, as in the
    diagnostic; container snapshots are counted per key, status side and date
    first, so the rows are weighted and not multiplied."""
    outside = F.coalesce(F.col("Status"), F.lit("")) == "Outside"
    c = containers.groupBy(F.col("PrimaryKey").alias("ContainerPrimaryKey"), outside.alias("_outside"),
                           F.to_date(_col(containers, "LastUpdatedDate")).alias("_date")).agg(F.count(F.lit(1)).alias("_times"))
    i = inventory.select(F.to_date("LastUpdatedDate").alias("InventorySnapshotDate"), "UnitOfMeasurePrimaryKey", "ContainerPrimaryKey",
                         "ContainerX", "ContainerY", "Quantity", (F.col("Status") != "Pending").alias("_settled"))
    j = i.join(c, "ContainerPrimaryKey", "left").withColumn("_n", F.coalesce("_times", F.lit(1)))
    inside = F.col("_settled") & ~F.coalesce("_outside", F.lit(False))
    same = inside & (F.col("InventorySnapshotDate") == F.col("_date"))

    def rows(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("bigint")

    return j.groupBy("InventorySnapshotDate").agg(
        F.sum("_n").alias("InventoryRows"), rows(F.col("_settled")).alias("InventoryNotPendingRows"),
        rows(F.col("_settled") & F.col("_times").isNotNull()).alias("NotPendingRowsWithContainerMatch"),
        rows(inside).alias("RowsEligibleBeforeDateMatch"), rows(same).alias("RowsEligibleAfterDateMatch"),
        F.count_distinct(F.when(same, F.col("UnitOfMeasurePrimaryKey"))).alias("TotalSkusOnHandViewWouldCount"),
        F.coalesce(F.sum(F.when(same, F.coalesce("Quantity", F.lit(0)) * F.col("_n"))), F.lit(0)).cast("bigint").alias("TotalUnitsOnHandViewWouldSum"),
        F.count_distinct(F.when(same, F.struct("ContainerPrimaryKey", "ContainerX", "ContainerY")))
        .alias("DistinctBinsOrCompartmentsViewWouldCount"))


def survival_putaway(pac: DataFrame, lines: DataFrame) -> DataFrame:
    """Q40: the same for the inbound views, per putaway snapshot date."""
    p = pac.select(F.to_date("LastUpdatedDate").alias("PutAwaySnapshotDate"),
                   F.to_date(_col(pac, "LastUpdatedDateInventory")).alias("PutAwayBusinessUpdatedDate"),
                   F.col("PrimaryKey").alias("PutAwayContainerPrimaryKey"), F.col("Status").alias("PutAwayStatus"))
    li = lines.select("PutAwayContainerPrimaryKey", F.col("PrimaryKey").alias("LineItemPrimaryKey"), "UnitOfMeasurePrimaryKey",
                      "ActualQuantity", F.to_date("LastUpdatedDate").alias("LineItemSnapshotDate"))
    j = p.join(li, "PutAwayContainerPrimaryKey", "left")
    closed = F.col("PutAwayStatus") == "Closed"
    pos = closed & (F.col("ActualQuantity") > 0)
    passing = pos & (F.col("PutAwaySnapshotDate") == F.col("LineItemSnapshotDate")) \
        & (F.col("PutAwaySnapshotDate") == F.col("PutAwayBusinessUpdatedDate"))
    return j.groupBy("PutAwaySnapshotDate").agg(
        F.count_distinct("PutAwayContainerPrimaryKey").alias("PutAwayContainerRows"),
        F.count_distinct(F.when(closed, F.col("PutAwayContainerPrimaryKey"))).alias("ClosedContainers"),
        F.count_distinct(F.when(closed & (F.col("PutAwaySnapshotDate") == F.col("PutAwayBusinessUpdatedDate")),
                                F.col("PutAwayContainerPrimaryKey"))).alias("ClosedContainersPassingOrdersPutawayViewFilter"),
        _cnt(closed & F.col("LineItemPrimaryKey").isNotNull()).alias("ClosedLineRows"),
        _cnt(pos).alias("ClosedPositiveQtyLineRows"), _cnt(passing).alias("LinesPassingUnitsAndSkusPutawayViewFilter"),
        F.sum(F.when(passing, F.col("ActualQuantity")).otherwise(0)).cast("bigint").alias("UnitsPutawayViewWouldSum"),
        F.count_distinct(F.when(passing, F.col("UnitOfMeasurePrimaryKey"))).alias("SkusPutawayViewWouldCount"))


def closed_by_basis(pac: DataFrame) -> DataFrame:
    """Q41: closed putaway containers per date under three date bases."""
    c = pac.filter(F.col("Status") == "Closed")
    parts = []
    for basis, col in (("SnapshotDate", "LastUpdatedDate"), ("BusinessLastUpdatedDate", "LastUpdatedDateInventory"),
                       ("CreatedDate", "CreatedDate")):
        parts.append(c.groupBy(F.to_date(_col(c, col)).alias("Date")).agg(F.count(F.lit(1)).alias("ClosedPutAwayContainers"))
                     .select(F.lit(basis).alias("DateBasis"), "Date", "ClosedPutAwayContainers"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- Q18-Q19: supervisor page checks -----------------------------------------------------------------

PAGE_CHECKS = [
    ("Historical orders match productivity daily grain", "hist", "orders"),
    ("Historical lines match productivity daily grain", "hist", "lines"),
    ("Historical units match productivity daily grain", "hist", "units"),
    ("Historical bins match productivity daily grain", "hist", "bins"),
    ("Daily KPI picked orders match productivity daily grain", "kpi", "orders"),
    ("Daily KPI picked lines match productivity daily grain", "kpi", "lines"),
    ("Daily KPI picked units match productivity daily grain", "kpi", "units"),
    ("Daily KPI distinct SKUs match completed pick rows", "kpi", "skus"),
    ("Throughput orders match productivity daily grain", "thr", "orders"),
    ("Throughput lines match productivity daily grain", "thr", "lines"),
    ("Throughput bins match productivity daily grain", "thr", "bins"),
]
PLACEHOLDER_CHECK = "Throughput has no blank or raw placeholder report fields"


def page_series(daily: DataFrame, pick_skus: DataFrame, historical: dict, kpi: dict, throughput: DataFrame) -> DataFrame:
    """Every series the page checks compare, long form (Date, Series, Metric, Value).
    ``historical`` / ``kpi`` map metric ('orders', 'lines', 'units', 'bins',
    'skus') to a (Date, value) view."""
    d = daily.filter(F.col("WorkType") == "Pick")
    parts = [d.select(F.col("EventDate").alias("Date"), F.lit("exp").alias("Series"), F.lit(m).alias("Metric"),
                      F.col(c).cast("bigint").alias("Value"))
             for m, c in (("orders", "OrdersCompleted"), ("lines", "LinesCompleted"), ("units", "UnitsCompleted"),
                          ("bins", "BinPresentationsCompleted"))]
    parts.append(pick_skus.select("Date", F.lit("exp").alias("Series"), F.lit("skus").alias("Metric"),
                                  F.col(pick_skus.columns[1]).cast("bigint").alias("Value")))
    for series, views in (("hist", historical), ("kpi", kpi)):
        for m, v in views.items():
            parts.append(v.select("Date", F.lit(series).alias("Series"), F.lit(m).alias("Metric"),
                                  F.col(f"`{v.columns[1]}`").cast("bigint").alias("Value")))
    for m, c in (("orders", "OrdersCompleted"), ("lines", "LinesCompleted"), ("bins", "BinPresentationsCompleted")):
        parts.append(throughput.select("Date", F.lit("thr").alias("Series"), F.lit(m).alias("Metric"),
                                       F.col(c).cast("bigint").alias("Value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def placeholder_rows(throughput: DataFrame) -> DataFrame:
    cond = (F.col("Date").isNull() | (F.nullif(F.col("Hour"), F.lit("")).isNull()) | F.nullif(F.col("Ports"), F.lit("")).isNull()
            | F.nullif(F.col("OrderCategory"), F.lit("")).isNull() | (F.col("Ports") == "No Data")
            | F.col("OrderCategory").isin("NO VALUE", "Unknown"))
    return throughput.filter(cond)


def page_checks(series: DataFrame, throughput: DataFrame) -> DataFrame:
    """Q18: per check, the sum of absolute daily differences and the number of
    mismatching dates between the daily grain and a page's views (NULL-safe,
    missing dates count as 0), plus the placeholder check."""
    per_date = series.groupBy("Date").agg(*[
        F.sum(F.when((F.col("Series") == s) & (F.col("Metric") == m), F.col("Value"))).alias(f"{s}_{m}")
        for s in ("exp", "hist", "kpi", "thr") for m in ("orders", "lines", "units", "bins", "skus")])
    aggs = []
    for i, (_, series_name, metric) in enumerate(PAGE_CHECKS):
        e = F.coalesce(F.col(f"exp_{metric}"), F.lit(0))
        a = F.coalesce(F.col(f"{series_name}_{metric}"), F.lit(0))
        aggs += [F.coalesce(F.sum(F.abs(e - a)), F.lit(0)).alias(f"d{i}"), _cnt(e != a).alias(f"m{i}")]
    checks = per_date.agg(*aggs)
    ph = placeholder_rows(throughput).agg(F.count(F.lit(1)).alias("_ph"))
    rows = F.array(*[F.struct(F.lit(n).alias("CheckName"), F.col(f"d{i}").cast("decimal(19,3)").alias("Difference"),
                              F.col(f"m{i}").alias("MismatchDates")) for i, (n, _, _) in enumerate(PAGE_CHECKS)],
                   F.struct(F.lit(PLACEHOLDER_CHECK).alias("CheckName"), F.col("_ph").cast("decimal(19,3)").alias("Difference"),
                            F.col("_ph").alias("MismatchDates")))
    out = _one_row_join(checks, ph).select(F.explode(rows).alias("c")).select("c.*")
    ok = (F.col("Difference") == 0) & (F.col("MismatchDates") == 0)
    return out.select("*", F.when(ok, "PASS").otherwise("FAIL").alias("Status"))


def supervisor_gate(checks: DataFrame) -> DataFrame:
    """Q19: PASS when no page check failed."""
    failed = _cnt(F.col("Status") == "FAIL")
    return checks.agg(F.when(failed == 0, "PASS").otherwise("FAIL").alias("SupervisorPageValidationGate"),
                      failed.alias("FailedChecks"), F.count(F.lit(1)).alias("TotalChecks"))


def supervisor_summary(series: DataFrame) -> DataFrame:
    """Q19: per source (expected grain, historical, KPI, throughput): dates and totals."""
    names = {"exp": "Expected productivity daily grain", "hist": "Historical dashboard views",
             "kpi": "Daily KPI picking views", "thr": "Throughput page view"}
    per = series.groupBy("Series", "Date").agg(*[
        F.sum(F.when(F.col("Metric") == m, F.col("Value"))).alias(m) for m in ("orders", "lines", "units", "bins", "skus")])
    m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    g = per.groupBy("Series").agg(
        F.count(F.lit(1)).alias("Rows"), F.min("Date").alias("MinDate"), F.max("Date").alias("MaxDate"),
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(o) for c, o in (
            ("orders", "OrdersCompleted"), ("lines", "LinesCompleted"), ("units", "UnitsPicked"), ("bins", "BinPresented"),
            ("skus", "DistinctSkusPicked"))])
    nulls = {"hist": ["DistinctSkusPicked"], "kpi": ["BinPresented"], "thr": ["UnitsPicked", "DistinctSkusPicked"]}
    cols = []
    for c in ("OrdersCompleted", "LinesCompleted", "UnitsPicked", "BinPresented", "DistinctSkusPicked"):
        blank = None
        for s, cs in nulls.items():
            if c in cs:
                blank = (F.col("Series") == s) if blank is None else (blank | (F.col("Series") == s))
        cols.append((F.when(blank, F.lit(None).cast("bigint")).otherwise(F.col(c)) if blank is not None else F.col(c)).alias(c))
    return g.select(m[F.col("Series")].alias("SourceName"), "Rows", "MinDate", "MaxDate", *cols)


# ---- Q20-Q27: all-pages smoke checks ------------------------------------------------------------------

SMOKE_COLUMNS = ["PageName", "CheckName", "RowCount", "MinDate", "MaxDate", "IssueCount", "Status", "Details"]


def _iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def _smoke(df: DataFrame, page: str, check: str, rows: Column, min_d: Column, max_d: Column, issues: Column,
           status: Column, details: Column) -> DataFrame:
    return df.select(F.lit(page).alias("PageName"), F.lit(check).alias("CheckName"), rows.cast("bigint").alias("RowCount"),
                     min_d.cast("date").alias("MinDate"), max_d.cast("date").alias("MaxDate"), issues.cast("bigint").alias("IssueCount"),
                     status.alias("Status"), details.alias("Details"))


def _s(c: Column) -> Column:
    return c.cast("string")


def smoke_kpi(kpi_long: DataFrame, as_of) -> DataFrame:
    """Q20: the 13 Daily-KPI sources have recent usable rows; names missing sources."""
    recent = F.date_sub(F.lit(as_of), 7)
    k = _kpi_labels(kpi_long)
    expected = F.array(*[F.lit(v) for v in sorted(KPI_SOURCE_NAMES.values())])
    s = k.agg(F.count(F.lit(1)).alias("n"), F.min("Date").alias("d0"), F.max("Date").alias("d1"),
              _cnt(F.col("Date").isNull()).alias("nd"), _cnt(F.col("Value").isNull()).alias("nv"),
              F.count_distinct("SourceName").alias("sc"), F.collect_set("SourceName").alias("present"))
    missing = F.array_join(F.array_sort(F.array_except(expected, F.col("present"))), ", ")
    status = F.when((F.col("n") == 0) | (F.col("nd") > 0) | (F.col("nv") > 0) | (F.col("d1") < recent), "FAIL") \
        .when(F.col("sc") < 13, "WARN").otherwise("PASS")
    details = F.concat(F.lit("KPI sources (of 13): "), _s(F.col("sc")),
                       F.when(missing != "", F.concat(F.lit(", absent: "), missing)).otherwise(F.lit("")),
                       F.lit(", window from "), _iso(recent), F.lit("."))
    return _smoke(s, "Daily KPI Summary Report", "KPI source views have recent usable rows", F.col("n"), F.col("d0"),
                  F.col("d1"), F.col("nd") + F.col("nv") + F.when(F.col("sc") < 13, 1).otherwise(0), status, details)


def smoke_productivity(daily: DataFrame, as_of) -> DataFrame:
    """Q21: the daily productivity grain has recent Pick rows with activity."""
    recent = F.date_sub(F.lit(as_of), 7)
    d = daily.filter(F.col("WorkType") == "Pick")
    basis = sum((F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,4)") for c in (
        "OrdersCompleted", "BinPresentationsCompleted", "LinesCompleted", "UnitsCompleted", "MachineWaitMinutes",
        "ActiveHandleMinutes", "TotalLoggedMinutes", "RateDenominatorHours")), F.lit(0).cast("decimal(38,4)"))
    d = d.withColumn("_b", basis)
    bad = F.col("EventDate").isNull() | F.nullif(F.col("Users"), F.lit("")).isNull() | F.nullif(F.col("Ports"), F.lit("")).isNull()
    s = d.agg(F.count(F.lit(1)).alias("n"), _cnt(F.col("_b") > 0).alias("act"),
              _cnt((F.col("EventDate") >= recent) & (F.col("_b") > 0)).alias("rec"), F.min("EventDate").alias("d0"),
              F.max("EventDate").alias("d1"), _cnt(bad).alias("bad"), _cnt(F.col("Users") != "Unattributed").alias("wu"),
              _cnt(F.col("Ports") != "Unattributed").alias("wp"), _cnt(F.col("_b") <= 0).alias("zero"))
    status = F.when((F.col("n") == 0) | (F.col("bad") > 0) | (F.col("d1") < recent), "FAIL") \
        .when(F.col("rec") == 0, "WARN").otherwise("PASS")
    details = F.concat(F.lit("user named: "), _s(F.col("wu")), F.lit(", port named: "), _s(F.col("wp")),
                       F.lit(", active: "), _s(F.col("act")), F.lit(", active in window: "), _s(F.col("rec")),
                       F.lit(", idle: "), _s(F.col("zero")), F.lit("."))
    return _smoke(s, "Productivity by User / Port", "Daily productivity grain has recent pick rows", F.col("n"), F.col("d0"),
                  F.col("d1"), F.col("bad") + F.when(F.col("rec") == 0, 1).otherwise(0), status, details)


def smoke_throughput(throughput: DataFrame, as_of) -> DataFrame:
    """Q22: the throughput view has recent rows and no placeholders."""
    recent = F.date_sub(F.lit(as_of), 7)
    bad = (F.col("Date").isNull() | F.nullif(F.col("Hour"), F.lit("")).isNull() | F.nullif(F.col("Ports"), F.lit("")).isNull()
           | F.nullif(F.col("OrderCategory"), F.lit("")).isNull() | (F.col("Ports") == "No Data")
           | F.col("OrderCategory").isin("NO VALUE", "Unknown"))
    s = throughput.agg(F.count(F.lit(1)).alias("n"), F.min("Date").alias("d0"), F.max("Date").alias("d1"), _cnt(bad).alias("bad"))
    status = F.when((F.col("n") == 0) | (F.col("bad") > 0) | (F.col("d1") < recent), "FAIL").otherwise("PASS")
    return _smoke(s, "Throughput", "Throughput view has recent usable rows", F.col("n"), F.col("d0"), F.col("d1"), F.col("bad"),
                  status, F.concat(F.lit("window from "), _iso(recent), F.lit(".")))


def smoke_historical(historical: dict, as_of) -> DataFrame:
    """Q23: the four historical sources have rows within 30 days."""
    start = F.date_sub(F.lit(as_of), 30)
    parts = [v.select(F.lit(k).alias("SourceName"), F.col("Date"), F.col(v.columns[1]).alias("Value")) for k, v in historical.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    s = u.agg(F.count(F.lit(1)).alias("n"), F.min("Date").alias("d0"), F.max("Date").alias("d1"),
              _cnt(F.col("Date").isNull()).alias("nd"), _cnt(F.col("Value").isNull()).alias("nv"),
              F.count_distinct("SourceName").alias("sc"))
    status = F.when((F.col("n") == 0) | (F.col("nd") > 0) | (F.col("nv") > 0) | (F.col("d1") < start), "FAIL") \
        .when(F.col("sc") < 4, "WARN").otherwise("PASS")
    details = F.concat(F.lit("dailies (of 4): "), _s(F.col("sc")), F.lit(", history from "),
                       _iso(start), F.lit("."))
    return _smoke(s, "Historical Dashboard", "Trailing 30-day trend views have usable rows", F.col("n"), F.col("d0"), F.col("d1"),
                  F.col("nd") + F.col("nv") + F.when(F.col("sc") < 4, 1).otherwise(0), status, details)


def matrix_completeness(matrix: DataFrame) -> DataFrame:
    """Q24: every label carries each of the 18 metrics exactly once, and nothing else.
    The expected grid is labels × 18 names, built per label with ``explode``."""
    from opsgrain.plans.pages import MATRIX_METRICS
    names = F.array(*[F.lit(n) for n in MATRIX_METRICS])
    counts = matrix.groupBy("CompartmentLabel", "MetricName").agg(F.count(F.lit(1)).alias("c"))
    grid = matrix.select("CompartmentLabel").distinct().select("CompartmentLabel", F.explode(names).alias("MetricName"))
    g = grid.join(counts, ["CompartmentLabel", "MetricName"], "left").agg(
        _cnt(F.col("c").isNull()).alias("missing"), F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).alias("dup"))
    bad = (F.nullif(F.col("CompartmentLabel"), F.lit("")).isNull() | F.nullif(F.col("MetricName"), F.lit("")).isNull()
           | F.nullif(F.col("MetricValue"), F.lit("")).isNull())
    m = matrix.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("MetricName").alias("mc"),
                   F.count_distinct("CompartmentLabel").alias("lc"), _cnt(bad).alias("bad"),
                   _cnt(~F.col("MetricName").isin(MATRIX_METRICS)).alias("unexp"))
    j = _one_row_join(m, g)
    fail = ((F.col("n") == 0) | (F.col("bad") > 0) | (F.col("mc") != 18) | (F.col("missing") > 0) | (F.col("dup") > 0)
            | (F.col("unexp") > 0))
    details = F.concat(F.lit("labels: "), _s(F.col("lc")), F.lit(", metrics: "), _s(F.col("mc")),
                       F.lit(", cells missing: "), _s(F.col("missing")), F.lit(", cells repeated: "),
                       _s(F.col("dup")), F.lit(", cells unknown: "), _s(F.col("unexp")), F.lit("."))
    return _smoke(j, "Inventory & Location Table Summary", "Inventory/location summary has complete metric rows", F.col("n"),
                  F.lit(None), F.lit(None), F.col("bad") + F.col("missing") + F.col("dup") + F.col("unexp")
                  + F.when(F.col("mc") != 18, 1).otherwise(0), F.when(fail, "FAIL").otherwise("PASS"), details)


#: What can be wrong with a consolidation row; only a missing capacity is no failure.
DEFECTS = ("label", "capacity", "negative", "denominator", "scale")


def with_defects(report: DataFrame) -> DataFrame:
    """Consolidation rows with ``units`` and ``wrong``, the list of their defects."""
    units, places, spare = (F.col(c).try_cast("decimal(19,4)") for c in ("Quantity", "TotalCompartments", "TotalUnrealizedCapacity"))
    full = units + spare
    unnamed = F.exists(F.array("Sku", "CompartmentSizeName"), lambda x: x.isNull() | (x == ""))
    found = {
        "label": unnamed | F.col("Quantity").isNull(), "capacity": F.col("TotalCompartments").isNull() | F.col("TotalUnrealizedCapacity").isNull(),
        "negative": F.least(units, places, spare) < 0, "denominator": full <= 0, "scale": (full != 0) & ~(spare / full).between(0, 1),
    }
    return report.withColumn("units", units).withColumn("wrong", F.array_compact(F.array(*(F.when(found[d], d) for d in DEFECTS))))


def consolidation_counts(report: DataFrame, source: DataFrame | None) -> DataFrame:
    """One row: consolidation rows and units, how many rows have each defect,
    and the source's rows and units."""
    r = with_defects(report).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("units", F.lit(0))).cast("decimal(19,4)").alias("rq"),
        *(F.count_if(F.array_contains("wrong", d)).alias(d) for d in DEFECTS), F.count_distinct("Sku").alias("skus"), F.count_distinct("CompartmentSizeName").alias("sizes"))
    if source is not None:
        src = source.agg(F.count(F.lit(1)).alias("sr"),
                         F.sum(F.coalesce(F.col("Quantity").try_cast("decimal(19,4)"), F.lit(0))).cast("decimal(19,4)").alias("sq"))
    else:
        src = report.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("sr"), F.lit(None).cast("decimal(19,4)").alias("sq"))
    return _one_row_join(r, src)


def _failing() -> Column:
    return F.col("label") + F.col("negative") + F.col("denominator") + F.col("scale") + F.when((F.col("sr") > 0) & (F.col("n") == 0), 1).otherwise(0)


def _consolidation_status() -> Column:
    return F.when(_failing() > 0, "FAIL").when(F.col("sr").isNull() | (F.col("n") == 0) | (F.col("capacity") > 0), "WARN").otherwise("PASS")


def _row_quality_text() -> Column:
    said = {"label": "without label", "capacity": "without capacity", "negative": "negative", "denominator": "no denominator", "scale": "fragmentation off scale"}
    return F.concat(*(x for d in DEFECTS for x in (F.lit(f", {said[d]}: "), _s(F.col(d)))))


def consolidation_quality(report: DataFrame, source: DataFrame | None) -> DataFrame:
    """Q25: consolidation rows are displayable, non-negative, with fragmentation in 0..1."""
    j = consolidation_counts(report, source)
    sr, n = F.col("sr"), F.col("n")
    issues = _failing()
    details = F.concat(
        F.lit("in source: "), F.coalesce(_s(sr), F.lit("unavailable")), F.lit(", in report: "), _s(n),
        F.lit(", units in source: "), F.coalesce(_s(F.col("sq")), F.lit("unavailable")), F.lit(", SKUs: "),
        _s(F.col("skus")), F.lit(", sizes: "), _s(F.col("sizes")), _row_quality_text(),
        F.lit(""))
    return _smoke(j, "Consolidation Report", "Consolidation detail has displayable rows", n, F.lit(None), F.lit(None), issues,
                  _consolidation_status(), details)


def smoke_open_work_sources(tables: dict, as_of) -> DataFrame:
    """Q26 (a): the six open-work source tables have dateable rows."""
    recent = F.date_sub(F.lit(as_of), 7)
    parts = [df.select(F.lit(k).alias("SourceName"), F.to_date("LastUpdatedDate").alias("SourceDate")) for k, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    s = u.agg(F.count(F.lit(1)).alias("n"), F.min("SourceDate").alias("d0"), F.max("SourceDate").alias("d1"),
              _cnt(F.col("SourceDate").isNull()).alias("nd"), F.count_distinct("SourceName").alias("sc"))
    status = F.when((F.col("n") == 0) | (F.col("nd") > 0), "FAIL").when(F.col("sc") < 6, "WARN") \
        .when(F.col("d1") < recent, "WARN").otherwise("PASS")
    details = F.concat(F.lit("dated tables (of 6): "), _s(F.col("sc")), F.lit(", window from "),
                       _iso(recent), F.lit("."))
    return _smoke(s, "Open Work History", "Open-work source tables have dateable rows", F.col("n"), F.col("d0"), F.col("d1"),
                  F.col("nd") + F.when(F.col("sc") < 6, 1).otherwise(0), status, details)


def smoke_open_work_counts(open_rows: DataFrame) -> DataFrame:
    """Q26 (b): current open-work counts per series (from the P33 rows)."""
    from opsgrain.plans.pages import open_work
    w = open_work(open_rows)
    piv = w.agg(*[F.coalesce(F.sum(F.when(F.col("MetricName") == n, F.col("SourceRows"))), F.lit(0)).alias(n.replace(" ", "_"))
                  for n in ("Orders Pick", "Lines Pick", "Orders Put", "Lines Put", "Orders Cycle Count", "Lines Cycle Count")])
    c = {k: F.col(k) for k in piv.columns}
    total = sum(c.values(), F.lit(0))
    details = F.concat(F.lit("pick "), _s(c["Orders_Pick"]), F.lit("/"), _s(c["Lines_Pick"]),
                       F.lit(", put "), _s(c["Orders_Put"]), F.lit("/"), _s(c["Lines_Put"]),
                       F.lit(", count "), _s(c["Orders_Cycle_Count"]), F.lit("/"), _s(c["Lines_Cycle_Count"]),
                       F.lit(" (orders/lines; none may be right)"))
    return _smoke(piv, "Open Work History", "Current open-work measures are queryable", total, F.lit(None), F.lit(None), F.lit(0),
                  F.when(total == 0, "WARN").otherwise("PASS"), details)


def all_pages_gate(smoke: DataFrame) -> DataFrame:
    """Q27: FAIL when any smoke check failed; counts of failures and warnings."""
    f, w = _cnt(F.col("Status") == "FAIL"), _cnt(F.col("Status") == "WARN")
    return smoke.agg(F.when(f == 0, "PASS").otherwise("FAIL").alias("AllPagesSmokeGate"), f.alias("FailedChecks"),
                     w.alias("WarningChecks"), F.count(F.lit(1)).alias("TotalChecks"))


# ---- Q29-Q35: visible-metric checks ------------------------------------------------------------------

CHECK_COLUMNS = ["PageName", "MetricName", "SourceRows", "ReportRows", "SourceValue", "ReportValue", "SourceMinDate",
                 "SourceMaxDate", "ReportMinDate", "ReportMaxDate", "Status", "Details"]

# Fixed values: (metric, kind, basis, require positive) of the visible productivity check.
VISIBLE_PRODUCTIVITY = [
    ("Orders Completed", "count:OrdersCompleted", "OrdersCompleted", 1),
    ("Bin Presentations Completed", "count:BinPresentationsCompleted", "BinPresentationsCompleted", 1),
    ("Lines Completed", "count:LinesCompleted", "LinesCompleted", 1),
    ("Units Completed", "count:UnitsCompleted", "UnitsCompleted", 1),
    ("Orders/hr", "rate:OrdersCompleted", "OrdersCompleted", 1),
    ("Bins/hr", "rate:BinPresentationsCompleted", "BinPresentationsCompleted", 1),
    ("Units/hr", "rate:UnitsCompleted", "UnitsCompleted", 1),
    ("Lines/hr", "rate:LinesCompleted", "LinesCompleted", 1),
    ("Machine Wait Minutes", "dec:MachineWaitMinutes", "EventRows", 0),
    ("Average Handle Minutes/Presentation", "aht", "BinPresentationsCompleted", 0),
    ("Total Logged Minutes", "dec:TotalLoggedMinutes", "EventRows", 0),
    ("Rate Denominator Hours", "dec:RateDenominatorHours", "counts", 1),
]


def _u(c: str) -> Column:
    return (F.col(c) * 10000).cast("bigint")


def _visible_value_units(kind: str) -> Column:
    """The checked value as an exact count of 1e-4 (decimal(19,4) rounding half up)."""
    if kind.startswith("count:"):
        return F.col(kind[6:]).cast("bigint") * 10000
    if kind.startswith("dec:"):
        return _u(kind[4:])
    h = _u("RateDenominatorHours")
    if kind.startswith("rate:"):
        return F.when(h > 0, F.expr(f"(CAST({kind[5:]} AS BIGINT) * 200000000 + CAST(RateDenominatorHours * 10000 AS BIGINT)) "
                                    f"div (2 * CAST(RateDenominatorHours * 10000 AS BIGINT))"))
    b = F.col("BinPresentationsCompleted")
    return F.when(b > 0, F.expr("(CAST(ActiveHandleMinutes * 10000 AS BIGINT) * 2 + BinPresentationsCompleted) "
                                "div (2 * BinPresentationsCompleted)"))


def visible_productivity(daily: DataFrame, as_of) -> DataFrame:
    """Q29: the 12 productivity measures over active Pick rows (long form via
    ``explode``), recent-window value against the source basis."""
    recent = F.date_sub(F.lit(as_of), 7)
    d = daily.filter(F.col("WorkType") == "Pick")
    act = (sum((F.coalesce(F.col(c), F.lit(0)).cast("bigint") * 10000 for c in
                ("OrdersCompleted", "BinPresentationsCompleted", "LinesCompleted", "UnitsCompleted")), F.lit(0))
           + sum((F.coalesce(_u(c), F.lit(0)) for c in ("MachineWaitMinutes", "ActiveHandleMinutes", "TotalLoggedMinutes",
                                                          "RateDenominatorHours")), F.lit(0)))
    d = d.filter(act > 0)
    counts = sum((F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in
                  ("OrdersCompleted", "BinPresentationsCompleted", "LinesCompleted", "UnitsCompleted")), F.lit(0))
    arr = F.array(*[F.struct(F.lit(name).alias("MetricName"), _visible_value_units(kind).alias("v"),
                             ((counts if basis == "counts" else F.col(basis).cast("bigint")) * 10000).alias("b"),
                             F.lit(req).alias("req")) for name, kind, basis, req in VISIBLE_PRODUCTIVITY])
    x = d.select("EventDate", F.explode(arr).alias("m")).select("EventDate", "m.*")
    rec = F.col("EventDate") >= recent
    g = x.groupBy("MetricName", "req").agg(
        F.count(F.lit(1)).alias("SourceRows"), _cnt(rec).alias("ReportRows"), F.sum("b").alias("sv"),
        F.sum(F.when(rec, F.col("v")).otherwise(0)).alias("rv"), F.sum(F.when(rec, F.col("b")).otherwise(0)).alias("rb"),
        F.min("EventDate").alias("SourceMinDate"), F.max("EventDate").alias("SourceMaxDate"),
        F.min(F.when(rec, F.col("EventDate"))).alias("ReportMinDate"), F.max(F.when(rec, F.col("EventDate"))).alias("ReportMaxDate"))
    status = (F.when(F.col("SourceRows") == 0, "WARN").when(F.col("ReportRows") == 0, "WARN")
              .when((F.col("req") == 1) & (F.col("rb") > 0) & (F.coalesce(F.col("rv"), F.lit(0)) == 0), "FAIL")
              .when(F.coalesce(F.col("rv"), F.lit(0)) == 0, "WARN").otherwise("PASS"))
    return g.select(
        F.lit("Productivity by User / Port").alias("PageName"), "MetricName", "SourceRows", "ReportRows",
        (F.col("sv") / F.lit(10000)).alias("SourceValue"), (F.col("rv") / F.lit(10000)).alias("ReportValue"),
        "SourceMinDate", "SourceMaxDate", "ReportMinDate", "ReportMaxDate", status.alias("Status"),
        F.lit("idle rows are left out on both sides").alias("Details"))


def _visible_compare(series: DataFrame, report_series: str, metrics: list, start, page: str, details: str) -> DataFrame:
    """Expected (daily grain) vs report per metric over dates >= start; a date
    exists on a side when that side has a row for it (full outer join semantics)."""
    per = series.filter(F.col("Series").isin("exp", report_series)).groupBy("Date").agg(
        F.max(F.when(F.col("Series") == "exp", 1)).alias("_he"), F.max(F.when(F.col("Series") == report_series, 1)).alias("_hr"),
        *[F.sum(F.when((F.col("Series") == s) & (F.col("Metric") == m), F.col("Value"))).alias(f"{s}_{m}")
          for s in ("exp", report_series) for _, m in metrics])
    e_in = F.col("_he").isNotNull() & (F.col("Date") >= start)
    r_in = F.col("_hr").isNotNull() & (F.col("Date") >= start)
    arr = F.array(*[F.struct(F.lit(n).alias("MetricName"), F.coalesce(F.col(f"exp_{m}"), F.lit(0)).alias("ev"),
                             F.coalesce(F.col(f"{report_series}_{m}"), F.lit(0)).alias("rv")) for n, m in metrics])
    x = per.select("Date", e_in.alias("e_in"), r_in.alias("r_in"), F.explode(arr).alias("m")).select("Date", "e_in", "r_in", "m.*")
    g = x.groupBy("MetricName").agg(
        _cnt(F.col("e_in")).alias("SourceRows"), _cnt(F.col("r_in")).alias("ReportRows"),
        F.sum(F.when(F.col("e_in"), F.col("ev")).otherwise(0)).alias("sv"), F.sum(F.when(F.col("r_in"), F.col("rv")).otherwise(0)).alias("rv"),
        F.min(F.when(F.col("e_in"), F.col("Date"))).alias("SourceMinDate"), F.max(F.when(F.col("e_in"), F.col("Date"))).alias("SourceMaxDate"),
        F.min(F.when(F.col("r_in"), F.col("Date"))).alias("ReportMinDate"), F.max(F.when(F.col("r_in"), F.col("Date"))).alias("ReportMaxDate"))
    status = F.when((F.col("sv") > 0) & (F.col("rv") == 0), "FAIL").when(F.abs(F.col("sv") - F.col("rv")) > 0, "FAIL").otherwise("PASS")
    return g.select(F.lit(page).alias("PageName"), "MetricName", "SourceRows", "ReportRows", F.col("sv").cast("double").alias("SourceValue"),
                    F.col("rv").cast("double").alias("ReportValue"), "SourceMinDate", "SourceMaxDate", "ReportMinDate", "ReportMaxDate",
                    status.alias("Status"), F.lit(details).alias("Details"))


def visible_throughput(series: DataFrame, as_of) -> DataFrame:
    """Q30: throughput totals against the daily grain over the recent window."""
    return _visible_compare(series, "thr", [("Orders", "orders"), ("Lines", "lines"), ("Bins", "bins")],
                            F.date_sub(F.lit(as_of), 7), "Throughput",
                            "against the daily grain, recent window")


def visible_historical(series: DataFrame, as_of) -> DataFrame:
    """Q31: historical views against the daily grain over 30 days."""
    return _visible_compare(series, "hist", [("Orders Completed", "orders"), ("Lines Completed", "lines"),
                                             ("Units Picked", "units"), ("Bin Presentations", "bins")],
                            F.date_sub(F.lit(as_of), 30), "Historical Dashboard",
                            "against the daily grain, 30 days")


def visible_open_work(open_rows: DataFrame) -> DataFrame:
    """Q33: open work per series with PASS / WARN."""
    from opsgrain.plans.pages import open_work
    w = open_work(open_rows)
    return w.select(
        F.lit("Open Work History").alias("PageName"), "MetricName", F.col("SourceRows"), F.col("SourceRows").alias("ReportRows"),
        F.col("SourceRows").cast("double").alias("SourceValue"), F.col("SourceRows").cast("double").alias("ReportValue"),
        F.col("MinDate").alias("SourceMinDate"), F.col("MaxDate").alias("SourceMaxDate"), F.col("MinDate").alias("ReportMinDate"),
        F.col("MaxDate").alias("ReportMaxDate"), F.when(F.col("SourceRows") == 0, "WARN").otherwise("PASS").alias("Status"),
        F.lit("none may be right when nothing is open").alias("Details"))


def visible_gate(checks: DataFrame) -> DataFrame:
    """Q35: FAIL when any visible-metric check failed."""
    f, w = _cnt(F.col("Status") == "FAIL"), _cnt(F.col("Status") == "WARN")
    return checks.agg(F.when(f == 0, "PASS").otherwise("FAIL").alias("VisibleMetricsValidationGate"), f.alias("FailedChecks"),
                      w.alias("WarningChecks"), F.count(F.lit(1)).alias("TotalChecks"))


# ---- Q28: visible Daily-KPI values against their sources ------------------------------------------------

def _listed(df: DataFrame, rows: str, metrics: dict[str, str], first: str = "d0", last: str = "d1") -> DataFrame:
    """A one-row frame of aggregates as one row per metric."""
    items = [F.struct(F.lit(name).alias("MetricName"), F.col(rows).cast("bigint").alias("SourceRows"), F.col(c).cast("decimal(19,4)").alias("SourceValue"),
                      F.col(first).alias("SourceMinDate"), F.col(last).alias("SourceMaxDate")) for name, c in metrics.items()]
    return df.select(F.explode(F.array(*items)).alias("m")).select("m.*")


#: A side of keys and dates with at most so many rows is broadcast (some 50 MB).
KEY_ROWS = 1_000_000


def visible_kpi_expected(t, daily: DataFrame, as_of) -> DataFrame:
    """The 13 expected KPI values recomputed from the operational sources over
    the recent window, one aggregate per group of sources.  Inventory filters
    drop rows with a NULL status, unlike the views."""
    from opsgrain.sources.staging import latest_snapshot
    recent = F.date_sub(F.lit(as_of), 7)
    n = F.count(F.lit(1)).alias("n")

    def span(c: Column) -> list[Column]:
        return [F.min(c).alias("d0"), F.max(c).alias("d1")]

    uom = t.units_of_measure.select(F.col("PrimaryKey").alias("UnitOfMeasurePrimaryKey"), "Snapshot_Id", "ProductPrimaryKey")
    unit = ["UnitOfMeasurePrimaryKey", "Snapshot_Id"]
    sku = F.coalesce("ProductPrimaryKey", "UnitOfMeasurePrimaryKey")
    boxes = t.containers.filter(F.col("Status") != "Outside").select(F.col("PrimaryKey").alias("ContainerPrimaryKey"), "Snapshot_Id")
    stock = latest_snapshot(t.inventory).filter((F.col("Status") != "Pending") & (F.col("Quantity") > 0)).join(
        boxes, ["ContainerPrimaryKey", "Snapshot_Id"], "left_semi").join(uom, unit, "left").agg(
        n, F.count_distinct(sku).alias("skus"), F.sum("Quantity").alias("units"),
        F.count_distinct(F.struct("ContainerPrimaryKey", "ContainerX", "ContainerY")).alias("places"),
        F.count_distinct("ContainerPrimaryKey").alias("bins"), *span(F.to_date("LastUpdatedDate")))
    closed = t.putaway_containers.filter((F.col("Status") == "Closed") & (F.to_date("LastUpdatedDateInventory") >= recent)).select(
        F.col("PrimaryKey").alias("PutAwayContainerPrimaryKey"), F.to_date("LastUpdatedDateInventory").alias("d"))
    boxes_in = closed.agg(n, F.count_distinct("PutAwayContainerPrimaryKey").alias("orders"), *span(F.col("d")))
    shut = broadcast_if_small(closed, KEY_ROWS)  # a week's containers: the tables they meet are not shuffled
    lines_in = shut.join(
        t.putaway_lines.filter(F.col("ActualQuantity") > 0).select("PutAwayContainerPrimaryKey", "ActualQuantity", *unit), "PutAwayContainerPrimaryKey"
    ).join(uom, unit, "left").groupBy("d").agg(n, F.sum("ActualQuantity").alias("units"), F.count_distinct(sku).alias("skus")).agg(
        F.sum("n").alias("n"), F.sum("units").alias("units"), F.sum("skus").alias("skus"), *span(F.col("d")))
    shown = F.struct("PutAwayContainerPrimaryKey", F.coalesce("LocationPrimaryKey", F.lit(-1)), F.coalesce("NewContainerPrimaryKey", F.lit(-1)))
    task = "InventoryTaskPrimaryKey"
    moved = broadcast_if_small(shut.join(t.tasks_putaway.select("PutAwayContainerPrimaryKey", task, "LocationPrimaryKey"), "PutAwayContainerPrimaryKey"), KEY_ROWS)
    # tasks and actions meet the moved rows at once; an action counts where its task is there, too
    seen = t.task_actions.select(task, "NewContainerPrimaryKey", F.lit(False).alias("_is_task")).unionByName(
        t.inventory_tasks.select(F.col("PrimaryKey").alias(task), F.lit(True).alias("_is_task")), allowMissingColumns=True)
    tasks_in = (
        seen.join(moved, task).withColumn("_known", F.max("_is_task").over(Window.partitionBy(task))).where("_known and not _is_task")
        .groupBy("d").agg(n, F.count_distinct(shown).alias("shown")).agg(F.sum("n").alias("n"), F.sum("shown").alias("shown"), *span(F.col("d")))
    )
    picked = daily.filter((F.col("WorkType") == "Pick") & (F.col("EventDate") >= recent)).agg(
        n, F.sum("OrdersCompleted").alias("orders"), F.sum("LinesCompleted").alias("lines"), F.sum("UnitsCompleted").alias("units"), *span(F.col("EventDate")))
    done = F.to_date(F.coalesce("PickCompleteDate", "TimeStamp"))
    full = F.coalesce("ActualPickQuantity", F.lit(0)) >= F.coalesce("RequiredPickQuantity", F.lit(0))
    skus = t.pick.filter(F.col("Sku").isNotNull() & F.col("UserName").isNotNull() & full & (done >= recent)).agg(n, F.count_distinct("Sku").alias("skus"), *span(done))
    parts = [
        _listed(stock, "n", {"Total SKUs On Hand": "skus", "Total Units On Hand": "units", "Total Locations Occupied": "places",
                             "Distinct Bins With Inventory": "bins", "Distinct Bin Compartments With Inventory": "places"}),
        _listed(boxes_in, "n", {"Orders Put Away": "orders"}),
        _listed(lines_in, "n", {"Units Put Away": "units", "SKUs Put Away": "skus"}),
        _listed(tasks_in, "n", {"Bin Presentations Put Away": "shown"}),
        _listed(picked, "n", {"Customer Orders Picked": "orders", "Customer Order Lines": "lines", "Units Picked": "units"}),
        _listed(skus, "n", {"Distinct SKUs Picked": "skus"}),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def visible_kpi(expected: DataFrame, kpi_long: DataFrame, as_of) -> DataFrame:
    """Q28: per KPI row, the expected source value against the report view
    over the recent window (0-vs-positive is what fails: the source's SKU count
    is window-wide while the view adds days)."""
    from opsgrain.plans.measures import KPI_ROWS
    recent = F.date_sub(F.lit(as_of), 7)
    names = F.create_map(*[x for _, n, _, _, v in KPI_ROWS for x in (F.lit(v), F.lit(n))])
    k = kpi_long.select(names[F.col("Metric")].alias("MetricName"), "Date", F.col("Value").cast("decimal(19,4)").alias("Value"))
    j = expected.join(k, "MetricName", "left")
    rec = F.col("Date") >= recent
    g = j.groupBy("MetricName", "SourceRows", "SourceValue", "SourceMinDate", "SourceMaxDate").agg(
        F.count("Date").alias("ReportRows"), F.count(F.when(rec, 1)).alias("_recent_rows"),
        F.coalesce(F.sum(F.when(rec, F.col("Value")).otherwise(0)), F.lit(0)).alias("ReportValue"),
        F.min(F.when(rec, F.col("Date"))).alias("ReportMinDate"), F.max(F.when(rec, F.col("Date"))).alias("ReportMaxDate"))
    sr, sv = F.coalesce(F.col("SourceRows"), F.lit(0)), F.coalesce(F.col("SourceValue"), F.lit(0))
    status = (F.when(sr == 0, "WARN").when(F.col("_recent_rows") == 0, "FAIL")
              .when((F.col("ReportValue") == 0) & (sv > 0), "FAIL").otherwise("PASS"))
    return g.select(F.lit("Daily KPI Summary Report").alias("PageName"), "MetricName", sr.alias("SourceRows"), "ReportRows",
                    sv.alias("SourceValue"), "ReportValue", "SourceMinDate", "SourceMaxDate", "ReportMinDate", "ReportMaxDate",
                    status.alias("Status"), F.concat(F.lit("window from "), _iso(recent), F.lit(".")).alias("Details"))


# ---- Q32 / Q34: visible inventory matrix and consolidation --------------------------------------------

def visible_inventory(matrix: DataFrame, inventory: DataFrame, containers: DataFrame, templates: DataFrame,
                      compartments: DataFrame, sizes: DataFrame) -> DataFrame:
    """Q32: the matrix re-derived from sources: labels, expected metric rows
    (labels × 18), expected total locations, completeness, unexpected rows and
    the '% of Total Bin(s)' sum (≈ 100 ± 0.5 when there are several labels)."""
    from opsgrain.plans.pages import MATRIX_METRICS, template_compartment_labels
    from opsgrain.sources.staging import latest_snapshot
    tc = template_compartment_labels(templates, compartments, sizes)
    c = latest_snapshot(containers).filter(F.coalesce(F.col("Status"), F.lit("")) != "Outside") \
        .select("TemplatePrimaryKey")
    per = c.groupBy("TemplatePrimaryKey").agg(F.count(F.lit(1)).alias("boxes"))
    cc = per.join(tc.select("TemplatePrimaryKey"), "TemplatePrimaryKey")
    labels = tc.select("CompartmentLabel").distinct()
    src = _one_row_join(latest_snapshot(inventory).agg(F.count(F.lit(1)).alias("inv")),
                        labels.agg(F.count(F.lit(1)).alias("el")), cc.agg(F.coalesce(F.sum("boxes"), F.lit(0)).alias("etl")))
    num = lambda c_: F.regexp_replace(c_, ",", "").try_cast("decimal(19,4)")
    rep = matrix.agg(
        F.count(F.lit(1)).alias("rr"), F.count_distinct("CompartmentLabel").alias("rl"), F.count_distinct("MetricName").alias("rm"),
        F.sum(F.when(F.col("MetricName") == "Total Locations", F.coalesce(num(F.col("MetricValue")), F.lit(0))).otherwise(0))
        .cast("decimal(19,4)").alias("rtl"),
        F.sum(F.when(F.col("MetricName") == "% of Total Bin(s)",
                     F.coalesce(num(F.regexp_replace(F.col("MetricValue"), "%", "")), F.lit(0)))).alias("pct"))
    names = F.array(*[F.lit(n) for n in MATRIX_METRICS])
    counts = matrix.groupBy("CompartmentLabel", "MetricName").agg(F.count(F.lit(1)).alias("c"))
    comp = labels.select("CompartmentLabel", F.explode(names).alias("MetricName")).join(
        counts, ["CompartmentLabel", "MetricName"], "left").agg(
        _cnt(F.col("c").isNull()).alias("miss"), F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).alias("dup"))
    unexp = matrix.join(labels.withColumn("_known", F.lit(True)), "CompartmentLabel", "left").agg(
        _cnt(F.col("_known").isNull() | ~F.col("MetricName").isin(MATRIX_METRICS)).alias("unexp"))
    j = _one_row_join(src, rep, comp, unexp)
    em = F.col("el") * 18
    pct = F.coalesce(F.col("pct"), F.lit(0)).cast("decimal(19,4)")
    status = (F.when((F.col("inv") > 0) & (F.col("el") == 0), "FAIL").when((em > 0) & (F.col("rr") != em), "FAIL")
              .when((F.col("el") > 0) & (F.col("rl") != F.col("el")), "FAIL").when((em > 0) & (F.col("rm") < 18), "FAIL")
              .when(F.col("miss") > 0, "FAIL").when(F.col("dup") > 0, "FAIL").when(F.col("unexp") > 0, "FAIL")
              .when(F.col("etl") != F.coalesce(F.col("rtl"), F.lit(0)), "FAIL")
              .when((F.col("el") > 1) & (F.abs(pct - 100) > 0.5), "FAIL").otherwise("PASS"))
    details = F.concat(
        F.lit("labels wanted: "), _s(F.col("el")), F.lit(", shown: "), _s(F.col("rl")), F.lit(", cells wanted: "),
        _s(em), F.lit(", in report: "), _s(F.col("rr")), F.lit(", positions wanted: "), _s(F.col("etl")),
        F.lit(", shown: "), _s(F.coalesce(F.col("rtl"), F.lit(0).cast("decimal(19,4)"))),
        F.lit(", cells missing: "), _s(F.col("miss")), F.lit(", cells repeated: "), _s(F.col("dup")),
        F.lit(", cells unknown: "), _s(F.col("unexp")), F.lit(", bin shares add to: "), _s(pct), F.lit("."))
    return j.select(
        F.lit("Inventory & Location Table Summary").alias("PageName"), F.lit("Inventory/location matrix metrics").alias("MetricName"),
        em.cast("bigint").alias("SourceRows"), F.col("rr").alias("ReportRows"), F.col("etl").cast("decimal(19,4)").alias("SourceValue"),
        F.coalesce(F.col("rtl"), F.lit(0)).cast("decimal(19,4)").alias("ReportValue"),
        *[F.lit(None).cast("date").alias(c) for c in ("SourceMinDate", "SourceMaxDate", "ReportMinDate", "ReportMaxDate")],
        status.alias("Status"), details.alias("Details"))


def visible_consolidation(report: DataFrame, source: DataFrame | None) -> DataFrame:
    """Q34: consolidation report rows and quantity against the source view."""
    j = consolidation_counts(report, source)
    details = F.concat(
        F.lit("in source: "),
        F.coalesce(_s(F.col("sr")), F.lit("unavailable")), F.lit(", in report: "), _s(F.col("n")), _row_quality_text(), F.lit("."))
    return j.select(
        F.lit("Consolidation Report").alias("PageName"), F.lit("Consolidation rows").alias("MetricName"), F.col("sr").alias("SourceRows"),
        F.col("n").alias("ReportRows"), F.col("sq").alias("SourceValue"), F.col("rq").alias("ReportValue"),
        *[F.lit(None).cast("date").alias(c) for c in ("SourceMinDate", "SourceMaxDate", "ReportMinDate", "ReportMaxDate")],
        _consolidation_status().alias("Status"), details.alias("Details"))
