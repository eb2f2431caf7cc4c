"""Registered queries for the event grain (E) and its roll-ups (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsgrain.functions.tsql import clock_ms
from opsgrain.operators import events as E
from opsgrain.oracle.core_sql import CORE_CTES, ROLLUP_CTES, clock_ms_sql
from opsgrain.plans import rollups as R
from opsgrain.plans.catalog import add_ctes, canon, materialized, register, sel

add_ctes(CORE_CTES)
add_ctes(ROLLUP_CTES)

ROLLUP_SPEC = (
    "OrdersCompleted:i, BinPresentationsCompleted:i, LinesCompleted:i, UnitsCompleted:i, TotalLoggedHours:u, "
    "TotalLoggedMinutes:u, ActiveHandleMinutes:u, MachineWaitMinutes:u, RateDenominatorHours:u, RateDenominatorSource, "
    "OrdersPerHour:d, BinsPerHour:d, UnitsPerHour:d, LinesPerHour:d, AverageHandleTimePerPresentationMinutes:d, "
    "EventRows:i, SessionEventRows:i, BinPresentationEventRows:i, PickEventRows:i, OrderEventRows:i, UnattributedEventRows:i"
)
TOTAL_SPEC = ROLLUP_SPEC.replace("RateDenominatorSource, ", "")
EVENT_SPEC = (
    "WorkType, EventType, EventKey, UserName, Port, EventDate:D, StartTime:T, EndTime:T, DurationMs:i, "
    "RateDenominatorMs:i, HandleMs:i, MachineWaitMs:i, OrderCompletedCount:i, BinPresentationCount:i, "
    "LineCompletedCount:i, UnitCompletedCount:i, SourceName, SourcePrimaryKey:i, FulfillmentOrderPrimaryKey:i, "
    "FulfillmentOrderLinePrimaryKey:i, ContainerBarcode, AttributionMethod"
)


def _sessions(t):
    lm = E.location_map(t.bin_presented, t.open_bin, t.close_bin)
    return E.work_sessions(t.sign_in, t.sign_out, lm)


def work_events(t):
    """The v2 work-event stream for a table catalogue, materialised once."""
    return materialized(t, "_work_events", lambda: E.work_events(t))


@register("E07_location_map", f"select LocationPrimaryKey, LocationBarcode from locmap")
def e07(t):
    return canon(E.location_map(t.bin_presented, t.open_bin, t.close_bin).select("LocationPrimaryKey", "LocationBarcode"))


@register("E08_work_sessions", "select " + sel(
    "WorkType, SignInPrimaryKey:i, SignOutPrimaryKey:i, UserName, LocationPrimaryKey:i, Port, SignInTime:T, SignOutTime:T, SessionMs:i"
) + " from sessions")
def e08(t):
    return canon(_sessions(t).select(
        "WorkType", "SignInPrimaryKey", "SignOutPrimaryKey", "UserName", "LocationPrimaryKey", "Port",
        "SignInTime", "SignOutTime", "SessionMs"))


@register("E04_pair_sessions", "select " + sel(
    "WorkType, LocationPrimaryKey:i, UserName, SignInPrimaryKey:i, SignOutPrimaryKey:i, SignInTime:T, SignOutTime:T"
) + " from sessions")
def e04(t):
    from opsgrain.operators.temporal import pair_sessions
    return canon(pair_sessions(t.sign_in, t.sign_out, ["WorkType", "LocationPrimaryKey", "UserName"]).select(
        "WorkType", "LocationPrimaryKey", "UserName", "SignInPrimaryKey", "SignOutPrimaryKey", "SignInTime", "SignOutTime"))


@register("E02_session_match", "select PrimaryKey, s_user from bin_presented bp join bin_sess s on s.bpk = bp.PrimaryKey")
def e02(t):
    a = E.attribute_bins(t.bin_presented, _sessions(t), t.pick, t.close_bin)
    return canon(a.filter(F.col("session_user").isNotNull()).select("PrimaryKey", F.col("session_user").alias("s_user")))


@register("E01_nearest_pick", "select bp.PrimaryKey, p.p_user from bin_presented bp left join bin_pick p on p.bpk = bp.PrimaryKey")
def e01(t):
    from opsgrain.operators.temporal import nearest_after
    picks = t.pick.filter(F.col("UserName").isNotNull()).select(
        "ContainerBarcode", "TimeStamp", "PrimaryKey", F.col("UserName").alias("p_user"))
    m = nearest_after(t.bin_presented, picks, ["ContainerBarcode"], "TimeStamp", "TimeStamp", ["PrimaryKey"], ["p_user"], "_pm")
    return canon(m.select("PrimaryKey", F.col("_pm.p_user").alias("p_user")))


@register("E03_nearest_close", "select " + sel("PrimaryKey:i, CloseTime:T") +
          " from (select bp.PrimaryKey, c.CloseTime from bin_presented bp left join bin_close c on c.bpk = bp.PrimaryKey)")
def e03(t):
    from opsgrain.operators.temporal import nearest_after_wild
    closes = t.close_bin.select("ContainerBarcode", "LocationPrimaryKey", "TimeStamp", "PrimaryKey")
    m = nearest_after_wild(t.bin_presented, closes, "PrimaryKey", ["ContainerBarcode"], "LocationPrimaryKey",
                           "TimeStamp", "TimeStamp", ["PrimaryKey"], [], "_cm")
    return canon(m.select("PrimaryKey", F.col("_cm.ts").alias("CloseTime")))


@register("E19_clock_seconds", "select PrimaryKey, BinActionTime, " + clock_ms_sql("BinActionTime") + " as ClockMs from bin_presented")
def e19(t):
    return canon(t.bin_presented.select("PrimaryKey", "BinActionTime", clock_ms(F.col("BinActionTime")).alias("ClockMs")))


def _event_subset(event_type: str):
    def fn(t):
        return canon(work_events(t).filter(F.col("EventType") == event_type))
    return fn


for _key, _et in [("E14_session_events", "SESSION"), ("E15_bin_events", "BIN_PRESENTATION"),
                  ("E16_line_events", "LINE_COMPLETED"), ("E17_order_events", "ORDER_COMPLETED")]:
    register(_key, f"select {sel(EVENT_SPEC)} from work_events where EventType = '{_et}'")(_event_subset(_et))


@register("E18_work_events", f"select {sel(EVENT_SPEC)} from work_events")
def e18(t):
    return canon(work_events(t))


@register("R05_by_user_work_type", f"select WorkType, Users, {sel(ROLLUP_SPEC)} from r05")
def r05(t):
    return canon(R.by_user_work_type(work_events(t)))


@register("R06_by_port_work_type", f"select WorkType, Ports, {sel(ROLLUP_SPEC)} from r06")
def r06(t):
    return canon(R.by_port_work_type(work_events(t)))


@register("R07_by_user", f"select Users, {sel(TOTAL_SPEC)} from r07")
def r07(t):
    return canon(R.by_user(work_events(t)))


@register("R08_by_port", f"select Ports, {sel(TOTAL_SPEC)} from r08")
def r08(t):
    return canon(R.by_port(work_events(t)))


@register("R09_daily", f"select {sel('EventDate:D, WorkType, Users, Ports')}, {sel(ROLLUP_SPEC)}, "
                       f"{sel('MinStartTime:T, MaxStartTime:T')} from r09")
def r09(t):
    return canon(R.daily(work_events(t)))
