"""The work-event grain (E05-E18): sessions, bin presentations, completed
lines and completed orders, one row per event with additive flags.

Durations are carried as exact integer milliseconds (``*Ms`` columns, bigint):
the source computes ``DATEDIFF_BIG(millisecond, …) / 1000.0`` cast to
decimal(19,3), so milliseconds are the same value without decimal arithmetic in
the hot path.  ``with_seconds`` adds the decimal(19,3) seconds columns of the
source views for display.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.functions.tsql import clock_ms, clock_seconds_whole, ms_between, ms_to_seconds, seconds_between
from opsgrain.operators import timeline
from opsgrain.operators.temporal import (
    interval_lookup,
    mode_by,
    nearest_after,
    nearest_after_many,
    pair_sessions,
)

EVENT_COLUMNS = [
    "WorkType", "EventType", "EventKey", "UserName", "Port", "EventDate", "StartTime", "EndTime",
    "DurationMs", "RateDenominatorMs", "HandleMs", "MachineWaitMs",
    "OrderCompletedCount", "BinPresentationCount", "LineCompletedCount", "UnitCompletedCount",
    "SourceName", "SourcePrimaryKey", "FulfillmentOrderPrimaryKey", "FulfillmentOrderLinePrimaryKey",
    "ContainerBarcode", "AttributionMethod",
]


BIN_COLUMNS = ["PrimaryKey", "TimeStamp", "LocationPrimaryKey", "LocationBarcode", "ContainerBarcode", "LocationTaskType", "BinActionTime"]


def location_map(bin_presented: DataFrame, open_bin: DataFrame, close_bin: DataFrame) -> DataFrame:
    """Most frequently seen barcode per location over three sources."""
    cols = ["LocationPrimaryKey", "LocationBarcode", "TimeStamp"]
    cand = (
        bin_presented.select(*cols)
        .unionByName(open_bin.select(*cols))
        .unionByName(close_bin.select(*cols))
        .filter(F.col("LocationPrimaryKey").isNotNull() & F.col("LocationBarcode").isNotNull())
    )
    return mode_by(cand, "LocationPrimaryKey", "LocationBarcode", "TimeStamp")


def work_sessions(sign_in: DataFrame, sign_out: DataFrame, locmap: DataFrame) -> DataFrame:
    """Paired sign-in/sign-out sessions of all work types with the port
    barcode and millisecond-exact session length."""
    return with_port(pair_sessions(sign_in, sign_out, ["WorkType", "LocationPrimaryKey", "UserName"]), locmap)


def with_port(s: DataFrame, locmap: DataFrame) -> DataFrame:
    """E08 from paired sessions."""
    lm = locmap.select("LocationPrimaryKey", F.col("LocationBarcode").alias("Port"))
    ms = ms_between("SignInTime", "SignOutTime")
    return s.join(lm, on="LocationPrimaryKey", how="left").select(
        "WorkType", "SignInPrimaryKey", "SignOutPrimaryKey", "UserName", "LocationPrimaryKey", "Port",
        "SignInTime", "SignOutTime",
        F.when(F.col("SignOutTime") > F.col("SignInTime"), ms).alias("SessionMs"),
        F.when(F.col("SignOutTime") > F.col("SignInTime"), ms_to_seconds(ms)).alias("SessionSeconds"),
    )


def _event(**cols) -> list:
    out = []
    for name in EVENT_COLUMNS:
        c = cols.get(name)
        out.append((c if c is not None else F.lit(None)).alias(name))
    return out


def _typed(df: DataFrame) -> DataFrame:
    types = {
        "WorkType": "string", "EventType": "string", "EventKey": "string", "UserName": "string", "Port": "string",
        "EventDate": "date", "StartTime": "timestamp", "EndTime": "timestamp",
        "DurationMs": "bigint", "RateDenominatorMs": "bigint", "HandleMs": "bigint", "MachineWaitMs": "bigint",
        "OrderCompletedCount": "int", "BinPresentationCount": "int", "LineCompletedCount": "int",
        "UnitCompletedCount": "bigint", "SourceName": "string", "SourcePrimaryKey": "bigint",
        "FulfillmentOrderPrimaryKey": "bigint", "FulfillmentOrderLinePrimaryKey": "bigint",
        "ContainerBarcode": "string", "AttributionMethod": "string",
    }
    return df.select(*[F.col(c).cast(types[c]).alias(c) for c in EVENT_COLUMNS])


def session_events(sessions: DataFrame) -> DataFrame:
    """One SESSION event per paired session; carries the rate denominator."""
    s = sessions.filter(F.col("SessionMs").isNotNull())
    return _typed(s.select(*_event(
        WorkType=F.col("WorkType"),
        EventType=F.lit("SESSION"),
        EventKey=F.concat_ws(":", F.col("WorkType"), F.col("SignInPrimaryKey").cast("string"), F.col("SignOutPrimaryKey").cast("string")),
        UserName=F.col("UserName"),
        Port=F.col("Port"),
        EventDate=F.to_date("SignInTime"),
        StartTime=F.col("SignInTime"),
        EndTime=F.col("SignOutTime"),
        DurationMs=F.col("SessionMs"),
        RateDenominatorMs=F.col("SessionMs"),
        HandleMs=F.lit(0), MachineWaitMs=F.lit(0),
        OrderCompletedCount=F.lit(0), BinPresentationCount=F.lit(0), LineCompletedCount=F.lit(0), UnitCompletedCount=F.lit(0),
        SourceName=F.concat(F.col("WorkType"), F.lit("-Session")),
        SourcePrimaryKey=F.col("SignInPrimaryKey"),
        AttributionMethod=F.lit("Paired SignIn/SignOut"),
    )))


def attribute_bins(bin_presented: DataFrame, sessions: DataFrame, pick: DataFrame, close_bin: DataFrame,
                   any_task_type: bool = False) -> DataFrame:
    """E02 + E01 + E03 for bin presentations: the containing session (latest
    sign-in, ties by lowest sign-in key), the nearest later pick by container
    with a user, and the nearest later close of the container at the same
    location (or either location unknown).  Adds ``session_user``,
    ``pick_user``, ``CloseTime``.

    Every matcher reads the presentations directly (no matcher consumes
    another's output), so the plan stays linear in the number of matchers:
    one window on (container, bucket) serves the pick match and both
    location-free close matches, one window on (container, location, bucket)
    the same-location close match, and one bucketed join the session match.
    The three results meet on the presentation key.
    """
    iv = sessions.select(
        "LocationPrimaryKey", "SignInTime", "SignOutTime", "SignInPrimaryKey",
        F.col("UserName").alias("s_user"), F.col("WorkType").alias("s_wt"),
    )
    by_session = interval_lookup(
        bin_presented, iv, point_id="PrimaryKey", keys=[("LocationPrimaryKey", "LocationPrimaryKey")],
        ts="TimeStamp", start="SignInTime", end="SignOutTime", tiebreak="SignInPrimaryKey", stream=["s_wt", "s_user"],
        values=["s_user"], out="_sm", match=None if any_task_type else ("LocationTaskType", "s_wt"), matches_only=True,
    )
    picks = pick.filter(F.col("UserName").isNotNull()).select(
        "ContainerBarcode", "TimeStamp", "PrimaryKey", F.col("UserName").alias("p_user"))
    closes = close_bin.select("ContainerBarcode", "LocationPrimaryKey", "TimeStamp", "PrimaryKey")
    spine = nearest_after_many(bin_presented, ["ContainerBarcode"], "TimeStamp", [
        ("_pm", picks, "TimeStamp", ["PrimaryKey"], ["p_user"]),
        ("_cw", closes.filter(F.col("LocationPrimaryKey").isNull()), "TimeStamp", ["PrimaryKey"], []),
        ("_ca", closes, "TimeStamp", ["PrimaryKey"], []),
    ])
    same_loc = nearest_after(
        bin_presented.filter(F.col("LocationPrimaryKey").isNotNull())
        .select("PrimaryKey", "ContainerBarcode", "LocationPrimaryKey", "TimeStamp"),
        closes.filter(F.col("LocationPrimaryKey").isNotNull()),
        ["ContainerBarcode", "LocationPrimaryKey"], "TimeStamp", "TimeStamp", ["PrimaryKey"], [], "_cs",
    ).select("PrimaryKey", "_cs")
    j = spine.join(same_loc, on="PrimaryKey", how="left").join(by_session, on="PrimaryKey", how="left")
    close = F.when(F.col("LocationPrimaryKey").isNull(), F.col("_ca")).otherwise(F.least(F.col("_cs"), F.col("_cw")))
    return j.select(
        *bin_presented.columns,
        F.col("_sm.s_user").alias("session_user"),
        F.col("_pm.p_user").alias("pick_user"),
        close.getField("ts").alias("CloseTime"),
    )


def bin_events(bin_presented: DataFrame, sessions: DataFrame, pick: DataFrame, close_bin: DataFrame) -> DataFrame:
    """One BIN_PRESENTATION event per presented bin, all task types."""
    return bin_event_rows(attribute_bins(bin_presented, sessions, pick, close_bin))


def bin_event_rows(a: DataFrame) -> DataFrame:
    """E15 over attributed bins (``session_user``, ``pick_user``, ``CloseTime``)."""
    wait = clock_ms(F.col("BinActionTime"))
    close_ok = F.col("CloseTime").isNotNull() & (F.col("CloseTime") >= F.col("TimeStamp"))
    handle = F.when(close_ok, ms_between("TimeStamp", "CloseTime")).otherwise(wait)
    user = F.coalesce(F.col("session_user"), F.col("pick_user"))
    method = (
        F.when(F.col("session_user").isNotNull(), "Task session")
        .when(F.col("pick_user").isNotNull(), "Nearest pick by container")
        .otherwise("Unattributed")
    )
    return _typed(a.select(*_event(
        WorkType=F.coalesce(F.nullif(F.col("LocationTaskType"), F.lit("")), F.lit("Unknown")),
        EventType=F.lit("BIN_PRESENTATION"),
        EventKey=F.col("PrimaryKey").cast("string"),
        UserName=user,
        Port=F.col("LocationBarcode"),
        EventDate=F.to_date("TimeStamp"),
        StartTime=F.col("TimeStamp"),
        EndTime=F.col("CloseTime"),
        DurationMs=handle, RateDenominatorMs=F.lit(0), HandleMs=handle, MachineWaitMs=wait,
        OrderCompletedCount=F.lit(0), BinPresentationCount=F.lit(1), LineCompletedCount=F.lit(0), UnitCompletedCount=F.lit(0),
        SourceName=F.lit("BinPresented"),
        SourcePrimaryKey=F.col("PrimaryKey"),
        ContainerBarcode=F.col("ContainerBarcode"),
        AttributionMethod=method,
    )))


def completed_line(pick: DataFrame):
    act = F.coalesce(F.col("ActualPickQuantity"), F.lit(0))
    req = F.coalesce(F.col("RequiredPickQuantity"), F.lit(0))
    done = act >= req
    return done, F.when(done, act).otherwise(F.lit(0))


def line_events(pick: DataFrame) -> DataFrame:
    """One LINE_COMPLETED event per pick row with a user."""
    p = pick.filter(F.col("UserName").isNotNull())
    done, units = completed_line(p)
    end = F.coalesce(F.col("PickCompleteDate"), F.col("TimeStamp"))
    dur_ok = F.col("PickCompleteDate").isNotNull() & (F.col("PickCompleteDate") >= F.col("TimeStamp"))
    return _typed(p.select(*_event(
        WorkType=F.lit("Pick"),
        EventType=F.lit("LINE_COMPLETED"),
        EventKey=F.col("PrimaryKey").cast("string"),
        UserName=F.col("UserName"),
        Port=F.col("LocationBarcode"),
        EventDate=F.to_date(end),
        StartTime=F.col("TimeStamp"),
        EndTime=end,
        DurationMs=F.when(dur_ok, ms_between("TimeStamp", "PickCompleteDate")),
        RateDenominatorMs=F.lit(0), HandleMs=F.lit(0), MachineWaitMs=F.lit(0),
        OrderCompletedCount=F.lit(0), BinPresentationCount=F.lit(0),
        LineCompletedCount=F.when(done, 1).otherwise(0), UnitCompletedCount=units,
        SourceName=F.lit("Pick"),
        SourcePrimaryKey=F.col("PrimaryKey"),
        FulfillmentOrderPrimaryKey=F.col("TransportOrderPrimaryKey"),
        FulfillmentOrderLinePrimaryKey=F.col("PickPrimaryKey"),
        ContainerBarcode=F.col("ContainerBarcode"),
        AttributionMethod=F.lit("Pick row"),
    )))


def orders_with_pick_flag(order_rows: DataFrame, pick: DataFrame) -> DataFrame:
    """Adds ``has_pick``: some pick shares the order key or (non-NULL) order number.

    The source writes one NOT EXISTS with an OR, which Spark can only plan as a
    nested-loop anti join; here each key side is de-duplicated first and joined
    on equality (two hash/sort-merge joins)."""
    by_key = pick.select(F.col("TransportOrderPrimaryKey").alias("OrderPrimaryKey")).dropna().dropDuplicates() \
        .withColumn("_k1", F.lit(True))
    by_num = pick.select(F.col("OrderNumber")).dropna().dropDuplicates().withColumn("_k2", F.lit(True))
    o = order_rows.join(by_key, on="OrderPrimaryKey", how="left").join(by_num, on="OrderNumber", how="left")
    return o.withColumn("has_pick", F.coalesce(F.col("_k1"), F.col("_k2"), F.lit(False))).drop("_k1", "_k2")


def order_events(order_rows: DataFrame, pick: DataFrame) -> DataFrame:
    """One ORDER_COMPLETED event per completed order row; line and unit
    counts come from the order row only when no pick covers the order."""
    return order_event_rows(orders_with_pick_flag(order_rows.filter(F.col("CompletedDate").isNotNull()), pick))


def order_event_rows(o: DataFrame) -> DataFrame:
    """E17 over completed orders with ``has_pick``."""
    return _typed(o.select(*_event(
        WorkType=F.lit("Pick"),
        EventType=F.lit("ORDER_COMPLETED"),
        EventKey=F.col("PrimaryKey").cast("string"),
        UserName=F.col("UserName"),
        Port=F.col("Port"),
        EventDate=F.to_date("CompletedDate"),
        StartTime=F.col("CompletedDate"),
        EndTime=F.col("CompletedDate"),
        DurationMs=F.lit(None), RateDenominatorMs=F.lit(0), HandleMs=F.lit(0), MachineWaitMs=F.lit(0),
        OrderCompletedCount=F.lit(1), BinPresentationCount=F.lit(0),
        LineCompletedCount=F.when(F.col("has_pick"), 0).otherwise(F.coalesce(F.col("OrderLineCount"), F.lit(0))),
        UnitCompletedCount=F.when(F.col("has_pick"), 0).otherwise(F.coalesce(F.col("EachUnitCount"), F.lit(0))),
        SourceName=F.lit("Order"),
        SourcePrimaryKey=F.col("PrimaryKey"),
        FulfillmentOrderPrimaryKey=F.col("OrderPrimaryKey"),
        AttributionMethod=F.lit("Reported order row"),
    )))


def work_events(t) -> DataFrame:
    """The v2 work-event stream over a table catalogue ``t``
    (``opsgrain.sources.adapter.Tables`` or anything with the same attributes).

    It reads typed events (``timeline.typed``): eight scans and twelve
    partitionings in all, where the separate matchers above read their tables
    38 times."""
    def sessions() -> DataFrame:
        return timeline.paired_sessions(timeline.typed(t, "SignIn", "SignOut"))

    lm = timeline.barcode_of_location(timeline.typed(t, "BinPresented", "OpenBin", "CloseBin"))
    bins = timeline.with_session_user(timeline.typed(t, "BinPresented").select(*BIN_COLUMNS), sessions())
    bins = timeline.with_later_events(bins, timeline.typed(t, "Pick", "CloseBin"), timeline.typed(t, "BinPresented", "Pick", "CloseBin"))
    return (
        session_events(with_port(sessions(), lm))
        .unionByName(bin_event_rows(bins))
        .unionByName(line_events(timeline.typed(t, "Pick")))
        .unionByName(order_event_rows(timeline.orders_with_pick_flag(timeline.typed(t, "Order", "Pick"))))
    )


def with_seconds(ev: DataFrame) -> DataFrame:
    """Adds the source view's decimal(19,3) seconds columns."""
    return (
        ev.withColumn("DurationSeconds", ms_to_seconds(F.col("DurationMs")))
        .withColumn("RateDenominatorSeconds", ms_to_seconds(F.col("RateDenominatorMs")))
        .withColumn("HandleSeconds", ms_to_seconds(F.col("HandleMs")))
        .withColumn("MachineWaitSeconds", ms_to_seconds(F.col("MachineWaitMs")))
    )


# ---- v1 stream (E05, E09-E13) ------------------------------------------------------

V1_COLUMNS = [
    "EventType", "EventKey", "UserName", "Port", "EventDate", "StartTime", "EndTime", "DurationSeconds",
    "MachineWaitSeconds", "OrderCompletedCount", "BinPresentationCount", "LineCompletedCount", "UnitCompletedCount",
    "SourcePrimaryKey", "FulfillmentOrderPrimaryKey", "FulfillmentOrderLinePrimaryKey", "ContainerBarcode",
    "AttributionMethod",
]
_V1_TYPES = {
    "EventType": "string", "EventKey": "string", "UserName": "string", "Port": "string", "EventDate": "date",
    "StartTime": "timestamp", "EndTime": "timestamp", "DurationSeconds": "bigint", "MachineWaitSeconds": "bigint",
    "OrderCompletedCount": "int", "BinPresentationCount": "int", "LineCompletedCount": "int",
    "UnitCompletedCount": "bigint", "SourcePrimaryKey": "bigint", "FulfillmentOrderPrimaryKey": "bigint",
    "FulfillmentOrderLinePrimaryKey": "bigint", "ContainerBarcode": "string", "AttributionMethod": "string",
}


def _v1(df: DataFrame, **cols) -> DataFrame:
    cols.setdefault("EventDate", F.to_date(cols["StartTime"]))
    return df.select(*[(cols.get(c) if cols.get(c) is not None else F.lit(None)).cast(_V1_TYPES[c]).alias(c)
                       for c in V1_COLUMNS])


def pick_sessions_v1(sign_in: DataFrame, sign_out: DataFrame) -> DataFrame:
    """Pick-only pairing without a work-type key."""
    ins = sign_in.filter(F.col("WorkType") == "Pick")
    outs = sign_out.filter(F.col("WorkType") == "Pick")
    return pair_sessions(ins, outs, ["LocationPrimaryKey", "UserName"])


def bin_events_v1(bin_presented: DataFrame, sessions_v1: DataFrame, pick: DataFrame, close_bin: DataFrame) -> DataFrame:
    """Pick / OnDemand presentations; user by Pick session (any type),
    else nearest pick by container; durations in whole seconds (boundaries)."""
    bp = bin_presented.filter(F.col("LocationTaskType").isin("Pick", "OnDemand"))
    sess = sessions_v1.withColumn("WorkType", F.lit("Pick"))
    return bin_event_rows_v1(attribute_bins(bp, sess, pick, close_bin, any_task_type=True))


def bin_event_rows_v1(a: DataFrame) -> DataFrame:
    """E09 over attributed bins."""
    wait = clock_seconds_whole(F.col("BinActionTime"))
    close_ok = F.col("CloseTime").isNotNull() & (F.col("CloseTime") >= F.col("TimeStamp"))
    return _v1(
        a,
        EventType=F.lit("BIN_PRESENTATION"), EventKey=F.col("PrimaryKey").cast("string"),
        UserName=F.coalesce(F.col("session_user"), F.col("pick_user")), Port=F.col("LocationBarcode"),
        StartTime=F.col("TimeStamp"), EndTime=F.col("CloseTime"),
        DurationSeconds=F.when(close_ok, seconds_between("TimeStamp", "CloseTime")).otherwise(wait),
        MachineWaitSeconds=wait,
        OrderCompletedCount=F.lit(0), BinPresentationCount=F.lit(1), LineCompletedCount=F.lit(0), UnitCompletedCount=F.lit(0),
        SourcePrimaryKey=F.col("PrimaryKey"), ContainerBarcode=F.col("ContainerBarcode"),
        AttributionMethod=F.when(F.col("session_user").isNotNull(), "Pick session")
        .when(F.col("pick_user").isNotNull(), "Nearest pick by container").otherwise("Unattributed"),
    )


def pick_events_v1(pick: DataFrame) -> DataFrame:
    """One PICK_COMPLETED event per pick with a user; a line when the pick
    has a pick key or a line percentage; units only when actual >= required."""
    p = pick.filter(F.col("UserName").isNotNull())
    pct = F.col("PercentOfOrderLine") if "PercentOfOrderLine" in p.columns else F.lit(None)
    _, units = completed_line(p)
    dur_ok = F.col("PickCompleteDate").isNotNull() & (F.col("PickCompleteDate") >= F.col("TimeStamp"))
    return _v1(
        p,
        EventType=F.lit("PICK_COMPLETED"), EventKey=F.col("PrimaryKey").cast("string"), UserName=F.col("UserName"),
        Port=F.col("LocationBarcode"), StartTime=F.col("TimeStamp"),
        EndTime=F.coalesce(F.col("PickCompleteDate"), F.col("TimeStamp")),
        DurationSeconds=F.when(dur_ok, seconds_between("TimeStamp", "PickCompleteDate")),
        OrderCompletedCount=F.lit(0), BinPresentationCount=F.lit(0),
        LineCompletedCount=F.when(F.col("PickPrimaryKey").isNotNull() | pct.isNotNull(), 1).otherwise(0),
        UnitCompletedCount=units, SourcePrimaryKey=F.col("PrimaryKey"),
        FulfillmentOrderPrimaryKey=F.col("TransportOrderPrimaryKey"), FulfillmentOrderLinePrimaryKey=F.col("PickPrimaryKey"),
        ContainerBarcode=F.col("ContainerBarcode"), AttributionMethod=F.lit("Pick row"),
    )


def completed_orders_v1(history: DataFrame) -> DataFrame:
    """The last 'Completed' status row per (order, user, day)."""
    h = history.filter(F.col("Status") == "Completed")
    g = h.groupBy("FulfillmentOrderPrimaryKey", "UserName", F.to_date("StatusDate").alias("_day")).agg(
        F.max(F.struct("StatusDate", "PrimaryKey")).alias("_last"))
    return g.select("FulfillmentOrderPrimaryKey", "UserName", F.col("_last.StatusDate").alias("CompletedTime"))


def order_port_mode(fulfillment_orders: DataFrame, pick: DataFrame) -> DataFrame:
    """Per fulfillment order, the most frequent pick port of its order
    number (ties by port text)."""
    p = pick.filter(F.col("LocationBarcode").isNotNull()).select("OrderNumber", "LocationBarcode")
    fo = fulfillment_orders.select(F.col("PrimaryKey").alias("FulfillmentOrderPrimaryKey"),
                                   F.col("ExternalOrderNumber").alias("OrderNumber"))
    counts = fo.join(p, "OrderNumber").groupBy("FulfillmentOrderPrimaryKey", "LocationBarcode").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("FulfillmentOrderPrimaryKey").agg(
        F.min_by("LocationBarcode", F.struct(-F.col("n"), F.col("LocationBarcode"))).alias("Port"))
    return best


def order_events_v1(history: DataFrame, fulfillment_orders: DataFrame, pick: DataFrame) -> DataFrame:
    """E11 + E12: ORDER_COMPLETED events of the v1 stream."""
    co = completed_orders_v1(history).join(order_port_mode(fulfillment_orders, pick), "FulfillmentOrderPrimaryKey", "left")
    key = F.concat(F.col("FulfillmentOrderPrimaryKey").cast("string"), F.lit(":"), F.coalesce(F.col("UserName"), F.lit("")),
                   F.lit(":"), F.coalesce(F.col("Port"), F.lit("")))
    return _v1(
        co,
        EventType=F.lit("ORDER_COMPLETED"), EventKey=key, UserName=F.col("UserName"), Port=F.col("Port"),
        StartTime=F.col("CompletedTime"), EndTime=F.col("CompletedTime"),
        OrderCompletedCount=F.lit(1), BinPresentationCount=F.lit(0), LineCompletedCount=F.lit(0), UnitCompletedCount=F.lit(0),
        SourcePrimaryKey=F.col("FulfillmentOrderPrimaryKey"), FulfillmentOrderPrimaryKey=F.col("FulfillmentOrderPrimaryKey"),
        AttributionMethod=F.lit("Completed status history"),
    )


def work_events_v1(t) -> DataFrame:
    """The v1 work-event stream = E09 ∪ E10 ∪ (E11 + E12)."""
    bins = timeline.typed(t, "BinPresented").select(*BIN_COLUMNS).where(F.col("LocationTaskType").isin("Pick", "OnDemand"))
    sessions = timeline.paired_sessions(timeline.typed(t, "SignIn", "SignOut").where("WorkType = 'Pick'"))
    bins = timeline.with_session_user(bins, sessions, any_task_type=True)
    bins = timeline.with_later_events(bins, timeline.typed(t, "Pick", "CloseBin"), timeline.typed(t, "BinPresented", "Pick", "CloseBin"))
    return (
        bin_event_rows_v1(bins)
        .unionByName(pick_events_v1(t.pick))
        .unionByName(order_events_v1(t.status_history, t.fulfillment_orders, t.pick))
    )
