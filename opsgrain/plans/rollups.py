"""Roll-ups on the work-event grain.

All aggregates are plain ``groupBy().agg()`` with map-side partial
aggregation, so a hot user/port reaches the shuffle as one partial row per
task.  Hours and minutes follow the source's ``CAST(x / 3600.0 AS
decimal(19,4))``, computed exactly from integer milliseconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.functions.tsql import ms_to_dec4

HOUR_MS = 3_600_000
MINUTE_MS = 60_000

COUNT_COLUMNS = ["OrdersCompleted", "BinPresentationsCompleted", "LinesCompleted", "UnitsCompleted"]
EVIDENCE_COLUMNS = ["EventRows", "SessionEventRows", "BinPresentationEventRows", "PickEventRows",
                    "OrderEventRows", "UnattributedEventRows"]
RATE_COLUMNS = ["OrdersPerHour", "BinsPerHour", "UnitsPerHour", "LinesPerHour"]


def _flag(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def _aggregates() -> list[Column]:
    return [
        F.sum("OrderCompletedCount").cast("bigint").alias("OrdersCompleted"),
        F.sum("BinPresentationCount").cast("bigint").alias("BinPresentationsCompleted"),
        F.sum("LineCompletedCount").cast("bigint").alias("LinesCompleted"),
        F.sum("UnitCompletedCount").cast("bigint").alias("UnitsCompleted"),
        F.sum(F.coalesce(F.col("RateDenominatorMs"), F.lit(0))).cast("bigint").alias("_session_ms"),
        F.sum(F.coalesce(F.col("HandleMs"), F.lit(0))).cast("bigint").alias("_handle_ms"),
        F.sum(F.coalesce(F.col("MachineWaitMs"), F.lit(0))).cast("bigint").alias("_wait_ms"),
        F.count(F.lit(1)).alias("EventRows"),
        _flag(F.col("EventType") == "SESSION").alias("SessionEventRows"),
        _flag(F.col("EventType") == "BIN_PRESENTATION").alias("BinPresentationEventRows"),
        _flag(F.col("SourceName") == "Pick").alias("PickEventRows"),
        _flag(F.col("EventType") == "ORDER_COMPLETED").alias("OrderEventRows"),
        _flag(F.col("AttributionMethod") == "Unattributed").alias("UnattributedEventRows"),
    ]


def _rate(count: str, denom_ms: Column) -> Column:
    return F.when(denom_ms > 0, F.col(count) * F.lit(HOUR_MS) / denom_ms)


def _finish(agg: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Denominator rule: session seconds if > 0, else handle seconds."""
    s, h = F.col("_session_ms"), F.col("_handle_ms")
    d = agg.withColumn("_denom_ms", F.when(s > 0, s).otherwise(h)).withColumn(
        "RateDenominatorSource",
        F.when(s > 0, "SESSION").when(h > 0, "HANDLE_FALLBACK").otherwise("NONE"),
    )
    dm = F.col("_denom_ms")
    return d.select(
        *keys,
        *COUNT_COLUMNS,
        ms_to_dec4("_session_ms", HOUR_MS).alias("TotalLoggedHours"),
        ms_to_dec4("_session_ms", MINUTE_MS).alias("TotalLoggedMinutes"),
        ms_to_dec4("_handle_ms", MINUTE_MS).alias("ActiveHandleMinutes"),
        ms_to_dec4("_wait_ms", MINUTE_MS).alias("MachineWaitMinutes"),
        ms_to_dec4("_denom_ms", HOUR_MS).alias("RateDenominatorHours"),
        "RateDenominatorSource",
        _rate("OrdersCompleted", dm).alias("OrdersPerHour"),
        _rate("BinPresentationsCompleted", dm).alias("BinsPerHour"),
        _rate("UnitsCompleted", dm).alias("UnitsPerHour"),
        _rate("LinesCompleted", dm).alias("LinesPerHour"),
        F.when(F.col("BinPresentationsCompleted") > 0,
               F.col("_handle_ms") / (F.col("BinPresentationsCompleted") * F.lit(MINUTE_MS)))
        .alias("AverageHandleTimePerPresentationMinutes"),
        *EVIDENCE_COLUMNS,
        *extra,
    )


def by_user_work_type(ev: DataFrame) -> DataFrame:
    """Per (WorkType, user); events without a user are left out."""
    agg = ev.filter(F.col("UserName").isNotNull()).groupBy("WorkType", F.col("UserName").alias("Users")).agg(*_aggregates())
    return _finish(agg, ["WorkType", "Users"])


def by_port_work_type(ev: DataFrame) -> DataFrame:
    """Per (WorkType, port); a missing port is 'Unattributed'."""
    agg = ev.groupBy("WorkType", F.coalesce(F.col("Port"), F.lit("Unattributed")).alias("Ports")).agg(*_aggregates())
    return _finish(agg, ["WorkType", "Ports"])


def daily(ev: DataFrame) -> DataFrame:
    """The daily grain, date × work type × user × port (flagship)."""
    agg = ev.groupBy(
        "EventDate", "WorkType",
        F.coalesce(F.col("UserName"), F.lit("Unattributed")).alias("Users"),
        F.coalesce(F.col("Port"), F.lit("Unattributed")).alias("Ports"),
    ).agg(*_aggregates(), F.min("StartTime").alias("MinStartTime"), F.max("StartTime").alias("MaxStartTime"))
    return _finish(agg, ["EventDate", "WorkType", "Users", "Ports"], ["MinStartTime", "MaxStartTime"])


def total_over_work_types(rollup: DataFrame, key: str) -> DataFrame:
    """All work types of R05 / R06 summed per user or port.

    The already-rounded decimal hours are summed (rounding happens between the
    two levels, as in the source) and the rates are re-divided."""
    dec_cols = ["TotalLoggedHours", "TotalLoggedMinutes", "ActiveHandleMinutes", "MachineWaitMinutes", "RateDenominatorHours"]
    agg = rollup.groupBy(key).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in COUNT_COLUMNS],
        *[F.sum(c).cast("decimal(38,4)").alias(c) for c in dec_cols],
        *[F.sum(c).cast("bigint").alias(c) for c in EVIDENCE_COLUMNS],
    )
    hours_units = (F.col("RateDenominatorHours") * 10000).cast("bigint")
    handle_units = (F.col("ActiveHandleMinutes") * 10000).cast("bigint")

    def rate(c: str) -> Column:
        return F.when(F.col("RateDenominatorHours") > 0, F.col(c) * F.lit(10000) / hours_units)

    return agg.select(
        key, *COUNT_COLUMNS, *dec_cols,
        rate("OrdersCompleted").alias("OrdersPerHour"),
        rate("BinPresentationsCompleted").alias("BinsPerHour"),
        rate("UnitsCompleted").alias("UnitsPerHour"),
        rate("LinesCompleted").alias("LinesPerHour"),
        F.when(F.col("BinPresentationsCompleted") > 0,
               handle_units / (F.col("BinPresentationsCompleted") * F.lit(10000)))
        .alias("AverageHandleTimePerPresentationMinutes"),
        *EVIDENCE_COLUMNS,
    )


def by_user(ev: DataFrame) -> DataFrame:
    """R07."""
    return total_over_work_types(by_user_work_type(ev), "Users")


def by_port(ev: DataFrame) -> DataFrame:
    """R08."""
    return total_over_work_types(by_port_work_type(ev), "Ports")


# ---- drill-through (R12-R14) --------------------------------------------------------

def _trace_filter(df: DataFrame, user_col: str, port_col: str, work_type=None, users=None, ports=None,
                  event_date=None) -> DataFrame:
    """``(@p IS NULL OR col = @p)``: only supplied parameters filter."""
    if work_type is not None:
        df = df.filter(F.col("WorkType") == F.lit(work_type))
    if users is not None:
        df = df.filter(F.col(user_col) == F.lit(users))
    if ports is not None:
        df = df.filter(F.col(port_col) == F.lit(ports))
    if event_date is not None:
        df = df.filter(F.col("EventDate") == F.lit(event_date).cast("date"))
    return df


def _traced_events(ev: DataFrame, **filters) -> DataFrame:
    e = ev.withColumn("Users", F.coalesce(F.col("UserName"), F.lit("Unattributed"))) \
        .withColumn("Ports", F.coalesce(F.col("Port"), F.lit("Unattributed")))
    return _trace_filter(e, "Users", "Ports", **filters)


def trace_daily(daily_df: DataFrame, work_type="Pick", users=None, ports=None, event_date=None) -> DataFrame:
    """The daily grain filtered by optional work type / user / port / date."""
    return _trace_filter(daily_df, "Users", "Ports", work_type, users, ports, event_date)


def trace_summary(ev: DataFrame, work_type="Pick", users=None, ports=None, event_date=None) -> DataFrame:
    """Filtered events grouped by work type, event type, source, attribution."""
    df = _traced_events(ev, work_type=work_type, users=users, ports=ports, event_date=event_date)
    return df.groupBy("WorkType", "EventType", "SourceName", "AttributionMethod").agg(
        F.count(F.lit(1)).alias("EventRows"),
        F.sum("OrderCompletedCount").cast("bigint").alias("OrdersCompleted"),
        F.sum("BinPresentationCount").cast("bigint").alias("BinPresentationsCompleted"),
        F.sum("LineCompletedCount").cast("bigint").alias("LinesCompleted"),
        F.sum("UnitCompletedCount").cast("bigint").alias("UnitsCompleted"),
        F.sum(F.coalesce(F.col("RateDenominatorMs"), F.lit(0))).cast("bigint").alias("_r"),
        F.sum(F.coalesce(F.col("HandleMs"), F.lit(0))).cast("bigint").alias("_h"),
        F.sum(F.coalesce(F.col("MachineWaitMs"), F.lit(0))).cast("bigint").alias("_w"),
        F.min("StartTime").alias("MinStartTime"),
        F.max("StartTime").alias("MaxStartTime"),
    ).select(
        "WorkType", "EventType", "SourceName", "AttributionMethod", "EventRows", *COUNT_COLUMNS,
        ms_to_dec4("_r", MINUTE_MS).alias("RateDenominatorMinutes"), ms_to_dec4("_h", MINUTE_MS).alias("HandleMinutes"),
        ms_to_dec4("_w", MINUTE_MS).alias("MachineWaitMinutes"), "MinStartTime", "MaxStartTime",
    )


TRACE_COLUMNS = [
    "EventDate", "WorkType", "EventType", "SourceName", "SourcePrimaryKey", "AttributionMethod", "Users", "Ports",
    "StartTime", "EndTime", "DurationSeconds", "RateDenominatorSeconds", "HandleSeconds", "MachineWaitSeconds",
    "OrderCompletedCount", "BinPresentationCount", "LineCompletedCount", "UnitCompletedCount",
    "FulfillmentOrderPrimaryKey", "FulfillmentOrderLinePrimaryKey", "ContainerBarcode",
]


def trace_events(ev: DataFrame, n: int = 500, work_type="Pick", users=None, ports=None, event_date=None) -> DataFrame:
    """Event drill-through, first ``n`` by (StartTime, EventType,
    SourceName, SourcePrimaryKey); the limit is the report's feature.  Spark
    plans orderBy+limit as a per-partition top-n (TakeOrderedAndProject)."""
    from opsgrain.operators.events import with_seconds
    df = with_seconds(_traced_events(ev, work_type=work_type, users=users, ports=ports, event_date=event_date))
    return df.orderBy(F.col("StartTime").asc_nulls_first(), "EventType", "SourceName", "SourcePrimaryKey") \
        .limit(n).select(*TRACE_COLUMNS)


# ---- v1 roll-ups (R01-R04) and old-vs-new comparison (R10-R11) ------------------------

def rollup_v1(ev1: DataFrame, dims: Sequence[str] = ("Users",), by_date: bool = False) -> DataFrame:
    """R01-R04 over the v1 stream: by user (users not NULL) or by port (NULL ->
    'Unattributed'), optionally per EventDate.  Seconds are summed durations of
    every event; hours/minutes are exact quotients (double)."""
    dim = dims[0]
    if dim == "Users":
        df = ev1.filter(F.col("UserName").isNotNull()).withColumn("Users", F.col("UserName"))
    else:
        df = ev1.withColumn("Ports", F.coalesce(F.col("Port"), F.lit("Unattributed")))
    keys = (["EventDate"] if by_date else []) + [dim]
    agg = df.groupBy(*keys).agg(
        F.sum("OrderCompletedCount").cast("bigint").alias("OrdersCompleted"),
        F.sum("BinPresentationCount").cast("bigint").alias("BinPresentationsCompleted"),
        F.sum("LineCompletedCount").cast("bigint").alias("LinesCompleted"),
        F.sum("UnitCompletedCount").cast("bigint").alias("UnitsCompleted"),
        F.sum(F.coalesce(F.col("DurationSeconds"), F.lit(0))).cast("bigint").alias("_secs"),
        F.sum(F.coalesce(F.col("MachineWaitSeconds"), F.lit(0))).cast("bigint").alias("_wait"),
        F.count(F.lit(1)).alias("EventRows"),
        _flag(F.col("AttributionMethod") == "Unattributed").alias("UnattributedEventRows"),
    )
    secs = F.col("_secs")

    def rate(c: str) -> Column:
        return F.when(secs > 0, F.col(c) * F.lit(3600) / secs)

    return agg.select(
        *keys, *COUNT_COLUMNS,
        (secs / F.lit(3600)).alias("TotalLoggedHours"), (secs / F.lit(60)).alias("TotalLoggedMinutes"),
        (F.col("_wait") / F.lit(60)).alias("MachineWaitMinutes"),
        rate("OrdersCompleted").alias("OrdersPerHour"), rate("BinPresentationsCompleted").alias("BinsPerHour"),
        rate("UnitsCompleted").alias("UnitsPerHour"), rate("LinesCompleted").alias("LinesPerHour"),
        F.when(F.col("BinPresentationsCompleted") > 0, secs / (F.col("BinPresentationsCompleted") * F.lit(60)))
        .alias("AverageHandleTimePerPresentationMinutes"),
        "EventRows", "UnattributedEventRows",
    )


# Old helper view (by dimension suffix) -> (its value column, comparison column).
COMPARE_OLD = [
    ("OrdersCompleted", "OrdersCompleted", "OldOrdersCompleted"),
    ("BinPresentationsCompleted", "BinPresentationsCompleted", "OldBinPresentationsCompleted"),
    ("LinesCompleted", "LinesCompleted", "OldLinesCompleted"),
    ("UnitsCompleted", "UnitsCompleted", "OldUnitsCompleted"),
    ("OrdersPerHour", "OrdersPerHourPer{dim}", "OldOrdersPerHour"),
    ("BinsPerHour", "BinsPerHour", "OldBinsPerHour"),
    ("UnitsPerHour", "UnitsPerHour", "OldUnitsPerHour"),
    ("LinesperHour", "LinesPerHour", "OldLinesPerHour"),
    ("MachineWaitTime", "MachineWaitTime", "OldMachineWaitTime"),
    ("AverageHandlingTime", "AverageHandlingTime", "OldAverageHandleTime"),
    ("TotalLoggedTime", "TotalLoggedTime", "OldTotalLoggedTime"),
]
COMPARE_NEW = [
    ("OrdersCompleted", "NewOrdersCompleted"), ("BinPresentationsCompleted", "NewBinPresentationsCompleted"),
    ("LinesCompleted", "NewLinesCompleted"), ("UnitsCompleted", "NewUnitsCompleted"),
    ("OrdersPerHour", "NewOrdersPerHour"), ("BinsPerHour", "NewBinsPerHour"), ("UnitsPerHour", "NewUnitsPerHour"),
    ("LinesPerHour", "NewLinesPerHour"), ("MachineWaitMinutes", "NewMachineWaitMinutes"),
    ("AverageHandleTimePerPresentationMinutes", "NewAverageHandleTimePerPresentationMinutes"),
    ("TotalLoggedMinutes", "NewTotalLoggedMinutes"), ("EventRows", "EventRows"), ("UnattributedEventRows", "UnattributedEventRows"),
]


def old_side_from_helpers(helpers: dict, dim: str) -> DataFrame:
    """The source's "old" side: distinct union of the eleven helper views' keys,
    one left join per view.  ``helpers`` maps the view stem ('OrdersCompleted',
    'LinesperHour', …) to a helper DataFrame keyed by ``dim``."""
    suffix = "User" if dim == "Users" else "Port"
    keys = None
    for stem, _, _ in COMPARE_OLD:
        k = helpers[stem].select(dim)
        keys = k if keys is None else keys.union(k)
    old = keys.distinct()
    for stem, col, out in COMPARE_OLD:
        old = old.join(helpers[stem].select(dim, F.col(col.format(dim=suffix)).alias(out)), dim, "left")
    return old


def old_side_from_rollup(rollup: DataFrame, dim: str) -> DataFrame:
    """Same result as ``old_side_from_helpers`` when the helpers are the
    P01-P22 views of one roll-up (R05 / R06): every helper is a projection of
    the same Pick row, so the eleven joins collapse into one projection."""
    from opsgrain.plans.pages import helper_columns
    return helper_columns(rollup, dim).select(dim, *[F.col(out) for _, _, out in COMPARE_OLD])


def compare_old_new(old: DataFrame, new: DataFrame, dim: str) -> DataFrame:
    """Old helper values full-outer-joined with the v1 roll-up
    R01 / R02 on the user or port."""
    n = new.select(F.col(dim).alias("_nk"), *[F.col(c).alias(o) for c, o in COMPARE_NEW])
    j = old.join(n, old[dim] == n["_nk"], "full")
    cols = [F.coalesce(F.col("_nk"), F.col(dim)).alias(dim)]
    for (_, _, out), (_, nout) in zip(COMPARE_OLD, COMPARE_NEW):
        cols += [F.col(out), F.col(nout)]
    cols += [F.col("EventRows"), F.col("UnattributedEventRows")]
    return j.select(*cols)
