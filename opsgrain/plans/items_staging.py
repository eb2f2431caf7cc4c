"""Registered queries for staging (S), raw sessions (E06), the v1 stream
(E05, E09-E13), v1 roll-ups (R01-R04), old-vs-new comparison (R10-R11) and
the drill-through reports (R12-R14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.operators import events as E
from opsgrain.oracle.staging_sql import STAGING_CTES
from opsgrain.plans import pages as P
from opsgrain.plans import rollups as R
from opsgrain.plans.catalog import add_ctes, canon, materialized, register, sel
from opsgrain.plans.items_events import ROLLUP_SPEC, work_events
from opsgrain.plans.items_pages import _rollup_of, daily_of
from opsgrain.session import checkpoint_dir
from opsgrain.sources import staging as S
from opsgrain.sources.optional import OptionalSources

add_ctes(STAGING_CTES)

METRIC_SPEC = "SourceDatabase, SourceTable, SourcePriority:i, SourcePrimaryKey:i, DataDescription, JsonData, EventTimestamp:T"


def sources_of(t):
    return S.metric_sources([(f"db{i}", "ReportedMetrics", i, t.reported_metrics(i)) for i in (1, 2, 3, 4)])


def dedup_of(t):
    return materialized(t, "_dedup", lambda: S.dedupe_metrics(sources_of(t)))


@register("S01_metric_sources", f"select {sel(METRIC_SPEC)} from metric_sources")
def s01(t):
    return canon(sources_of(t))


# UTF-16LE of an ASCII text: every byte followed by a zero byte
_HASHED = ("DataDescription || '|' || strftime(EventTimestamp, '%Y-%m-%dT%H:%M:%S') || case when epoch_us(EventTimestamp) % 1000000 = 0 then '' "
           "else '.' || strftime(EventTimestamp, '%f') || '0' end || '|' || JsonData")


@register("S02_event_hash", f"""select SourceDatabase, SourcePrimaryKey,
  sha256(unhex(regexp_replace(hex(cast({_HASHED} as blob)), '(..)', '\\100', 'g'))) as EventHash from metric_sources""")
def s02(t):
    return canon(S.event_hash(sources_of(t)).select("SourceDatabase", "SourcePrimaryKey", "EventHash"))


@register("S03_dedupe_metrics", f"select {sel(METRIC_SPEC + ', DuplicateSourceRows:i')} from dedup")
def s03(t):
    return canon(dedup_of(t).drop("EventHash"))


SIGN_SCHEMA = T.StructType([T.StructField("User", T.StringType()), T.StructField("LocationPrimaryKey", T.StringType()),
                            T.StructField("LocationBarcode", T.StringType())])


@register("S04_parse_events", """select SourcePrimaryKey as PrimaryKey, strftime(EventTimestamp, '%Y-%m-%d %H:%M:%S.%f') as TimeStamp,
  json_extract_string(JsonData, '$.User') as "User", json_extract_string(JsonData, '$.LocationPrimaryKey') as LocationPrimaryKey,
  json_extract_string(JsonData, '$.LocationBarcode') as LocationBarcode
from dedup where DataDescription = 'Pick-SignIn'""")
def s04(t):
    return canon(S.parse_events(dedup_of(t), "Pick-SignIn", SIGN_SCHEMA))


@register("S04_parse_all_events", """select DataDescription, SourcePrimaryKey as PrimaryKey, strftime(EventTimestamp, '%Y-%m-%d %H:%M:%S.%f') as TimeStamp,
  json_extract_string(JsonData, '$.User') as "User", json_extract_string(JsonData, '$.LocationPrimaryKey') as LocationPrimaryKey,
  json_extract_string(JsonData, '$.LocationBarcode') as LocationBarcode, json_extract_string(JsonData, '$.ContainerBarcode') as ContainerBarcode,
  json_extract_string(JsonData, '$.Quantity') as Quantity
from dedup""")
def s04_all(t):
    """The fifteen descriptions' typed event tables, one under the other, from
    one parse of each payload."""
    typed = S.typed_telemetry(dedup_of(t), dict.fromkeys(S.TELEMETRY_FIELDS, "string"))
    return canon(typed.where(F.col("DataDescription").isin(*S.EVENT_DESCRIPTIONS)).drop("SourceDatabase", "SourceTable", "Malformed"))


@register("S04_typed_telemetry", """select DataDescription, SourcePrimaryKey as PrimaryKey, strftime(EventTimestamp, '%Y-%m-%d %H:%M:%S.%f') as TimeStamp, SourceDatabase, SourceTable,
  JsonData ->> '$.User' as "User", try_cast(JsonData ->> '$.LocationPrimaryKey' as bigint) as LocationPrimaryKey, JsonData ->> '$.LocationBarcode' as LocationBarcode,
  JsonData ->> '$.ContainerBarcode' as ContainerBarcode, try_cast(JsonData ->> '$.Quantity' as bigint) as Quantity, not json_valid(JsonData) as Malformed
from dedup""")
def s04_typed(t):
    return canon(S.typed_telemetry(dedup_of(t)))


INV_SPEC = ("PrimaryKey:i, UnitOfMeasurePrimaryKey:i, ContainerPrimaryKey:i, Status, ContainerSide:i, ContainerX:i, "
            "ContainerY:i, Quantity:i, LastUpdatedDate:T, Snapshot_Id:i")


@register("S05_latest_snapshot", f"select {sel(INV_SPEC)} from inventory where Snapshot_Id = (select max(Snapshot_Id) from inventory)")
def s05(t):
    return canon(S.latest_snapshot(t.inventory))


@register("S06_latest_by_day", f"""select {sel(INV_SPEC)} from inventory
qualify Snapshot_Id = max(Snapshot_Id) over (partition by PrimaryKey, cast(LastUpdatedDate as date))""")
def s06(t):
    return canon(S.latest_by_day(t.inventory, ["PrimaryKey"], F.to_date("LastUpdatedDate")))


@register("S07_with_date", "select PrimaryKey, strftime(cast(PickCompleteDate as date), '%Y-%m-%d') as Date from pick")
def s07(t):
    return canon(S.with_date(t.pick, "PickCompleteDate").select("PrimaryKey", "Date"))


@register("S08_port_sort", """select PrimaryKey, Port,
  coalesce(cast(round(try_cast(regexp_replace(Port, '^P', '') as double)) as bigint), 999999) as PortSortOrder from order_rows""")
def s08(t):
    return canon(t.order_rows.select("PrimaryKey", "Port", S.port_sort(F.col("Port")).alias("PortSortOrder")))


@register("S09_hour_label", """select PrimaryKey, strftime(CompletedDate, '%-I %p') as Hour, cast(hour(CompletedDate) as bigint) as HourSort
from order_rows""")
def s09(t):
    return canon(S.hour_columns(t.order_rows, "CompletedDate").select("PrimaryKey", "Hour", "HourSort"))


@register("E06_raw_work_sessions", "select " + sel(
    "WorkType, UserName, LocationPrimaryKey:i, Port, SignInTime:T, SignOutTime:T, SessionMs:i, SignInSourceDatabase, "
    "SignInSourceTable, SignInSourcePrimaryKey:i, SignOutSourceDatabase, SignOutSourceTable, SignOutSourcePrimaryKey:i"
) + " from raw_sessions")
def e06(t):
    return canon(S.raw_work_sessions(dedup_of(t)).drop("SessionSeconds"))


V1_SPEC = ("EventType, EventKey, UserName, Port, EventDate:D, StartTime:T, EndTime:T, DurationSeconds:i, MachineWaitSeconds:i, "
           "OrderCompletedCount:i, BinPresentationCount:i, LineCompletedCount:i, UnitCompletedCount:i, SourcePrimaryKey:i, "
           "FulfillmentOrderPrimaryKey:i, FulfillmentOrderLinePrimaryKey:i, ContainerBarcode, AttributionMethod")


def ev1_of(t):
    return materialized(t, "_ev1", lambda: E.work_events_v1(t))


@register("E05_pick_sessions_v1", "select " + sel(
    "LocationPrimaryKey:i, UserName, SignInPrimaryKey:i, SignOutPrimaryKey:i, SignInTime:T, SignOutTime:T") + " from psess")
def e05(t):
    return canon(E.pick_sessions_v1(t.sign_in, t.sign_out).drop("SessionDate"))


for _key, _et in [("E09_bin_events_v1", "BIN_PRESENTATION"), ("E10_pick_events_v1", "PICK_COMPLETED"),
                  ("E11_completed_orders_v1", "ORDER_COMPLETED")]:
    def _fn(t, _et=_et):
        return canon(ev1_of(t).filter(F.col("EventType") == _et))
    register(_key, f"select {sel(V1_SPEC)} from ev1 where EventType = '{_et}'")(_fn)


@register("E12_order_port_mode", "select FulfillmentOrderPrimaryKey, Port from opm")
def e12(t):
    return canon(E.order_port_mode(t.fulfillment_orders, t.pick))


@register("E13_work_events_v1", f"select {sel(V1_SPEC)} from ev1")
def e13(t):
    return canon(ev1_of(t))


V1_ROLL = ("OrdersCompleted:i, BinPresentationsCompleted:i, LinesCompleted:i, UnitsCompleted:i, TotalLoggedHours:d, "
           "TotalLoggedMinutes:d, MachineWaitMinutes:d, OrdersPerHour:d, BinsPerHour:d, UnitsPerHour:d, LinesPerHour:d, "
           "AverageHandleTimePerPresentationMinutes:d, EventRows:i, UnattributedEventRows:i")
for _key, _cte, _dim, _bd in [("R01_v1_by_user", "r01", "Users", False), ("R02_v1_by_port", "r02", "Ports", False),
                              ("R03_v1_by_user_date", "r03", "Users", True), ("R04_v1_by_port_date", "r04", "Ports", True)]:
    def _fn(t, _dim=_dim, _bd=_bd):
        return canon(R.rollup_v1(ev1_of(t), [_dim], by_date=_bd))
    keys = ("EventDate:D, " if _bd else "") + _dim
    register(_key, f"select {sel(keys)}, {sel(V1_ROLL)} from {_cte}")(_fn)


def _compare_sql(dim: str) -> str:
    suffix = "User" if dim == "Users" else "Port"
    old_cols = ", ".join(f"h{i}.{col.format(dim=suffix)} as {out}" for i, (_, col, out) in enumerate(R.COMPARE_OLD))
    keys = " union ".join(f"select {dim} from hv_{stem}Per{suffix}" for stem, _, _ in R.COMPARE_OLD)
    joins = " ".join(f"left join hv_{stem}Per{suffix} h{i} on h{i}.{dim} = du.{dim}" for i, (stem, _, _) in enumerate(R.COMPARE_OLD))
    pairs = []
    for (_, _, out), (ncol, nout) in zip(R.COMPARE_OLD, R.COMPARE_NEW):
        pairs += [f"o.{out}", f"n.{ncol} as {nout}"]
    pairs += ["n.EventRows", "n.UnattributedEventRows"]
    new = "r01" if dim == "Users" else "r02"
    body = (f"select coalesce(n.{dim}, o.{dim}) as {dim}, {', '.join(pairs)} from "
            f"(select du.{dim}, {old_cols} from ({keys}) du {joins}) o full outer join {new} n on n.{dim} = o.{dim}")
    spec = ", ".join(
        [dim] + [f"{out}:{'d' if 'PerHour' in out or 'Average' in out else 'i'}" for _, _, out in R.COMPARE_OLD]
        + [f"{nout}:{'i' if nout.endswith(('Completed', 'Rows')) else 'd'}" for _, nout in R.COMPARE_NEW])
    return f"select {sel(spec)} from ({body}) c"


@register("R10_compare_user", _compare_sql("Users"))
def r10(t):
    old = R.old_side_from_rollup(_rollup_of(t, "Users"), "Users")
    return canon(R.compare_old_new(old, R.rollup_v1(ev1_of(t), ["Users"]), "Users"))


@register("R11_compare_port", _compare_sql("Ports"))
def r11(t):
    old = R.old_side_from_rollup(_rollup_of(t, "Ports"), "Ports")
    return canon(R.compare_old_new(old, R.rollup_v1(ev1_of(t), ["Ports"]), "Ports"))


@register("R12_trace_summary", """select WorkType, EventType, SourceName, AttributionMethod, count(*) as EventRows,
  cast(sum(OrderCompletedCount) as bigint) as OrdersCompleted, cast(sum(BinPresentationCount) as bigint) as BinPresentationsCompleted,
  cast(sum(LineCompletedCount) as bigint) as LinesCompleted, cast(sum(UnitCompletedCount) as bigint) as UnitsCompleted,
  ((sum(coalesce(RateDenominatorMs, 0)) * 2 + 6) // 12) / 10000 as RateDenominatorMinutes,
  ((sum(coalesce(HandleMs, 0)) * 2 + 6) // 12) / 10000 as HandleMinutes,
  ((sum(coalesce(MachineWaitMs, 0)) * 2 + 6) // 12) / 10000 as MachineWaitMinutes,
  strftime(min(StartTime), '%Y-%m-%d %H:%M:%S.%f') as MinStartTime, strftime(max(StartTime), '%Y-%m-%d %H:%M:%S.%f') as MaxStartTime
from work_events where WorkType = 'Pick' group by WorkType, EventType, SourceName, AttributionMethod""")
def r12(t):
    return canon(R.trace_summary(work_events(t), work_type="Pick"))


@register("R13_trace_events", """select strftime(EventDate, '%Y-%m-%d') as EventDate, WorkType, EventType, SourceName, SourcePrimaryKey,
  AttributionMethod, Users, Ports, strftime(StartTime, '%Y-%m-%d %H:%M:%S.%f') as StartTime, strftime(EndTime, '%Y-%m-%d %H:%M:%S.%f') as EndTime,
  DurationMs / 1000 as DurationSeconds, RateDenominatorMs / 1000 as RateDenominatorSeconds, HandleMs / 1000 as HandleSeconds,
  MachineWaitMs / 1000 as MachineWaitSeconds, cast(OrderCompletedCount as bigint) as OrderCompletedCount,
  cast(BinPresentationCount as bigint) as BinPresentationCount, cast(LineCompletedCount as bigint) as LineCompletedCount,
  cast(UnitCompletedCount as bigint) as UnitCompletedCount, FulfillmentOrderPrimaryKey, FulfillmentOrderLinePrimaryKey, ContainerBarcode
from (select *, coalesce(UserName, 'Unattributed') as Users, coalesce(Port, 'Unattributed') as Ports from work_events
      where WorkType = 'Pick' order by StartTime nulls first, EventType, SourceName, SourcePrimaryKey limit 500) x""")
def r13(t):
    return canon(R.trace_events(work_events(t), 500, work_type="Pick"))


@register("R14_trace_daily", f"select {sel('EventDate:D, WorkType, Users, Ports')}, {sel(ROLLUP_SPEC)}, "
                             f"{sel('MinStartTime:T, MaxStartTime:T')} from r09 where WorkType = 'Pick'")
def r14(t):
    return canon(R.trace_daily(daily_of(t), work_type="Pick"))


@register("S01_optional_sources", """select concat('db', id) as Source, id <> 4 as Present, cast(count(*) filter (id <> 4) as bigint) as Rows
from (values (1), (2), (3), (4)) s(id) left join metric_sources m on m.SourcePriority = s.id group by id""")
def s01_optional(t):
    """Four telemetry sources, of which the last is not there: what was found."""
    base = f"{checkpoint_dir(t.spark).rstrip('/')}/opsgrain-tables/sources-{uuid.uuid4().hex}"
    for i in (1, 2, 3):
        t.reported_metrics(i).write.parquet(f"{base}/db{i}")
    found = OptionalSources(t.spark, {f"db{i}": f"{base}/db{i}" for i in (1, 2, 3, 4)}, t.reported_metrics(1).schema)
    return canon(found.status())
