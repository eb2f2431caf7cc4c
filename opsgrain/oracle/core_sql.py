"""DuckDB oracle SQL for the work-event grain and its roll-ups.

Written in the direct, brute-force form of the source views (join + top-1 by
``row_number``) so it checks the Spark plans, which use windows and bucketed
joins instead.  Millisecond arithmetic mirrors the Spark side exactly.
"""

from __future__ import annotations

from opsgrain.functions.tsql import CLOCK_PATTERN


def clock_ms_sql(t: str) -> str:
    sec = f"split_part({t}, ':', 3)"
    return (
        f"(case when regexp_matches({t}, '{CLOCK_PATTERN}') then "
        f"cast(split_part({t}, ':', 1) as bigint) * 3600000 + cast(split_part({t}, ':', 2) as bigint) * 60000 "
        f"+ coalesce(cast(nullif(split_part({sec}, '.', 1), '') as bigint), 0) * 1000 "
        f"+ cast(substr(rpad(split_part({sec}, '.', 2), 7, '0'), 1, 3) as bigint) end)"
    )


def dec4(ms: str, unit_ms: int) -> str:
    """round_half_up(ms / unit_ms, 4) as an exact count of 1e-4 units."""
    d = unit_ms // 10000
    return f"(({ms}) * 2 + {d}) // {2 * d}"


CORE_CTES = {
    "locmap": """
select LocationPrimaryKey, LocationBarcode from (
  select LocationPrimaryKey, LocationBarcode,
    row_number() over (partition by LocationPrimaryKey order by count(*) desc, max(TimeStamp) desc, LocationBarcode) as rk
  from (
    select LocationPrimaryKey, LocationBarcode, TimeStamp from bin_presented
    union all select LocationPrimaryKey, LocationBarcode, TimeStamp from open_bin
    union all select LocationPrimaryKey, LocationBarcode, TimeStamp from close_bin) c
  where LocationPrimaryKey is not null and LocationBarcode is not null
  group by LocationPrimaryKey, LocationBarcode) x
where rk = 1""",
    "rin": """
select *, row_number() over (partition by WorkType, LocationPrimaryKey, UserName, cast(TimeStamp as date) order by TimeStamp, PrimaryKey) as rk
from sign_in where UserName is not null""",
    "rout": """
select *, row_number() over (partition by WorkType, LocationPrimaryKey, UserName, cast(TimeStamp as date) order by TimeStamp, PrimaryKey) as rk
from sign_out where UserName is not null""",
    "sessions": """
select i.WorkType, i.PrimaryKey as SignInPrimaryKey, o.PrimaryKey as SignOutPrimaryKey, i.UserName, i.LocationPrimaryKey,
  lm.LocationBarcode as Port, i.TimeStamp as SignInTime, o.TimeStamp as SignOutTime,
  (epoch_us(o.TimeStamp) // 1000) - (epoch_us(i.TimeStamp) // 1000) as SessionMs
from rin i
join rout o on o.WorkType = i.WorkType and o.LocationPrimaryKey = i.LocationPrimaryKey and o.UserName = i.UserName
  and o.rk = i.rk and cast(o.TimeStamp as date) = cast(i.TimeStamp as date) and o.TimeStamp > i.TimeStamp
left join locmap lm on lm.LocationPrimaryKey = i.LocationPrimaryKey""",
    "bin_sess": """
select bpk, s_user from (
  select bp.PrimaryKey as bpk, ws.UserName as s_user,
    row_number() over (partition by bp.PrimaryKey order by ws.SignInTime desc, ws.SignInPrimaryKey) as rn
  from bin_presented bp join sessions ws on ws.LocationPrimaryKey = bp.LocationPrimaryKey
    and (bp.LocationTaskType is null or ws.WorkType = bp.LocationTaskType)
    and bp.TimeStamp >= ws.SignInTime and bp.TimeStamp <= ws.SignOutTime) x
where rn = 1""",
    "bin_pick": """
select bpk, p_user from (
  select bp.PrimaryKey as bpk, p.UserName as p_user,
    row_number() over (partition by bp.PrimaryKey order by p.TimeStamp, p.PrimaryKey) as rn
  from bin_presented bp join pick p on p.ContainerBarcode = bp.ContainerBarcode
    and p.UserName is not null and p.TimeStamp >= bp.TimeStamp) x
where rn = 1""",
    "bin_close": """
select bpk, CloseTime from (
  select bp.PrimaryKey as bpk, cb.TimeStamp as CloseTime,
    row_number() over (partition by bp.PrimaryKey order by cb.TimeStamp, cb.PrimaryKey) as rn
  from bin_presented bp join close_bin cb on cb.ContainerBarcode = bp.ContainerBarcode
    and (cb.LocationPrimaryKey = bp.LocationPrimaryKey or cb.LocationPrimaryKey is null or bp.LocationPrimaryKey is null)
    and cb.TimeStamp >= bp.TimeStamp) x
where rn = 1""",
    "bin_attr": f"""
select bp.*, s.s_user, pk.p_user, c.CloseTime, {clock_ms_sql('bp.BinActionTime')} as wait_ms
from bin_presented bp
left join bin_sess s on s.bpk = bp.PrimaryKey
left join bin_pick pk on pk.bpk = bp.PrimaryKey
left join bin_close c on c.bpk = bp.PrimaryKey""",
    "order_flag": """
select o.*, (exists (select 1 from pick p where p.TransportOrderPrimaryKey = o.OrderPrimaryKey
                     or (p.OrderNumber is not null and p.OrderNumber = o.OrderNumber))) as has_pick
from order_rows o where o.CompletedDate is not null""",
    "work_events": """
select WorkType, 'SESSION' as EventType,
  concat(WorkType, ':', cast(SignInPrimaryKey as varchar), ':', cast(SignOutPrimaryKey as varchar)) as EventKey,
  UserName, Port, cast(SignInTime as date) as EventDate, SignInTime as StartTime, SignOutTime as EndTime,
  SessionMs as DurationMs, SessionMs as RateDenominatorMs, 0 as HandleMs, 0 as MachineWaitMs,
  0 as OrderCompletedCount, 0 as BinPresentationCount, 0 as LineCompletedCount, 0 as UnitCompletedCount,
  concat(WorkType, '-Session') as SourceName, SignInPrimaryKey as SourcePrimaryKey,
  cast(null as bigint) as FulfillmentOrderPrimaryKey, cast(null as bigint) as FulfillmentOrderLinePrimaryKey,
  cast(null as varchar) as ContainerBarcode, 'Paired SignIn/SignOut' as AttributionMethod
from sessions
union all
select coalesce(nullif(LocationTaskType, ''), 'Unknown'), 'BIN_PRESENTATION', cast(PrimaryKey as varchar),
  coalesce(s_user, p_user), LocationBarcode, cast(TimeStamp as date), TimeStamp, CloseTime,
  case when CloseTime is not null and CloseTime >= TimeStamp then (epoch_us(CloseTime) // 1000) - (epoch_us(TimeStamp) // 1000) else wait_ms end,
  0,
  case when CloseTime is not null and CloseTime >= TimeStamp then (epoch_us(CloseTime) // 1000) - (epoch_us(TimeStamp) // 1000) else wait_ms end,
  wait_ms, 0, 1, 0, 0, 'BinPresented', PrimaryKey, null, null, ContainerBarcode,
  case when s_user is not null then 'Task session' when p_user is not null then 'Nearest pick by container' else 'Unattributed' end
from bin_attr
union all
select 'Pick', 'LINE_COMPLETED', cast(PrimaryKey as varchar), UserName, LocationBarcode,
  cast(coalesce(PickCompleteDate, TimeStamp) as date), TimeStamp, coalesce(PickCompleteDate, TimeStamp),
  case when PickCompleteDate is not null and PickCompleteDate >= TimeStamp then (epoch_us(PickCompleteDate) // 1000) - (epoch_us(TimeStamp) // 1000) end,
  0, 0, 0, 0, 0,
  case when coalesce(ActualPickQuantity, 0) >= coalesce(RequiredPickQuantity, 0) then 1 else 0 end,
  case when coalesce(ActualPickQuantity, 0) >= coalesce(RequiredPickQuantity, 0) then coalesce(ActualPickQuantity, 0) else 0 end,
  'Pick', PrimaryKey, TransportOrderPrimaryKey, PickPrimaryKey, ContainerBarcode, 'Pick row'
from pick where UserName is not null
union all
select 'Pick', 'ORDER_COMPLETED', cast(PrimaryKey as varchar), UserName, Port, cast(CompletedDate as date),
  CompletedDate, CompletedDate, null, 0, 0, 0, 1, 0,
  case when has_pick then 0 else coalesce(OrderLineCount, 0) end,
  case when has_pick then 0 else coalesce(EachUnitCount, 0) end,
  'Order', PrimaryKey, OrderPrimaryKey, null, null, 'Reported order row'
from order_flag""",
}

AGG_SQL = """
  sum(OrderCompletedCount) as OrdersCompleted, sum(BinPresentationCount) as BinPresentationsCompleted,
  sum(LineCompletedCount) as LinesCompleted, sum(UnitCompletedCount) as UnitsCompleted,
  sum(coalesce(RateDenominatorMs, 0)) as sms, sum(coalesce(HandleMs, 0)) as hms, sum(coalesce(MachineWaitMs, 0)) as wms,
  count(*) as EventRows,
  sum(case when EventType = 'SESSION' then 1 else 0 end) as SessionEventRows,
  sum(case when EventType = 'BIN_PRESENTATION' then 1 else 0 end) as BinPresentationEventRows,
  sum(case when SourceName = 'Pick' then 1 else 0 end) as PickEventRows,
  sum(case when EventType = 'ORDER_COMPLETED' then 1 else 0 end) as OrderEventRows,
  sum(case when AttributionMethod = 'Unattributed' then 1 else 0 end) as UnattributedEventRows"""


def finish_sql(keys: list[str], src: str, extra: list[str] = ()) -> str:
    """Denominator rule and output columns over an aggregate CTE ``src``;
    decimal columns come out as integer 1e-4 units (suffix ``_u``)."""
    return f"""
select {', '.join(keys)}, OrdersCompleted, BinPresentationsCompleted, LinesCompleted, UnitsCompleted,
  {dec4('sms', 3_600_000)} as TotalLoggedHours_u, {dec4('sms', 60_000)} as TotalLoggedMinutes_u,
  {dec4('hms', 60_000)} as ActiveHandleMinutes_u, {dec4('wms', 60_000)} as MachineWaitMinutes_u,
  {dec4('dms', 3_600_000)} as RateDenominatorHours_u,
  case when sms > 0 then 'SESSION' when hms > 0 then 'HANDLE_FALLBACK' else 'NONE' end as RateDenominatorSource,
  case when dms > 0 then OrdersCompleted * 3600000 / dms end as OrdersPerHour,
  case when dms > 0 then BinPresentationsCompleted * 3600000 / dms end as BinsPerHour,
  case when dms > 0 then UnitsCompleted * 3600000 / dms end as UnitsPerHour,
  case when dms > 0 then LinesCompleted * 3600000 / dms end as LinesPerHour,
  case when BinPresentationsCompleted > 0 then hms / (BinPresentationsCompleted * 60000) end as AverageHandleTimePerPresentationMinutes,
  EventRows, SessionEventRows, BinPresentationEventRows, PickEventRows, OrderEventRows, UnattributedEventRows
  {''.join(', ' + e for e in extra)}
from (select *, case when sms > 0 then sms else hms end as dms from {src}) a"""


ROLLUP_CTES = {
    "r05_agg": f"select WorkType, UserName as Users, {AGG_SQL} from work_events where UserName is not null group by WorkType, UserName",
    "r05": finish_sql(["WorkType", "Users"], "r05_agg"),
    "r06_agg": f"select WorkType, coalesce(Port, 'Unattributed') as Ports, {AGG_SQL} from work_events group by WorkType, coalesce(Port, 'Unattributed')",
    "r06": finish_sql(["WorkType", "Ports"], "r06_agg"),
    "r09_agg": f"""select EventDate, WorkType, coalesce(UserName, 'Unattributed') as Users, coalesce(Port, 'Unattributed') as Ports,
  {AGG_SQL}, min(StartTime) as MinStartTime, max(StartTime) as MaxStartTime
from work_events group by EventDate, WorkType, coalesce(UserName, 'Unattributed'), coalesce(Port, 'Unattributed')""",
    "r09": finish_sql(["EventDate", "WorkType", "Users", "Ports"], "r09_agg", ["MinStartTime", "MaxStartTime"]),
}


def total_sql(src: str, key: str) -> str:
    """R07/R08 over r05/r06 (units are integer 1e-4 counts)."""
    return f"""
select {key}, sum(OrdersCompleted) as OrdersCompleted, sum(BinPresentationsCompleted) as BinPresentationsCompleted,
  sum(LinesCompleted) as LinesCompleted, sum(UnitsCompleted) as UnitsCompleted,
  sum(TotalLoggedHours_u) as TotalLoggedHours_u, sum(TotalLoggedMinutes_u) as TotalLoggedMinutes_u,
  sum(ActiveHandleMinutes_u) as ActiveHandleMinutes_u, sum(MachineWaitMinutes_u) as MachineWaitMinutes_u,
  sum(RateDenominatorHours_u) as RateDenominatorHours_u,
  case when sum(RateDenominatorHours_u) > 0 then sum(OrdersCompleted) * 10000 / sum(RateDenominatorHours_u) end as OrdersPerHour,
  case when sum(RateDenominatorHours_u) > 0 then sum(BinPresentationsCompleted) * 10000 / sum(RateDenominatorHours_u) end as BinsPerHour,
  case when sum(RateDenominatorHours_u) > 0 then sum(UnitsCompleted) * 10000 / sum(RateDenominatorHours_u) end as UnitsPerHour,
  case when sum(RateDenominatorHours_u) > 0 then sum(LinesCompleted) * 10000 / sum(RateDenominatorHours_u) end as LinesPerHour,
  case when sum(BinPresentationsCompleted) > 0 then sum(ActiveHandleMinutes_u) / (sum(BinPresentationsCompleted) * 10000) end
    as AverageHandleTimePerPresentationMinutes,
  sum(EventRows) as EventRows, sum(SessionEventRows) as SessionEventRows, sum(BinPresentationEventRows) as BinPresentationEventRows,
  sum(PickEventRows) as PickEventRows, sum(OrderEventRows) as OrderEventRows, sum(UnattributedEventRows) as UnattributedEventRows
from {src} group by {key}"""


ROLLUP_CTES["r07"] = total_sql("r05", "Users")
ROLLUP_CTES["r08"] = total_sql("r06", "Ports")
