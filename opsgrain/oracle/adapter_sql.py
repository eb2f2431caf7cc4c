"""Adapter views as DuckDB/ANSI SQL, used to build the correctness oracles.

The same derivation rules as ``opsgrain.sources.adapter`` written as one SELECT
per view (FIXTURES.md §2); oracles prepend them as CTEs."""

ADAPTER_VIEWS: list[tuple[str, str]] = [
    ("ev", """select event_id, cast(ts as timestamp) as ts, user_id, event_type, value,
  concat('u', cast(user_id % 10 as string)) as usr, user_id % 5 + 1 as loc,
  concat('P', cast(user_id % 5 + 1 as string)) as port, concat('C', cast(user_id % 25 as string)) as bin,
  case cast(floor(user_id / 10) as bigint) % 4 when 0 then 'Pick' when 1 then 'PutAway' when 2 then 'CycleCount' else 'OnDemand' end as wt
from events"""),
    ("sign_in", """select wt as WorkType, event_id as PrimaryKey, ts as TimeStamp, loc as LocationPrimaryKey, case when event_id % 23 = 0 then null else usr end as UserName from ev where event_type = 'signup'"""),
    ("sign_out", """select wt as WorkType, event_id as PrimaryKey, ts as TimeStamp, loc as LocationPrimaryKey, usr as UserName from ev where event_type = 'error'"""),
    ("bin_presented", """select event_id as PrimaryKey, ts as TimeStamp, case when event_id % 17 = 0 then null else loc end as LocationPrimaryKey, port as LocationBarcode, bin as ContainerBarcode,
  case when event_id % 19 = 0 then null when event_id % 29 = 0 then '' else wt end as LocationTaskType,
  case when event_id % 11 = 0 then 'n/a' else concat('00:00:', lpad(cast(cast(floor(value) as bigint) % 60 as string), 2, '0'), '.500') end as BinActionTime
from ev where event_type = 'view'"""),
    ("close_bin", """select event_id as PrimaryKey, ts as TimeStamp, case when event_id % 17 = 1 then null else loc end as LocationPrimaryKey, port as LocationBarcode, bin as ContainerBarcode from ev where event_type = 'click' and event_id % 2 = 0"""),
    ("open_bin", """select event_id as PrimaryKey, ts as TimeStamp, loc as LocationPrimaryKey, case when event_id % 5 = 0 then concat(port, 'X') else port end as LocationBarcode, bin as ContainerBarcode from ev where event_type = 'click' and event_id % 2 = 1"""),
    ("pick", """select event_id as PrimaryKey, ts as TimeStamp, event_id as PickPrimaryKey, case when event_id % 10 = 0 then null else 100 end as PercentOfOrderLine, cast(floor(event_id / 7) as bigint) as TransportOrderPrimaryKey, port as LocationBarcode, bin as ContainerBarcode,
  concat('SO', cast(cast(floor(event_id / 7) as bigint) as string)) as OrderNumber,
  case event_id % 6 when 0 then null when 1 then 'NO VALUE' when 2 then 'Unknown' when 3 then ' Retail ' when 4 then 'Web' else 'B2B' end as OrderCategory,
  case when event_id % 9 = 0 then null else ts + interval 90 second end as PickCompleteDate, concat('SKU', cast(event_id % 40 as string)) as Sku,
  cast(floor(value) as bigint) % 10 as ActualPickQuantity, event_id % 6 as RequiredPickQuantity, case when event_id % 13 = 0 then null else usr end as UserName
from ev where event_type = 'purchase'"""),
    ("order_rows", """select event_id as PrimaryKey, ts as TimeStamp, cast(floor(event_id / 7) as bigint) as OrderPrimaryKey, concat('SO', cast(cast(floor(event_id / 7) as bigint) as string)) as OrderNumber,
  case when event_id % 8 = 0 then null else ts end as CompletedDate, usr as UserName, port as Port, event_id % 4 + 1 as OrderLineCount, event_id % 9 as EachUnitCount
from ev where event_type = 'signup'"""),
    ("status_history", """select event_id as PrimaryKey, cast(floor(event_id / 14) as bigint) as FulfillmentOrderPrimaryKey, usr as UserName, ts as StatusDate, case when event_id % 3 = 0 then 'Released' else 'Completed' end as Status from ev where event_type in ('signup', 'error')"""),
    ("metric_sources", """select s.id as SourcePriority, concat('db', cast(s.id as string)) as SourceDatabase, 'ReportedMetrics' as SourceTable, event_id + s.id as SourcePrimaryKey,
  case when event_type = 'signup' then concat(wt, '-SignIn') when event_type = 'error' then concat(wt, '-SignOut') when event_type = 'view' then 'BinPresented'
    when event_type = 'click' then case event_id % 2 when 0 then 'CloseBin' else 'OpenBin' end
    else case wt when 'PutAway' then 'PutAway' when 'CycleCount' then 'CycleCountService' when 'OnDemand' then 'Order' else 'Pick' end end as DataDescription,
  ts as EventTimestamp,
  concat('{"User":"', usr, '","LocationPrimaryKey":"', cast(loc as string), '","LocationBarcode":"', port, '","ContainerBarcode":"', bin, '","Quantity":"', cast(cast(floor(value) as bigint) as string), '"}') as JsonData
from ev, (values (1), (2), (3), (4)) as s(id) where s.id = 1 or event_id % s.id = 0"""),
    ("containers", """select o_orderkey as PrimaryKey, o_custkey % 6 + 1 as TemplatePrimaryKey, case o_orderstatus when 'P' then 'Outside' when 'O' then 'Stored' else null end as Status, (cast(o_orderdate as timestamp) + interval 8217 day) as LastUpdatedDate, s.id as Snapshot_Id from orders, (values (1), (2)) as s(id) where s.id = 2 or o_orderkey % 2 = 0"""),
    ("inventory", """select l_orderkey * 10 + l_linenumber as PrimaryKey, l_partkey as UnitOfMeasurePrimaryKey, l_orderkey as ContainerPrimaryKey, case l_returnflag when 'R' then 'Pending' when 'A' then 'Available' else null end as Status,
  0 as ContainerSide, (l_linenumber - 1) % 4 as ContainerX, cast(floor((l_linenumber - 1) / 4) as bigint) as ContainerY, case when l_partkey % 12 = 0 then 0 else cast(l_quantity as bigint) end as Quantity, (cast(l_shipdate as timestamp) + interval 8122 day) as LastUpdatedDate, s.id as Snapshot_Id
from lineitem, (values (1), (2)) as s(id) where s.id = 2 or l_orderkey % 2 = 0"""),
    ("units_of_measure", """select p_partkey as PrimaryKey, p_partkey % 500 as ProductPrimaryKey, p_size % 4 as BaseMultiple, case when p_partkey % 10 = 9 then 1 else 2 end as Snapshot_Id from part"""),
    ("products", """select distinct p_partkey % 500 as PrimaryKey, concat('SKU', cast(p_partkey % 500 as string)) as Sku from part"""),
    ("container_templates", """select t.id as PrimaryKey, case when t.id = 5 then '' else concat('Autostore ', cast(t.id as string), '/8') end as TemplateName, t.id <> 6 as IsGoodsToPerson, 2 as Snapshot_Id from (values (1), (2), (3), (4), (5), (6)) as t(id)"""),
    ("compartment_sizes", """select c.id as PrimaryKey, c.nm as Name, 2 as Snapshot_Id from (values (1, 'Small'), (2, 'Medium'), (3, '')) as c(id, nm)"""),
    ("template_compartments", """select t.id * 100 + p.x * 10 + p.y as PrimaryKey, t.id as TemplatePrimaryKey, 0 as ContainerSide, p.x as XPosition, p.y as YPosition, (t.id + p.x) % 3 + 1 as CompartmentSizePrimaryKey
from (values (1), (2), (3), (4), (5), (6)) as t(id), (values (0, 0), (1, 0), (2, 0), (3, 0), (0, 1), (1, 1), (2, 1)) as p(x, y)"""),
    ("putaway_containers", """select o_orderkey as PrimaryKey, case when o_orderstatus = 'F' then 'Closed' else 'Open' end as Status, o_orderstatus = 'F' as IsClosed, case when o_orderkey % 10 = 0 then null else (cast(o_orderdate as timestamp) + interval 8217 day) end as LastUpdatedDateInventory, (cast(o_orderdate as timestamp) + interval 8217 day) as LastUpdatedDate, (cast(o_orderdate as timestamp) + interval 8215 day) as CreatedDate, 2 as Snapshot_Id from orders"""),
    ("putaway_lines", """select l_orderkey * 10 + l_linenumber as PrimaryKey, l_orderkey as PutAwayContainerPrimaryKey, l_partkey as UnitOfMeasurePrimaryKey, cast(l_quantity as bigint) as Quantity, case when l_linenumber = 7 then null else cast(l_quantity as bigint) - l_linenumber % 3 end as ActualQuantity, cast(l_linenumber % 2 as bigint) as MissingQuantity, (cast(l_shipdate as timestamp) + interval 8122 day) as LastUpdatedDate, 2 as Snapshot_Id from lineitem"""),
    ("inventory_tasks", """select l_orderkey * 10 + l_linenumber as PrimaryKey, l_suppkey as TaskGroupPrimaryKey, l_linestatus = 'F' as IsClosed, (cast(l_shipdate as timestamp) + interval 8122 day) as LastUpdatedDate, 2 as Snapshot_Id from lineitem"""),
    ("tasks_putaway", """select l_orderkey * 10 + l_linenumber as InventoryTaskPrimaryKey, l_orderkey as PutAwayContainerPrimaryKey, case when l_linenumber = 3 then null else l_suppkey % 5 end as LocationPrimaryKey from lineitem"""),
    ("task_actions", """select l_orderkey * 10 + l_linenumber as InventoryTaskPrimaryKey, case when l_linenumber = 4 then null else l_partkey % 100 end as NewContainerPrimaryKey from lineitem"""),
    ("tasks_cyclecount", """select l_orderkey * 10 + l_linenumber as InventoryTaskPrimaryKey, l_orderkey as ContainerPrimaryKey, (cast(l_shipdate as timestamp) + interval 8122 day) as LastUpdatedDate from lineitem"""),
    ("fulfillment_orders", """select o_orderkey as PrimaryKey, concat('SO', cast(o_orderkey as string)) as ExternalOrderNumber, case o_orderpriority when '1-URGENT' then 'Active' when '2-HIGH' then 'allocated' when '3-MEDIUM' then 'Completed' when '5-LOW' then 'falied allocation' else 'Shorted' end as Status, (cast(o_orderdate as timestamp) + interval 8217 day) as LastUpdatedDate, cast(o_orderdate as timestamp) + to_days(8217 + case when o_orderkey % 4 = 0 then 1 else 0 end) as LastUpdatedDateInventory from orders"""),
    ("fulfillment_lines", """select l_orderkey * 10 + l_linenumber as PrimaryKey, l_orderkey as FulfillmentOrderPrimaryKey, case l_returnflag when 'A' then 'Active' when 'N' then 'pending' else 'Completed' end as Status, (cast(l_shipdate as timestamp) + interval 8122 day) as LastUpdatedDate, cast(l_shipdate as timestamp) + to_days(8122 + case when l_linenumber % 3 = 0 then 1 else 0 end) as LastUpdatedDateInventory from lineitem"""),
    ("defrag_detail", """select concat('SKU', cast(l_partkey % 200 as string)) as Sku, l_partkey % 200 as UnitOfMeasurePrimaryKey, case l_linenumber % 2 when 0 then 'Small' else 'Medium' end as CompartmentSizeName, cast(sum(l_quantity) as bigint) as Quantity, count(*) as TotalCompartments, cast(sum(60 - l_quantity) as bigint) as TotalUnrealizedCapacity, 60 as CompartmentSizeCapacity,
  cast(sum(60 - l_quantity) as double) * 100 / 4096 as PercentFragmentation, cast(cast(sum(60 - l_quantity) as bigint) // count(*) as double) as AverageUnrealizedCapacity, count(*) / 8 as StandardDeviationUnrealizedCapacity,
  (cast(sum(l_quantity) as bigint) + 59) // 60 as IdealizedCompartmentUsage, ((cast(sum(l_quantity) as bigint) + 59) // 60) * 60 - cast(sum(l_quantity) as bigint) as IdealizedUnrealizedCapacity,
  100 * (((cast(sum(l_quantity) as bigint) + 59) // 60) * 60 - cast(sum(l_quantity) as bigint)) // greatest(((cast(sum(l_quantity) as bigint) + 59) // 60) * 60, 1) as IdealizedPercentFragmentation from lineitem group by l_partkey % 200, l_linenumber % 2"""),
]


def adapter_ctes() -> str:
    return ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ADAPTER_VIEWS)
