"""Registered queries for the report-facing views (P)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from opsgrain.oracle.pages_sql import AS_OF, PAGES_CTES, matrix_sql
from opsgrain.plans import pages as P
from opsgrain.plans import rollups as R
from opsgrain.plans.catalog import REGISTRY, add_ctes, canon, materialized, register
from opsgrain.plans.items_events import work_events
from opsgrain.plans.published import publish, read_published
from opsgrain.session import checkpoint_dir

add_ctes(PAGES_CTES)

AS_OF_DATE = dt.date.fromisoformat(AS_OF)


def daily_of(t):
    return materialized(t, "_daily", lambda: R.daily(work_events(t)))


def _rollup_of(t, dim):
    if dim == "Users":
        return materialized(t, "_r05", lambda: R.by_user_work_type(work_events(t)))
    return materialized(t, "_r06", lambda: R.by_port_work_type(work_events(t)))


def _helper_sql(dim, out, src, kind):
    table = "r05" if dim == "Users" else "r06"
    key = "Users" if dim == "Users" else "case when Ports = 'Unattributed' then 'No Data' else Ports end as Ports"
    if kind == "count":
        val = f"cast({src} as bigint)"
    elif kind == "rate":
        val = f"cast(case when RateDenominatorSource = 'SESSION' then {src} end as double)"
    elif kind == "float":
        val = f"cast({src} as double)"
    else:
        val = f"cast(({src}_u + 5000) // 10000 as bigint)"
    return f"select {key}, {val} as {out} from {table} where WorkType = 'Pick'"


add_ctes({f"hv_{v[0]}": _helper_sql(*v[1:]) for v in P.HELPER_VIEWS})

for _i, (_name, _dim, _out, _src, _kind) in enumerate(P.HELPER_VIEWS, start=1):
    def _fn(t, _name=_name, _dim=_dim):
        return canon(P.helper_view(_rollup_of(t, _dim), _name))
    register(f"P{_i:02d}_{_name}", _helper_sql(_dim, _out, _src, _kind))(_fn)


_HD_KEYS = {
    "OrdersCompletedHD": "P23_orders_completed_hd", "LinesCompletedHD": "P23_lines_completed_hd",
    "UnitsPickedHD": "P23_units_picked_hd", "BinPresentedHD": "P23_bin_presented_hd",
    "Customer_Orders_Picked": "P24_customer_orders_picked", "Customer_Order_Lines": "P24_customer_order_lines",
    "Units_Picked": "P24_units_picked",
}
for _view, _key in _HD_KEYS.items():
    _src, _out = P.HISTORICAL[_view]
    def _fn(t, _view=_view):
        return canon(P.historical(daily_of(t), _view))
    register(_key, f"select strftime(EventDate, '%Y-%m-%d') as Date, cast(sum({_src}) as bigint) as \"{_out}\" "
                   f"from r09 where WorkType = 'Pick' group by EventDate")(_fn)


@register("P25_distinct_skus_picked", """
select strftime(cast(coalesce(PickCompleteDate, TimeStamp) as date), '%Y-%m-%d') as Date, count(distinct Sku) as "Distinct Skus Picked"
from pick where Sku is not null and UserName is not null and coalesce(PickCompleteDate, TimeStamp) is not null
  and coalesce(ActualPickQuantity, 0) >= coalesce(RequiredPickQuantity, 0)
group by cast(coalesce(PickCompleteDate, TimeStamp) as date)""")
def p25(t):
    return canon(P.distinct_skus_picked(t.pick))


_ONHAND = {
    "P26_total_skus_on_hand": ("Total SKUs On Hand", "count(distinct coalesce(uom_product, UnitOfMeasurePrimaryKey))"),
    "P26_total_units_on_hand": ("Total Units On Hand", "sum(coalesce(Quantity, 0))"),
    "P26_total_locations_occupied": ("Total Locations Occupied",
                                     "count(distinct concat(ContainerPrimaryKey, '|', ContainerX, '|', ContainerY))"),
    "P27_distinct_bins_inventory_added": ("Distinct bins inventory added", "count(distinct ContainerPrimaryKey)"),
    "P27_distinct_bin_compartments_with_inventory": ("Distinct bin compartments that had inventory",
                                                     "count(distinct concat(ContainerPrimaryKey, '|', ContainerX, '|', ContainerY))"),
}
for _key, (_metric, _agg) in _ONHAND.items():
    def _fn(t, _metric=_metric):
        return canon(P.on_hand(t.inventory, t.containers, t.units_of_measure, _metric, as_of=AS_OF_DATE))
    register(_key, f"select '{AS_OF}' as Date, cast({_agg} as bigint) as \"{_metric}\" from onhand_rows")(_fn)


_PUTAWAY_SQL = {
    "Orders Putaway": "select cast(LastUpdatedDateInventory as date) as d, count(distinct PrimaryKey) as v from closed_pac group by 1",
    "Units Putaway": """select cast(pac.LastUpdatedDateInventory as date) as d, sum(coalesce(li.ActualQuantity, 0)) as v
        from closed_pac pac join putaway_lines li on li.PutAwayContainerPrimaryKey = pac.PrimaryKey
        where coalesce(li.ActualQuantity, 0) > 0 group by 1""",
    "Skus Putaway": """select cast(pac.LastUpdatedDateInventory as date) as d,
        count(distinct coalesce(uom.ProductPrimaryKey, li.UnitOfMeasurePrimaryKey)) as v
        from closed_pac pac join putaway_lines li on li.PutAwayContainerPrimaryKey = pac.PrimaryKey
        left join units_of_measure uom on uom.PrimaryKey = li.UnitOfMeasurePrimaryKey and uom.Snapshot_Id = li.Snapshot_Id
        where coalesce(li.ActualQuantity, 0) > 0 group by 1""",
    "Presentations Putaway": """select cast(pac.LastUpdatedDateInventory as date) as d,
        count(distinct concat(pac.PrimaryKey, '|', coalesce(itp.LocationPrimaryKey, -1), '|', coalesce(ita.NewContainerPrimaryKey, -1))) as v
        from closed_pac pac join tasks_putaway itp on itp.PutAwayContainerPrimaryKey = pac.PrimaryKey
        join inventory_tasks it on it.PrimaryKey = itp.InventoryTaskPrimaryKey
        join task_actions ita on ita.InventoryTaskPrimaryKey = it.PrimaryKey group by 1""",
}
for _metric, _sql in _PUTAWAY_SQL.items():
    def _fn(t, _metric=_metric):
        return canon(P.putaway(_metric, t.putaway_containers, t.putaway_lines, t.units_of_measure,
                               t.tasks_putaway, t.inventory_tasks, t.task_actions))
    _key = "P28_" + _metric.lower().replace(" ", "_")
    register(_key, f"select strftime(d, '%Y-%m-%d') as Date, cast(v as bigint) as \"{_metric}\" from ({_sql}) x")(_fn)


def throughput_of(t):
    return materialized(t, "_throughput", lambda: P.throughput(work_events(t), t.pick))


@register("P29_throughput", """select strftime(Date, '%Y-%m-%d') as Date, Hour, Ports, cast(OrdersCompleted as bigint) as OrdersCompleted,
  cast(LinesCompleted as bigint) as LinesCompleted, OrderCategory, cast(BinPresentationsCompleted as bigint) as BinPresentationsCompleted
from throughput""")
def p29(t):
    return canon(throughput_of(t))


def matrix_of(t):
    return materialized(t, "_matrix", lambda: P.inventory_location_summary(
        t.inventory, t.containers, t.container_templates, t.template_compartments, t.compartment_sizes, t.units_of_measure))


@register("P30_inventory_location_summary", matrix_sql())
def p30(t):
    return canon(matrix_of(t))


def _sort_sql() -> str:
    cases = " ".join(f"when '{n}' then {i}" for i, n in enumerate(P.MATRIX_METRICS, start=1))
    return f"select *, cast(case MetricName {cases} else 99999 end as bigint) as MetricSort from ({matrix_sql()}) m"


@register("P31_metric_sort", _sort_sql())
def p31(t):
    return canon(P.metric_sort(matrix_of(t)))


@register("P32_consolidation", """select Sku, cast(UnitOfMeasurePrimaryKey as bigint) as UnitOfMeasurePrimaryKey, CompartmentSizeName,
  cast(Quantity as bigint) as Quantity, cast(TotalCompartments as bigint) as TotalCompartments,
  cast(TotalUnrealizedCapacity as bigint) as TotalUnrealizedCapacity, PercentFragmentation,
  AverageUnrealizedCapacity, StandardDeviationUnrealizedCapacity,
  cast(CompartmentSizeCapacity as bigint) as CompartmentSizeCapacity, cast(IdealizedCompartmentUsage as bigint) as IdealizedCompartmentUsage,
  cast(IdealizedUnrealizedCapacity as bigint) as IdealizedUnrealizedCapacity, cast(IdealizedPercentFragmentation as bigint) as IdealizedPercentFragmentation
from defrag_detail""")
def p32(t):
    return canon(P.consolidation(t.defrag_detail))


def open_rows_of(t):
    return P.open_work_rows(t.fulfillment_orders, t.fulfillment_lines, t.putaway_containers, t.putaway_lines,
                            t.inventory_tasks, t.tasks_cyclecount)


@register("P33_open_work", """select MetricName,
  cast(case when MetricName = 'Orders Cycle Count' then count(distinct ItemKey) else count(*) end as bigint) as SourceRows,
  strftime(min(cast(LastUpdatedDate as date)), '%Y-%m-%d') as MinDate, strftime(max(cast(LastUpdatedDate as date)), '%Y-%m-%d') as MaxDate
from open_rows group by MetricName""")
def p33(t):
    return canon(P.open_work(open_rows_of(t)))


@register("P34_open_work_trend", """select MetricName, strftime(cast(LastUpdatedDate as date), '%Y-%m-%d') as Date,
  cast(case when MetricName = 'Orders Cycle Count' then count(distinct ItemKey) else count(*) end as bigint) as OpenWork
from open_rows group by MetricName, cast(LastUpdatedDate as date)""")
def p34(t):
    return canon(P.open_work_trend(open_rows_of(t)))


@register("P36_throughput_chart", """select Hour, Ports, cast(sum(OrdersCompleted) as bigint) as KPI_Selected
from throughput where Ports not in ('No Data', 'Unknown') group by Hour, Ports""")
def p36(t):
    return canon(P.throughput_chart(throughput_of(t), "Orders", "Ports"))


_CHART = {"Orders": "sum(OrdersCompleted)", "Lines": "sum(LinesCompleted)", "Bins": "sum(BinPresentationsCompleted)",
          "All": "sum(OrdersCompleted) + sum(LinesCompleted) + sum(BinPresentationsCompleted)"}
for _metric, _sum in _CHART.items():
    for _series in ("Ports", "OrderCategory"):
        def _chart(t, _metric=_metric, _series=_series):
            return canon(P.throughput_chart(throughput_of(t), _metric, _series))
        register(f"P36_chart_{_metric.lower()}_{_series.lower()}", f"""select Hour, {_series}, cast({_sum} as bigint) as KPI_Selected
from throughput where {_series} not in ('No Data', 'Unknown') group by Hour, {_series}""")(_chart)


@register("P39_date_hierarchy", """select strftime(d, '%Y-%m-%d') as Date, cast(year(d) as bigint) as Year, cast(month(d) as bigint) as MonthNo,
  strftime(d, '%B') as Month, cast(floor((month(d) + 2) / 3) as bigint) as QuarterNo,
  'Qtr ' || cast(cast(floor((month(d) + 2) / 3) as bigint) as varchar) as Quarter, cast(day(d) as bigint) as Day
from (select unnest(generate_series(make_date(min(year(PickCompleteDate)), 1, 1), make_date(max(year(PickCompleteDate)), 12, 31),
      interval 1 day))::date as d from pick) x""")
def p39(t):
    return canon(P.date_hierarchy(t.pick, "PickCompleteDate"))


@register("P40_dim_users", "select distinct Users from r09 where Users is not null and Users <> 'Unattributed'")
def p40u(t):
    return canon(P.dim_users(daily_of(t)))


@register("P40_dim_ports", """select Ports, coalesce(try_cast(replace(Ports, 'P', '') as double), 999999.0) as SortOrder
from (select distinct Ports from r09) x where Ports is not null and Ports not in ('No Data', 'Unattributed')""")
def p40p(t):
    return canon(P.dim_ports(daily_of(t)))


# ---- published tables: written, replaced and read again ----------------------------------------------

def _published(t, name: str, df):
    """Publish some rows first, then all, and read what is in force."""
    path = f"{checkpoint_dir(t.spark).rstrip('/')}/opsgrain-tables/{name}-{uuid.uuid4().hex}"
    publish(df.where(F.xxhash64(*df.columns) % 2 == 0), path)
    publish(df, path)
    return canon(read_published(t.spark, path))


register("P30_published_matrix", REGISTRY["P30_inventory_location_summary"][1])(lambda t: _published(t, "matrix", matrix_of(t)))
register("P32_published_consolidation", REGISTRY["P32_consolidation"][1])(lambda t: _published(t, "consolidation", P.consolidation(t.defrag_detail)))
