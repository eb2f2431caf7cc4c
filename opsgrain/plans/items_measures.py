"""Registered queries for the measures (M), the KPI matrix (P35) and the
productivity table (P37)."""

from __future__ import annotations

import datetime as dt

from opsgrain.oracle.pages_sql import AS_OF
from opsgrain.plans import measures as M
from opsgrain.plans import pages as P
from opsgrain.plans.catalog import add_ctes, canon, register
from opsgrain.plans.items_pages import AS_OF_DATE, _rollup_of, daily_of, throughput_of

WINDOW_START = AS_OF_DATE - dt.timedelta(days=6)   # report default: today-6 .. today
W0, W1 = WINDOW_START.isoformat(), AS_OF

add_ctes({
    "inv_np": "select * from inventory where coalesce(Status, '') <> 'Pending'",
    "cont_ok": "select distinct PrimaryKey from containers where coalesce(Status, '') <> 'Outside' and PrimaryKey is not null",
    "cont_all": "select distinct PrimaryKey from containers where PrimaryKey is not null",
    "gtp_tmpl": "select distinct PrimaryKey from container_templates where IsGoodsToPerson and PrimaryKey is not null",
    "barcodes": """select c.PrimaryKey as ContainerPrimaryKey, k.ContainerSide, k.XPosition, k.YPosition
from cont1 c join template_compartments k on k.TemplatePrimaryKey = c.TemplatePrimaryKey""",
})


def model_of(t):
    m = t.__dict__.get("_model")
    if m is None:
        m = t.__dict__["_model"] = M.Model(t, lambda: daily_of(t), lambda: throughput_of(t))
    return m


def pct_text_sql(n: str, d: str) -> str:
    c = f"(cast({n} as bigint) * 20000 + ({d})) // (2 * ({d}))"
    txt = (f"(case when {c} % 100 = 0 then cast({c} // 100 as varchar) "
           f"when {c} % 10 = 0 then cast({c} // 100 as varchar) || '.' || cast(({c} % 100) // 10 as varchar) "
           f"else cast({c} // 100 as varchar) || '.' || lpad(cast({c} % 100 as varchar), 2, '0') end)")
    return f"(case when ({d}) = 0 then '0%' else {txt} || '%' end)"


M01 = "select count(distinct ContainerPrimaryKey) as v from inv_np where coalesce(Quantity, 0) > 0 and ContainerPrimaryKey in (select PrimaryKey from cont_ok)"
M02 = "select count(distinct ContainerPrimaryKey) as v from inv_np where coalesce(Quantity, 0) = 0 and ContainerPrimaryKey in (select PrimaryKey from cont_ok)"
M03 = "select count(distinct PrimaryKey) as v from containers where coalesce(Status, '') <> 'Outside' and TemplatePrimaryKey in (select PrimaryKey from gtp_tmpl)"
M06 = ("select count(distinct (ContainerPrimaryKey, ContainerX, ContainerY)) as v from inv_np "
       "where ContainerPrimaryKey in (select PrimaryKey from cont_all)")
M07 = """select
  (select count(*) from containers where coalesce(Status, '') <> 'Outside' and TemplatePrimaryKey in (select PrimaryKey from gtp_tmpl))
  * (select count(*) from template_compartments)
  - (select count(*) from containers c join template_compartments k on true
     where coalesce(c.Status, '') <> 'Outside' and c.TemplatePrimaryKey in (select PrimaryKey from gtp_tmpl)
       and exists (select 1 from inv_np i where i.ContainerPrimaryKey = c.PrimaryKey and i.ContainerX = k.XPosition
                   and i.ContainerY = k.YPosition)) as v"""
M08 = ("select count(distinct (ContainerPrimaryKey, XPosition, YPosition)) as v from barcodes "
       "where ContainerPrimaryKey in (select PrimaryKey from cont_all)")
M11 = ("select count(distinct UnitOfMeasurePrimaryKey) as v from inv_np "
       "where ContainerPrimaryKey in (select PrimaryKey from cont_ok)")
M12 = "select coalesce(sum(Quantity), 0) as v from (select distinct PrimaryKey, Quantity from inv_np) x"

_SCALAR = {
    "M01_total_bins_with_inventory": ("Total Bin(s) w/ Inventory", lambda m: M.total_bins_with_inventory(m), f"select v from ({M01})"),
    "M02_total_bins_no_inventory": ("Total Bin(s) w/ No Inventory", lambda m: M.total_bins_with_inventory(m, True), f"select v from ({M02})"),
    "M03_total_bins": ("Total Bin(s)", M.total_bins, f"select v from ({M03})"),
    "M04_pct_bins_with_inventory": ("% of Bin(s) w/ Inventory", lambda m: M.pct_bins(m),
                                    f"select {pct_text_sql('n', 'd')} as v from (select ({M01}) as n, ({M03}) as d)"),
    "M05_pct_bins_no_inventory": ("% of Bin(s) w/ No Inventory", lambda m: M.pct_bins(m, True),
                                  f"select {pct_text_sql('n', 'd')} as v from (select ({M02}) as n, ({M03}) as d)"),
    "M06_locations_occupied_2": ("Total Locations Occupied 2", M.locations_occupied_2, f"select v from ({M06})"),
    "M07_locations_empty": ("Total Locations Empty", M.locations_empty, f"select v from ({M07})"),
    "M08_total_locations": ("Total Locations", M.total_locations, f"select v from ({M08})"),
    "M09_pct_locations_occupied": ("% Locations Occupied", lambda m: M.pct_locations(m),
                                   f"select {pct_text_sql('n', 'd')} as v from (select ({M06}) as n, ({M08}) as d)"),
    "M10_pct_locations_empty": ("% Locations Empty", lambda m: M.pct_locations(m, True),
                                f"select {pct_text_sql('n', 'd')} as v from (select ({M07}) as n, ({M08}) as d)"),
    "M11_distinct_skus_stocked": ("Distinct SKUs Stocked", M.distinct_skus_stocked, f"select v from ({M11})"),
    "M12_units_stocked": ("Units Stocked", M.units_stocked, f"select v from ({M12})"),
    "M13_pct_units_stocked": ("% Units Stocked", M.pct_units_stocked,
                              f"select case when b = 0 then 0.0 else a / b end as v from (select ({M12}) as a, ({M12}) as b)"),
    "M14_pct_total_bins": ("% of Total Bin(s)", M.pct_total_bins,
                           f"select case when c = 0 then 0.0 else (a + b) / c end as v from (select ({M01}) as a, ({M02}) as b, ({M03}) as c)"),
    "M15_avg_units_per_location": ("Avg Units Stocked Per Location", M.avg_units_per_location, """
select case when d = 0 then 0.0 else t / d end as v from (
  select (select coalesce(sum(Quantity), 0) from inventory where ContainerPrimaryKey in (select PrimaryKey from cont_all)
            and ContainerX in (select XPosition from template_compartments) and ContainerY in (select YPosition from template_compartments)) as t,
         (select count(*) from cont_all) * (select count(distinct XPosition) from template_compartments)
           * (select count(distinct YPosition) from template_compartments) as d)"""),
    "M16_avg_units_per_bin": ("Avg Units Stocked per Bin(s)", M.avg_units_per_bin, """
select case when n = 0 then 0.0 else ((s * 200 + n) // (2 * n)) / 100 end as v from (
  select sum(q) as s, count(*) as n from (select ContainerPrimaryKey, coalesce(sum(Quantity), 0) as q from inventory group by ContainerPrimaryKey) x)"""),
    "M17_avg_units_per_sku": ("Avg Units Stocked per SKU", M.avg_units_per_sku, """
select case when count(*) = 0 then 0.0 else sum(coalesce(q, 0)) / count(*) end as v
from (select distinct PrimaryKey from products) p
left join (select u.ProductPrimaryKey, sum(i.Quantity) as q from inventory i
           join (select distinct PrimaryKey, ProductPrimaryKey from units_of_measure) u on u.PrimaryKey = i.UnitOfMeasurePrimaryKey
           group by u.ProductPrimaryKey) s on s.ProductPrimaryKey = p.PrimaryKey"""),
    "M18_avg_locations_per_sku": ("Avg Locations Stocked per SKU", M.avg_locations_per_sku, """
select case when p = 0 then 0.0 else r / p end as v from (
  select (select count(*) from inventory where UnitOfMeasurePrimaryKey in
            (select PrimaryKey from units_of_measure where ProductPrimaryKey in (select PrimaryKey from products))) as r,
         (select count(*) from products) as p)"""),
    "M20_total_units": ("Total_Units", lambda m: M.units_stocked(m, "Total_Units"), f"select v from ({M12})"),
    "M24_pick": ("Pick", M.pick_count, "select count(*) as v from pick"),
    "M35_test_orders_putaway": ("test Orders Putaway", M.test_orders_putaway, """
select count(PrimaryKey) as v from putaway_containers where Status = 'Closed'
  and coalesce(strftime(LastUpdatedDate, '%Y-%m-%d'), '') = coalesce(strftime(LastUpdatedDateInventory, '%Y-%m-%d'), '')"""),
    "M38_open_pick_lines": ("FulfillmentOrderLinesCount (Lines)", M.open_pick_lines,
                            "select count(*) as v from fulfillment_lines where lower(Status) in ('active', 'allocated', 'allocating', 'new', 'pending')"),
    "M39_open_putaway_lines": ("PutAwayLineItemsCount (Lines)", M.open_putaway_lines, """
select count(*) as v from putaway_lines where coalesce(ActualQuantity, 0) + coalesce(MissingQuantity, 0) < coalesce(Quantity, 0)
  and PutAwayContainerPrimaryKey in (select PrimaryKey from putaway_containers where not IsClosed)"""),
    "M40_open_pick_orders": ("FulfillmentOrdersCount (Orders)", M.open_pick_orders, """
select count(*) as v from fulfillment_orders where lower(Status) in ('allocated', 'allocating', 'active', 'batched', 'new',
  'released', 'importing', 'failed allocation', 'falied allocation', 'shorted')"""),
    "M41_open_putaway_containers": ("PutAwayContainersOpenCount (Orders)", M.open_putaway_containers,
                                    "select count(*) as v from putaway_containers where not IsClosed"),
    "M43_test_open_cycle_count_tasks": ("test OpenCycleCountTasks (Lines)", M.test_open_cycle_count_tasks, """
select count(*) as v from tasks_cyclecount where InventoryTaskPrimaryKey not in
  (select PrimaryKey from inventory_tasks where IsClosed and PrimaryKey is not null)"""),
    "M44_distinct_task_groups": ("DistinctTaskGroupCount (Orders)", M.distinct_task_groups,
                                 "select count(distinct TaskGroupPrimaryKey) as v from inventory_tasks where not IsClosed"),
    "M45_cycle_count_open_tasks": ("CycleCountOpenTasks (Lines)", M.cycle_count_open_tasks, """
select count(*) as v from tasks_cyclecount where InventoryTaskPrimaryKey in (select PrimaryKey from inventory_tasks where not IsClosed)"""),
    "M46_quantity": ("Quantity", M.quantity, "select coalesce(sum(Quantity), 0) as v from inventory"),
    "M47_fragmentation": ("Fragmentation", M.fragmentation, """
select case when u is null or u + q = 0 then null else u / (u + q) end as v from
  (select sum(TotalUnrealizedCapacity) as u, sum(Quantity) as q from defrag_detail)"""),
    "M48_total_compartments": ("Total Compartments", M.total_compartments, "select sum(TotalCompartments) as v from defrag_detail"),
    "M51_distinct_locations_occupied": ("_DistinctLocationsOccupied", M.distinct_locations_occupied,
                                        "select count(distinct (ContainerPrimaryKey, ContainerX, ContainerY)) as v from inv_np"),
    "M53_distinct_total_inducted": ("_DistinctTotalInducted", M.distinct_total_inducted, f"select v from ({M11.replace('UnitOfMeasurePrimaryKey', 'ContainerPrimaryKey')})"),
    "M91_older_open_putaway_lines": ("PutAwayLineItemsCount (Lines)", lambda m: M.open_putaway_lines(m, False), """
select count(*) as v from putaway_lines where coalesce(ActualQuantity, 0) + coalesce(MissingQuantity, 0) < coalesce(Quantity, 0)"""),
    "M92_older_open_pick_orders": ("FulfillmentOrdersCount (Orders)",
                                   lambda m: M.open_pick_orders(m, M.OLDER_OPEN_ORDER_STATUSES), """
select count(*) as v from fulfillment_orders where lower(Status) in ('allocated', 'allocating', 'active', 'batched', 'new',
  'released', 'importing', 'falied allocation')"""),
    "M94_older_fragmentation": ("Fragmentation", lambda m: M.fragmentation(m, True), """
select coalesce(case when u is null or u + q = 0 then null else u / (u + q) end, 0.0) as v from
  (select sum(TotalUnrealizedCapacity) as u, sum(Quantity) as q from defrag_detail)"""),
}


for _key, (_name, _fn, _sql) in _SCALAR.items():
    def _q(t, _fn=_fn):
        return canon(_fn(model_of(t)))
    _typ = "varchar" if _key in ("M04_pct_bins_with_inventory", "M05_pct_bins_no_inventory", "M09_pct_locations_occupied",
                                 "M10_pct_locations_empty") else (
        "double" if _key in ("M13_pct_units_stocked", "M14_pct_total_bins", "M15_avg_units_per_location",
                             "M16_avg_units_per_bin", "M17_avg_units_per_sku", "M18_avg_locations_per_sku",
                             "M47_fragmentation", "M94_older_fragmentation") else "bigint")
    register(_key, f'select cast(v as {_typ}) as "{_name}" from ({_sql}) r')(_q)


@register("M19_M21_M22_M49_throughput_sums", """select cast(sum(BinPresentationsCompleted) as bigint) as Bins,
  cast(sum(OrdersCompleted) as bigint) as Orders, cast(sum(LinesCompleted) as bigint) as Lines,
  cast(sum(OrdersCompleted) + sum(LinesCompleted) + sum(BinPresentationsCompleted) as bigint) as "All_Orders+Lines+Bins"
from throughput""")
def m19(t):
    return canon(M.throughput_sums(model_of(t)))


@register("M23_kpi_selected", 'select cast(sum(OrdersCompleted) + sum(LinesCompleted) + sum(BinPresentationsCompleted) as bigint) as KPI_Selected from throughput')
def m23(t):
    return canon(M.kpi_selected(model_of(t), "All"))


@register("M34_selected_metric_value", "select cast(sum(LinesCompleted) as bigint) as SelectedMetricValue from throughput")
def m34(t):
    return canon(M.kpi_selected(model_of(t), "Lines", "SelectedMetricValue"))


@register("M27_M29_order_measures", """select count(distinct OrderNumber) as "Orders HD", count(*) as "Lines HD",
  cast(sum(EachUnitCount) as bigint) as "Units HD" from order_rows""")
def m27(t):
    return canon(M.order_measures(model_of(t)))


@register("M31_pick_owh", 'select count(TransportOrderPrimaryKey) as "Pick OWH" from pick')
def m31(t):
    return canon(M.pick_owh(model_of(t), "Orders"))


for _name, _choice, _what in [("lines", "Lines", "PercentOfOrderLine"), ("bins", "Bins", "PrimaryKey"), ("all", "All", "*")]:
    def _owh(t, _choice=_choice):
        return canon(M.pick_owh(model_of(t), _choice))
    register(f"M31_pick_owh_{_name}", f'select count({_what}) as "Pick OWH" from pick')(_owh)


@register("M42_kpi_selected_owh", """select cast(count(*) as bigint) as KPI_Selected_OWH from putaway_lines
where coalesce(ActualQuantity, 0) + coalesce(MissingQuantity, 0) < coalesce(Quantity, 0)
  and PutAwayContainerPrimaryKey in (select PrimaryKey from putaway_containers where not IsClosed)""")
def m42(t):
    return canon(M.kpi_selected_owh(model_of(t), "All", "Lines Put"))


# ---- daily KPI sums (M52, M54-M65) --------------------------------------------------------

def _kpi_view_sql(metric: str) -> str:
    """Per-date SQL of one KPI view, from the P oracles."""
    from opsgrain.plans.catalog import REGISTRY
    key = {
        "Total SKUs On Hand": "P26_total_skus_on_hand", "Total Units On Hand": "P26_total_units_on_hand",
        "Total Locations Occupied": "P26_total_locations_occupied", "Orders Putaway": "P28_orders_putaway",
        "Units Putaway": "P28_units_putaway", "Skus Putaway": "P28_skus_putaway",
        "Presentations Putaway": "P28_presentations_putaway", "Distinct bins inventory added": "P27_distinct_bins_inventory_added",
        "Distinct bin compartments that had inventory": "P27_distinct_bin_compartments_with_inventory",
        "Customer Orders Picked": "P24_customer_orders_picked", "Customer Order Lines": "P24_customer_order_lines",
        "Units Picked": "P24_units_picked", "Distinct Skus Picked": "P25_distinct_skus_picked",
    }[metric]
    return REGISTRY[key][1]


_KPI_MEASURES = [
    ("M52_presentations_putaway", "Presentations Putaway"), ("M54_distinct_bin_compartments", "Distinct bin compartments that had inventory"),
    ("M55_units_picked", "Units Picked"), ("M56_distinct_skus_picked", "Distinct Skus Picked"),
    ("M57_orders_putaway", "Orders Putaway"), ("M58_units_putaway", "Units Putaway"), ("M59_skus_putaway", "Skus Putaway"),
    ("M60_customer_orders_picked", "Customer Orders Picked"), ("M61_customer_order_lines", "Customer Order Lines"),
    ("M62_total_locations_occupied", "Total Locations Occupied"), ("M63_total_skus_on_hand", "Total SKUs On Hand"),
    ("M64_total_units_on_hand", "Total Units On Hand"), ("M65_distinct_bins_inventory_added", "Distinct bins inventory added"),
]
for _key, _metric in _KPI_MEASURES:
    def _q(t, _metric=_metric):
        return canon(M.kpi_sum(model_of(t), _metric, AS_OF_DATE))
    register(_key, f'select cast(coalesce(sum("{_metric}"), 0) as bigint) as "{_metric}" from ({_kpi_view_sql(_metric)}) v')(_q)


def _kpi_long_sql() -> str:
    parts = []
    for _, _, _, _, metric in M.KPI_ROWS:
        parts.append(f"select '{metric}' as Metric, Date, cast(\"{metric}\" as bigint) as Value from ({_kpi_view_sql(metric)}) v")
    return " union all ".join(parts)


def _kpi_matrix_sql() -> str:
    rows = ", ".join(f"('{g}', '{n}', {s}, {gs}, '{v}')" for g, n, s, gs, v in M.KPI_ROWS)
    return f"""
select r.GroupName, r.MeasureName, cast(r.SortOrder as bigint) as SortOrder, cast(r.GroupSortOrder as bigint) as GroupSortOrder,
  strftime(d.Date, '%Y-%m-%d') as Date, cast(coalesce(v.Value, 0) as bigint) as _DynamicMeasure
from (values {rows}) r(GroupName, MeasureName, SortOrder, GroupSortOrder, Metric)
join (select cast(unnest(generate_series(date '{W0}', date '{W1}', interval 1 day)) as date) as Date) d on true
left join (select Metric, cast(Date as date) as Date, sum(Value) as Value from ({_kpi_long_sql()}) k
           where cast(Date as date) between date '{W0}' and date '{W1}' group by Metric, cast(Date as date)) v
  on v.Metric = r.Metric and v.Date = d.Date"""


register("P35_kpi_matrix", _kpi_matrix_sql())(
    lambda t: canon(M.kpi_matrix(model_of(t), WINDOW_START, AS_OF_DATE, AS_OF_DATE)))


# ---- productivity (M66-M88, P37) ----------------------------------------------------------

def _prod_sums_sql(dim: str | None, window: bool) -> str:
    where = ["WorkType = 'Pick'"]
    if dim == "Users":
        where.append("Users is not null and Users <> 'Unattributed'")
    elif dim == "Ports":
        where.append("Ports is not null and Ports not in ('No Data', 'Unattributed')")
    if window:
        where.append(f"EventDate between date '{W0}' and date '{W1}'")
    g = f"{dim}, " if dim else ""
    grp = f" group by {dim}" if dim else ""
    return f"""select {g}sum(OrdersCompleted) as o, sum(BinPresentationsCompleted) as b, sum(LinesCompleted) as l,
  sum(UnitsCompleted) as u, sum(TotalLoggedMinutes_u) as tlm, sum(ActiveHandleMinutes_u) as ahm,
  sum(MachineWaitMinutes_u) as mwm, sum(RateDenominatorHours_u) as rdh
from r09 where {' and '.join(where)}{grp}"""


_SRC = {"OrdersCompleted": "o", "BinPresentationsCompleted": "b", "LinesCompleted": "l", "UnitsCompleted": "u",
        "TotalLoggedMinutes": "tlm", "MachineWaitMinutes": "mwm"}
_ACT = "((o + b + l + u) * 10000 + tlm + ahm + mwm + rdh)"


def _prod_value_sql(kind: str, src) -> str:
    if kind == "sum":
        v = f"cast({_SRC[src]} as bigint)"
    elif kind == "sum_dec":
        v = f"{_SRC[src]} / 10000"
    elif kind == "aht":
        v = "case when b <> 0 then ahm / (b * 10000) end"
    else:
        v = f"case when rdh <> 0 then {_SRC[src]} * 10000 / rdh end"
    return f"case when {_ACT} > 0 then {v} end"


@register("M66_productivity_pick_activity", f'select {_ACT} / 10000 as "Productivity Pick Activity" from ({_prod_sums_sql(None, False)}) s')
def m66(t):
    return canon(M.productivity_activity(daily_of(t)))


_PROD_IDS = {"Users": 67, "Ports": 78}
for _dim, _specs in M.PRODUCTIVITY.items():
    for _j, (_name, _kind, _src) in enumerate(_specs):
        _mid = _PROD_IDS[_dim] + _j
        _slug = _name.lower().replace("/", "_per_").replace(" ", "_")
        def _q(t, _name=_name, _dim=_dim):
            return canon(M.productivity_measure(daily_of(t), _name, _dim))
        register(f"M{_mid}_{_slug}",
                 f'select {_dim}, v as "{_name}" from (select {_dim}, {_prod_value_sql(_kind, _src)} as v '
                 f'from ({_prod_sums_sql(_dim, False)}) s) x where v is not null')(_q)


def _prod_table_sql(dim: str) -> str:
    cols = ", ".join(f'{_prod_value_sql(k, s)} as "{n}"' for n, k, s in M.PRODUCTIVITY[dim])
    names = " or ".join(f'"{n}" is not null' for n, _, _ in M.PRODUCTIVITY[dim])
    return f"select * from (select {dim}, {cols} from ({_prod_sums_sql(dim, True)}) s) x where {names}"


register("P37_productivity_table_users", _prod_table_sql("Users"))(
    lambda t: canon(M.productivity_table(daily_of(t), "Users", WINDOW_START, AS_OF_DATE)))
register("P37_productivity_table_ports", _prod_table_sql("Ports"))(
    lambda t: canon(M.productivity_table(daily_of(t), "Ports", WINDOW_START, AS_OF_DATE)))


def _m90_sql() -> str:
    cols = []
    for name, _, out, _, kind in P.HELPER_VIEWS:
        v = f"coalesce(sum({out}), 0)"
        v = f"round(cast({v} as double), 9)" if kind in ("rate", "float") else f"cast({v} as bigint)"
        cols.append(f'(select {v} from hv_{name}) as "{name}"')
    return "select " + ", ".join(cols)


@register("M90_older_helper_sums", _m90_sql())
def m90(t):
    return canon(M.older_helper_sums(_rollup_of(t, "Users"), _rollup_of(t, "Ports")))


@register("M95_older_port_sort", """select distinct Ports, try_cast(substr(replace(Ports, 'No Data', 'P-1'), 2) as double) as SortOrder
from hv_OrdersCompletedPerPort""")
def m95(t):
    from pyspark.sql import functions as F
    h = P.helper_view(_rollup_of(t, "Ports"), "OrdersCompletedPerPort")
    return canon(h.select("Ports", M.older_port_sort(F.col("Ports")).alias("SortOrder")).distinct())


@register("M36_test_customer_orders_picked", """select count(*) as "test Customer Orders Picked" from fulfillment_orders
where lower(Status) = 'completed' and cast(LastUpdatedDate as date) is not distinct from cast(LastUpdatedDateInventory as date)""")
def m36(t):
    return canon(M.test_customer_orders_picked(model_of(t)))


@register("M93_older_cycle_count_open", """select count(distinct t.TaskGroupPrimaryKey) as "DistinctTaskGroupCount (Orders)",
  count(*) as "CycleCountOpenTasks (Lines)"
from tasks_cyclecount cc join inventory_tasks t on t.PrimaryKey = cc.InventoryTaskPrimaryKey
  and cast(t.LastUpdatedDate as date) = cast(cc.LastUpdatedDate as date) where not t.IsClosed""")
def m93(t):
    return canon(M.older_cycle_count_open(model_of(t)))


@register("M37_test_customer_order_lines", """select count(*) as "test Customer Order Lines" from fulfillment_lines
where cast(LastUpdatedDate as date) is not distinct from cast(LastUpdatedDateInventory as date)""")
def m37(t):
    return canon(M.test_customer_order_lines(model_of(t)))


# ---- measures under filters and grouping -------------------------------------------------------------

def _sliced(key: str, sql: str, fn, by=(), where=None, both=(), treatas=(), **options):
    register(key, sql)(lambda t: canon(M.measure(fn, model_of(t), by, where, both, treatas, **options)))


_IN_OK = "ContainerPrimaryKey in (select PrimaryKey from cont_ok)"
_sliced("M01_by_position", f"""select cast(ContainerX as bigint) as ContainerX, cast(ContainerY as bigint) as ContainerY, count(distinct ContainerPrimaryKey) as "Total Bin(s) w/ Inventory"
from inv_np where Quantity > 0 and {_IN_OK} group by all""", M.total_bins_with_inventory, ["ContainerX", "ContainerY"])
_sliced("M01_of_template", """select count(distinct ContainerPrimaryKey) as "Total Bin(s) w/ Inventory" from inv_np i where Quantity > 0
and exists (select 1 from containers c where c.PrimaryKey = i.ContainerPrimaryKey and c.TemplatePrimaryKey = 2 and c.Status is distinct from 'Outside')""",
        M.total_bins_with_inventory, where={"container_templates": "PrimaryKey = 2"})
_sliced("M03_by_template", """select TemplatePrimaryKey, count(distinct PrimaryKey) as "Total Bin(s)" from containers
where Status is distinct from 'Outside' and TemplatePrimaryKey in (select PrimaryKey from gtp_tmpl) group by all""", M.total_bins, ["TemplatePrimaryKey"])
_sliced("M04_of_snapshot", f"""select {pct_text_sql('n', 'd')} as "% of Bin(s) w/ Inventory" from (select
  (select count(distinct ContainerPrimaryKey) from inv_np where Quantity > 0 and ContainerPrimaryKey in (select PrimaryKey from containers where Snapshot_Id = 1 and Status is distinct from 'Outside')) as n,
  (select count(distinct PrimaryKey) from containers where Snapshot_Id = 1 and Status is distinct from 'Outside' and TemplatePrimaryKey in (select PrimaryKey from gtp_tmpl)) as d) r""",
        M.pct_bins, where={"containers": "Snapshot_Id = 1"})
_sliced("M06_by_position", """select cast(ContainerX as bigint) as ContainerX, cast(ContainerY as bigint) as ContainerY, count(distinct (ContainerPrimaryKey, ContainerX, ContainerY)) as "Total Locations Occupied 2"
from inv_np where ContainerPrimaryKey in (select PrimaryKey from cont_all) group by all""", M.locations_occupied_2, ["ContainerX", "ContainerY"])
_sliced("M11_by_status", f"""select Status, count(distinct UnitOfMeasurePrimaryKey) as "Distinct SKUs Stocked" from inv_np where {_IN_OK} group by all""",
        M.distinct_skus_stocked, ["Status"])
_sliced("M12_by_unit", """select UnitOfMeasurePrimaryKey, cast(sum(Quantity) as bigint) as "Units Stocked"
from (select distinct PrimaryKey, Quantity, UnitOfMeasurePrimaryKey from inv_np) x group by all""", M.units_stocked, ["UnitOfMeasurePrimaryKey"])
_sliced("M13_by_unit", f"""select UnitOfMeasurePrimaryKey, cast(sum(Quantity) as bigint) / cast(({M12}) as bigint) as "% Units Stocked"
from (select distinct PrimaryKey, Quantity, UnitOfMeasurePrimaryKey from inv_np) x group by all""", M.pct_units_stocked, ["UnitOfMeasurePrimaryKey"])
_sliced("M13_of_product", f"""select (select cast(coalesce(sum(Quantity), 0) as bigint) from (select distinct PrimaryKey, Quantity from inv_np where UnitOfMeasurePrimaryKey in
  (select PrimaryKey from units_of_measure where ProductPrimaryKey = 7)) x) / cast(({M12}) as bigint) as "% Units Stocked" """,
        M.pct_units_stocked, where={"products": "PrimaryKey = 7"})
_sliced("M46_by_template_of_container", """select ContainerX, cast(sum(Quantity) as bigint) as Quantity from inventory
where ContainerPrimaryKey in (select PrimaryKey from containers where TemplatePrimaryKey in (1, 3)) group by all""",
        M.quantity, ["ContainerX"], {"container_templates": "PrimaryKey in (1, 3)"})
_sliced("M53_by_position", f"""select cast(ContainerX as bigint) as ContainerX, count(distinct ContainerPrimaryKey) as "_DistinctTotalInducted" from inv_np where {_IN_OK} group by all""",
        M.distinct_total_inducted, ["ContainerX"])
_THR_SUMS = """cast(sum(BinPresentationsCompleted) as bigint) as Bins, cast(sum(OrdersCompleted) as bigint) as Orders, cast(sum(LinesCompleted) as bigint) as Lines,
  cast(sum(OrdersCompleted) + sum(LinesCompleted) + sum(BinPresentationsCompleted) as bigint) as "All_Orders+Lines+Bins" """
_sliced("M19_M21_M22_M49_by_port", f"select Ports, {_THR_SUMS} from throughput group by all", M.throughput_sums, ["Ports"])
_sliced("M19_M21_M22_M49_of_category", f"select Hour, {_THR_SUMS} from throughput where OrderCategory = 'Web' group by all",
        M.throughput_sums, ["Hour"], {"throughput": "OrderCategory = 'Web'"})
_sliced("M24_by_user", 'select UserName, count(*) as "Pick" from pick group by all', M.pick_count, ["UserName"])
_sliced("M27_M29_by_port", """select Port, count(distinct OrderNumber) as "Orders HD", count(*) as "Lines HD", cast(sum(EachUnitCount) as bigint) as "Units HD"
from order_rows group by all""", M.order_measures, ["Port"])
_sliced("M38_by_status", """select Status, count(*) as "FulfillmentOrderLinesCount (Lines)" from fulfillment_lines
where lower(Status) in ('active', 'allocated', 'allocating', 'new', 'pending') group by all""", M.open_pick_lines, ["Status"])
_sliced("M39_of_recent_containers", f"""select count(*) as "PutAwayLineItemsCount (Lines)" from putaway_lines where coalesce(ActualQuantity, 0) + coalesce(MissingQuantity, 0) < coalesce(Quantity, 0)
and PutAwayContainerPrimaryKey in (select PrimaryKey from putaway_containers where not IsClosed and LastUpdatedDate >= timestamp '2023-01-01')""",
        M.open_putaway_lines, where={"putaway_containers": "LastUpdatedDate >= timestamp '2023-01-01'"})
_sliced("M44_by_group_day", """select strftime(LastUpdatedDate, '%Y-%m-%d %H:%M:%S.%f') as LastUpdatedDate, count(distinct TaskGroupPrimaryKey) as "DistinctTaskGroupCount (Orders)"
from inventory_tasks where not IsClosed group by all""", M.distinct_task_groups, ["LastUpdatedDate"])
_sliced("M47_by_size", """select CompartmentSizeName, cast(sum(TotalUnrealizedCapacity) as bigint) / cast(sum(TotalUnrealizedCapacity) + sum(Quantity) as bigint) as Fragmentation
from defrag_detail group by all""", M.fragmentation, ["CompartmentSizeName"])
for _metric in ("Units Picked", "Orders Putaway", "Total Units On Hand"):
    _key = next(k for k, name in _KPI_MEASURES if name == _metric)
    _sliced(f"{_key}_by_date", f"""select strftime(cast(Date as date), '%Y-%m-%d') as Date, cast(sum("{_metric}") as bigint) as "{_metric}"
from ({_kpi_view_sql(_metric)}) v group by 1""",
            M.kpi_sum, ["Date"], metric=_metric, as_of=AS_OF_DATE)

# averages and the empty-location count by dimension
_EMPTY_BY = """select c.{0} as "containers_{0}", count(*) as n from containers c cross join template_compartments k
where c.Status is distinct from 'Outside' and c.TemplatePrimaryKey in (select PrimaryKey from gtp_tmpl) and not exists (
  select 1 from inv_np i where i.ContainerPrimaryKey = c.PrimaryKey and i.ContainerX = k.XPosition and i.ContainerY = k.YPosition) group by 1"""
_sliced("M07_by_container_status", f"""select "containers_Status", n as "Total Locations Empty" from ({_EMPTY_BY.format("Status")}) e""", M.locations_empty, ["containers.Status"])
_sliced("M07_by_position", """select k.XPosition as "template_compartments_XPosition", count(*) as "Total Locations Empty" from containers c cross join template_compartments k
where c.Status is distinct from 'Outside' and c.TemplatePrimaryKey in (select PrimaryKey from gtp_tmpl) and not exists (
  select 1 from inv_np i where i.ContainerPrimaryKey = c.PrimaryKey and i.ContainerX = k.XPosition and i.ContainerY = k.YPosition) group by 1""",
        M.locations_empty, ["template_compartments.XPosition"])
_sliced("M10_by_template", f"""select cast("containers_TemplatePrimaryKey" as bigint) as "containers_TemplatePrimaryKey", {pct_text_sql('n', 'd')} as "% Locations Empty" from (
  select coalesce(e."containers_TemplatePrimaryKey", b.TemplatePrimaryKey) as "containers_TemplatePrimaryKey", coalesce(n, 0) as n, coalesce(d, 0) as d
  from ({_EMPTY_BY.format("TemplatePrimaryKey")}) e full join (
    select c.TemplatePrimaryKey, count(distinct (c.PrimaryKey, k.XPosition, k.YPosition)) as d from containers c join template_compartments k using (TemplatePrimaryKey)
    where c.Snapshot_Id = (select max(Snapshot_Id) from containers) group by 1) b on e."containers_TemplatePrimaryKey" = b.TemplatePrimaryKey) r""",
        M.pct_locations, ["containers.TemplatePrimaryKey"], empty=True)
_sliced("M15_by_position", """select cast(k.XPosition as bigint) as "template_compartments_XPosition",
  cast(coalesce((select sum(i.Quantity) from inventory i where i.ContainerX = k.XPosition and i.ContainerPrimaryKey in (select PrimaryKey from cont_all)
     and i.ContainerY in (select YPosition from template_compartments y where y.XPosition = k.XPosition)), 0) as bigint)
  / cast((select count(distinct PrimaryKey) from containers) * (select count(distinct YPosition) from template_compartments y where y.XPosition = k.XPosition) as bigint) as "Avg Units Stocked Per Location"
from (select distinct XPosition from template_compartments) k""", M.avg_units_per_location, ["template_compartments.XPosition"])
_sliced("M15_by_container_status", """select s.Status as "containers_Status", cast(coalesce((select sum(Quantity) from inventory i where i.ContainerPrimaryKey in (select PrimaryKey from containers c where c.Status is not distinct from s.Status)
     and ContainerX in (select XPosition from template_compartments) and ContainerY in (select YPosition from template_compartments)), 0) as bigint)
  / cast((select count(distinct PrimaryKey) from containers c where c.Status is not distinct from s.Status) * (select count(distinct XPosition) * count(distinct YPosition) from template_compartments) as bigint) as "Avg Units Stocked Per Location"
from (select distinct Status from containers) s""", M.avg_units_per_location, ["containers.Status"])
_sliced("M16_by_status", """select Status, cast((s * 200 + n) // (2 * n) as bigint) / 100 as "Avg Units Stocked per Bin(s)" from (
  select Status, cast(sum(q) as bigint) as s, count(*) as n from (select Status, ContainerPrimaryKey, coalesce(sum(Quantity), 0) as q from inventory group by 1, 2) p group by 1) r""",
        M.avg_units_per_bin, ["Status"])
_UOM = "(select distinct PrimaryKey, ProductPrimaryKey from units_of_measure)"
_sliced("M17_by_status", f"""select Status, cast(sum(Quantity) as bigint) / cast((select count(distinct PrimaryKey) from products) as bigint) as "Avg Units Stocked per SKU"
from inventory i join {_UOM} u on u.PrimaryKey = i.UnitOfMeasurePrimaryKey where u.ProductPrimaryKey in (select PrimaryKey from products) group by 1""", M.avg_units_per_sku, ["Status"])
_sliced("M17_by_sku", f"""select p.Sku as "products_Sku", cast(coalesce(sum(q), 0) as bigint) / count(distinct p.PrimaryKey) as "Avg Units Stocked per SKU"
from products p left join (select u.ProductPrimaryKey, sum(Quantity) as q from inventory i join {_UOM} u on u.PrimaryKey = i.UnitOfMeasurePrimaryKey group by 1) s on s.ProductPrimaryKey = p.PrimaryKey group by 1""",
        M.avg_units_per_sku, ["products.Sku"])
_sliced("M18_by_template", """select cast(t as bigint) as "containers_TemplatePrimaryKey", cast(count(*) as bigint) / cast((select count(*) from products) as bigint) as "Avg Locations Stocked per SKU"
from inventory i left join (select distinct PrimaryKey, TemplatePrimaryKey as t from containers) c on c.PrimaryKey = i.ContainerPrimaryKey
where i.UnitOfMeasurePrimaryKey in (select PrimaryKey from units_of_measure where ProductPrimaryKey in (select PrimaryKey from products)) group by 1""",
        M.avg_locations_per_sku, ["containers.TemplatePrimaryKey"])
_sliced("M93_by_task_group", """select cast(t.TaskGroupPrimaryKey as bigint) as "inventory_tasks_TaskGroupPrimaryKey", count(distinct t.TaskGroupPrimaryKey) as "DistinctTaskGroupCount (Orders)",
  count(*) as "CycleCountOpenTasks (Lines)" from tasks_cyclecount cc join inventory_tasks t on t.PrimaryKey = cc.InventoryTaskPrimaryKey
  and cast(t.LastUpdatedDate as date) = cast(cc.LastUpdatedDate as date) where not t.IsClosed group by 1""", M.older_cycle_count_open, ["inventory_tasks.TaskGroupPrimaryKey"])

# filters over added and two-way relationships
_PICK_ORDERS = M.Edge("pick", "OrderNumber", "fulfillment_orders", "ExternalOrderNumber")
_COUNTED = M.Edge("tasks_cyclecount", "ContainerPrimaryKey", "containers", "PrimaryKey")
_LINE_DATES = M.Edge("fulfillment_lines", "to_date(LastUpdatedDate)", "calendar", "Date")
_sliced("M40_of_web_picks", """select count(*) as "FulfillmentOrdersCount (Orders)" from fulfillment_orders o
where lower(Status) in (select lower(Status) from fulfillment_orders where PrimaryKey in (select ItemKey from open_rows where MetricName = 'Orders Pick'))
and exists (select 1 from pick p where p.OrderNumber = o.ExternalOrderNumber and p.OrderCategory = 'Web')""", M.open_pick_orders, where={"pick": "OrderCategory = 'Web'"}, treatas=[_PICK_ORDERS])
_sliced("M24_of_active_orders", """select count(*) as "Pick" from pick where OrderNumber in (select ExternalOrderNumber from fulfillment_orders where Status = 'Active')""",
        M.pick_count, where={"fulfillment_orders": "Status = 'Active'"}, treatas=[_PICK_ORDERS])
_sliced("M44_of_counted_containers", """select count(distinct TaskGroupPrimaryKey) as "DistinctTaskGroupCount (Orders)" from inventory_tasks where not IsClosed and PrimaryKey in (
  select InventoryTaskPrimaryKey from tasks_cyclecount where ContainerPrimaryKey in (select PrimaryKey from containers where TemplatePrimaryKey = 2))""",
        M.distinct_task_groups, where={"containers": "TemplatePrimaryKey = 2"}, treatas=[_COUNTED], both=[("tasks_cyclecount", "inventory_tasks")])
_sliced("M46_of_counted_groups", """select cast(coalesce(sum(Quantity), 0) as bigint) as Quantity from inventory where ContainerPrimaryKey in (select PrimaryKey from containers where PrimaryKey in (
  select ContainerPrimaryKey from tasks_cyclecount where InventoryTaskPrimaryKey in (select PrimaryKey from inventory_tasks where TaskGroupPrimaryKey % 7 = 1)))""",
        M.quantity, where={"inventory_tasks": "TaskGroupPrimaryKey % 7 = 1"}, treatas=[_COUNTED])
_sliced("M38_of_march", """select count(*) as "FulfillmentOrderLinesCount (Lines)" from fulfillment_lines
where lower(Status) in ('active', 'allocated', 'allocating', 'new', 'pending') and month(LastUpdatedDate) = 3""", M.open_pick_lines, where={"calendar": "Month = 3"}, treatas=[_LINE_DATES])

# the selected-metric measures for every choice
_SUM_OF = {"Orders": "sum(OrdersCompleted)", "Lines": "sum(LinesCompleted)", "Bins": "sum(BinPresentationsCompleted)",
           "All": "sum(OrdersCompleted) + sum(LinesCompleted) + sum(BinPresentationsCompleted)"}
for _choice, _sum in _SUM_OF.items():
    _sliced(f"M23_kpi_selected_{_choice.lower()}_by_category", f"select OrderCategory, cast({_sum} as bigint) as KPI_Selected from throughput group by all",
            M.kpi_selected, ["OrderCategory"], metric=_choice)
    _sliced(f"M34_selected_metric_{_choice.lower()}", f"select cast({_sum} as bigint) as SelectedMetricValue from throughput",
            M.kpi_selected, metric=_choice, name="SelectedMetricValue")
for _series in M.OWH_SERIES:
    _of = f"select ItemKey from open_rows where MetricName = '{_series}'"
    _count = "count(distinct ItemKey)" if _series == "Orders Cycle Count" else "count(*)"
    if _series == "Orders Cycle Count":  # the measure counts task groups of all open tasks
        _of = "select TaskGroupPrimaryKey as ItemKey from inventory_tasks where not IsClosed"
    if _series == "Lines Cycle Count":
        _of = "select 1 as ItemKey from tasks_cyclecount where InventoryTaskPrimaryKey in (select PrimaryKey from inventory_tasks where not IsClosed)"
    for _choice in ("All", _series.split()[0]):
        _sliced(f"M42_{_choice.lower()}_{_series.lower().replace(' ', '_')}", f"select cast({_count} as bigint) as KPI_Selected_OWH from ({_of}) r",
                M.kpi_selected_owh, metric=_choice, series=_series)

# ---- put-away, cycle-count and close-bin records (M25, M26, M30, M32, M33) -------------------------------

add_ctes({
    "put_away": """select event_id, usr, if(event_id % 4 = 0, null, event_id // 8) as task_group, if(event_id % 7 = 0, null, event_id // 3) as container, if(event_id % 5 = 0, event_id % 3, null) as reason
from ev where event_type = 'purchase' and wt = 'PutAway'""",
    "cycle_counts": """select event_id, usr, if(event_id % 6 = 0, null, event_id // 7) as task_order, if(event_id % 11 = 0, null, port) as barcode, if(event_id % 5 = 0, event_id % 3, null) as reason
from ev where event_type = 'purchase' and wt = 'CycleCount'""",
    "close_bin_records": """select event_id, ts, i, case (event_id + i) % 3 when 0 then 'Pending' when 1 then 'Available' end as status,
  if((event_id + i) % 7 = 0, null, (cast(floor(value) as bigint) + i) % 5) as units
from (select *, unnest(range(event_id % 4)) as i from ev where event_type = 'click' and event_id % 2 = 0 and event_id % 9 <> 0) e""",
})
_sliced("M25_put", 'select count(*) as "Put" from put_away', M.put_count)
_sliced("M25_put_by_user", 'select usr as UserName, count(*) as "Put" from put_away group by 1', M.put_count, ["UserName"])
_sliced("M26_cycle_count", 'select count(*) as "Cycle Count" from cycle_counts', M.cycle_count)
_sliced("M30_num_bins_occupied", """select count(*) as "Num Bins Occupied" from close_bin_records where status is distinct from 'Pending' and units > 0""", M.num_bins_occupied)
_sliced("M30_by_status", """select status as InventoryStatus, count(*) filter (status is distinct from 'Pending' and units > 0) as "Num Bins Occupied" from close_bin_records group by 1""",
        M.num_bins_occupied, ["InventoryStatus"])
for _metric, _put, _cc in (("Orders", "task_group", "task_order"), ("Lines", "container", "barcode"), ("Bins", "reason", "reason"), ("All", "1", "1")):
    _sliced(f"M32_put_owh_{_metric.lower()}", f'select count({_put}) as "Put OWH" from put_away', M.put_owh, metric=_metric)
    _sliced(f"M33_cyclecount_owh_{_metric.lower()}", f'select count({_cc}) as "CycleCount OWH" from cycle_counts', M.cycle_count_owh, metric=_metric)
