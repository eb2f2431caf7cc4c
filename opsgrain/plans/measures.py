"""Semantic-layer measures (M01-M95) as DataFrame functions.

A measure is evaluated over a model (the table catalogue plus derived
report tables) with no slicers unless a window or a grouping dimension is
given.  DAX filter semantics are reproduced explicitly: ``Status <> "Pending"``
keeps BLANK statuses, ``Quantity > 0`` treats BLANK as 0, TREATAS / relationship
filters are ``left_semi`` joins on distinct keys, so rows never multiply.

Every scalar measure returns a one-row DataFrame whose single column is the
measure name.  Ratios are computed from exact integer parts so results do not
depend on floating-point evaluation order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import cached_property
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.functions.frames import beside, broadcast_if_small
from opsgrain.plans import pages as P
from opsgrain.plans.relations import Edge, Slice, keys_of, reached, within
from opsgrain.plans.relations import pair as _pair
from opsgrain.plans.relations import slices as _slices

# ---- DAX filter helpers ----------------------------------------------------------------

def not_pending(c: str = "Status") -> Column:
    return F.coalesce(F.col(c), F.lit("")) != "Pending"


def not_outside(c: str = "Status") -> Column:
    return F.coalesce(F.col(c), F.lit("")) != "Outside"


def qty() -> Column:
    return F.coalesce(F.col("Quantity"), F.lit(0))


def _keys(df: DataFrame, col: str, alias: str) -> DataFrame:
    return df.select(F.col(col).alias(alias)).dropna().dropDuplicates()


def _agg(m, df: DataFrame, *aggs: Column) -> DataFrame:
    """One row, or one per slice where ``df`` has the grouping columns."""
    keys = _slices(m, df)
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def _scalar(m, df: DataFrame, value: Column, name: str) -> DataFrame:
    return _agg(m, df, value.alias(name))


def _value(m, df: DataFrame, *values: Column) -> DataFrame:
    return df.select(*_slices(m, df), *values)


def pct_text(num: str, den: str) -> Column:
    """IF(den = 0, "0%", ROUND(num / den * 100, 2) & "%") with DAX's general
    number text (no trailing zeros)."""
    cents = F.expr(f"(CAST({num} AS BIGINT) * 20000 + ({den})) div (2 * ({den}))")
    txt = F.regexp_replace((cents.cast("decimal(38,0)") / 100).cast("decimal(38,2)").cast("string"), r"\.?0+$", "")
    txt = F.when(txt == "", F.lit("0")).otherwise(txt)
    return F.when(F.expr(f"({den}) = 0"), F.lit("0%")).otherwise(F.concat(txt, F.lit("%")))


# ---- inventory measures (M01-M18, M20, M46, M51, M53) -------------------------------------

def valid_container_keys(m) -> DataFrame:
    return _keys(m.containers.filter(not_outside()), "PrimaryKey", "ContainerPrimaryKey")


def all_container_keys(m) -> DataFrame:
    return _keys(m.containers, "PrimaryKey", "ContainerPrimaryKey")


def total_bins_with_inventory(m, empty: bool = False) -> DataFrame:
    """Distinct containers with (or without) stock, not Pending,
    container not Outside; 0 when blank."""
    cond = (qty() == 0) if empty else (qty() > 0)
    inv = m.inventory.filter(not_pending() & cond).join(valid_container_keys(m), "ContainerPrimaryKey", "left_semi")
    name = "Total Bin(s) w/ No Inventory" if empty else "Total Bin(s) w/ Inventory"
    return _scalar(m, inv, F.count_distinct("ContainerPrimaryKey").cast("bigint"), name)


def total_bins(m) -> DataFrame:
    """Distinct goods-to-person containers not Outside."""
    gtp = _keys(m.container_templates.filter(F.col("IsGoodsToPerson") == F.lit(True)), "PrimaryKey", "TemplatePrimaryKey")
    c = m.containers.filter(not_outside()).join(gtp, "TemplatePrimaryKey", "left_semi")
    return _scalar(m, c, F.count_distinct("PrimaryKey").cast("bigint"), "Total Bin(s)")


def pct_bins(m, empty: bool = False) -> DataFrame:
    """M04 / M05."""
    n = total_bins_with_inventory(m, empty).withColumnRenamed(
        "Total Bin(s) w/ No Inventory" if empty else "Total Bin(s) w/ Inventory", "_n")
    d = total_bins(m).withColumnRenamed("Total Bin(s)", "_d")
    name = "% of Bin(s) w/ No Inventory" if empty else "% of Bin(s) w/ Inventory"
    return _value(m, _pair(m, n, d), pct_text("_n", "_d").alias(name))


def locations_occupied_2(m) -> DataFrame:
    """Distinct (container, x, y) of non-Pending inventory in known containers."""
    inv = m.inventory.filter(not_pending()).join(all_container_keys(m), "ContainerPrimaryKey", "left_semi")
    return _scalar(m, inv, F.count_distinct(F.struct("ContainerPrimaryKey", "ContainerX", "ContainerY")).cast("bigint"),
                   "Total Locations Occupied 2")


def locations_empty(m) -> DataFrame:
    """(containers not Outside × every template compartment row, kept when
    the container's template is goods-to-person) minus the pairs with
    non-Pending inventory at the compartment's (x, y).  The source's cross join
    ignores the template key; the count is reproduced without materialising
    pairs: total = eligible container rows × compartment rows, occupied =
    Σ over eligible container rows of the compartment-row multiplicity of each
    occupied (x, y) of that container."""
    gtp = _keys(m.container_templates.filter(F.col("IsGoodsToPerson") == F.lit(True)), "PrimaryKey", "TemplatePrimaryKey")
    cont = m.containers.filter(not_outside()).join(gtp, "TemplatePrimaryKey", "left_semi")
    cont = cont.select(F.col("PrimaryKey").alias("ContainerPrimaryKey"), *_own(m, cont, m.containers))
    comp = m.template_compartments.select(F.col("XPosition").alias("ContainerX"), F.col("YPosition").alias("ContainerY"), *_own(m, m.template_compartments))
    stock = m.inventory.filter(not_pending())
    stock = stock.select("ContainerPrimaryKey", "ContainerX", "ContainerY", *(c for c in _slices(m, stock) if c not in (*cont.columns, *comp.columns)))
    reached(m, cont, comp, stock)
    mult = _agg_by(comp, ["ContainerX", "ContainerY", *_slices(m, comp)], F.count(F.lit(1)).alias("_mult"))
    occ = stock.dropDuplicates().join(mult, ["ContainerX", "ContainerY"])
    occ = _agg_by(occ, ["ContainerPrimaryKey", *_slices(m, occ)], F.sum("_mult").alias("_w"))
    occupied = _agg(m, cont.join(occ, "ContainerPrimaryKey"), F.coalesce(F.sum("_w"), F.lit(0)).alias("_occ"))
    n_cont = _agg(m, cont, F.count(F.lit(1)).alias("_nc"))
    n_comp = _agg(m, comp, F.count(F.lit(1)).alias("_nk"))
    every = _pair(m, _pair(m, n_cont, n_comp), occupied)
    return _value(m, every, (F.col("_nc") * F.col("_nk") - F.col("_occ")).cast("bigint").alias("Total Locations Empty"))


def _own(m, df: DataFrame, table: DataFrame | None = None) -> list[str]:
    """Grouping columns of a table under their own names."""
    return _slices(m, table if table is not None else df)


def _agg_by(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs)


def total_locations(m) -> DataFrame:
    """Distinct (container, x, y) of compartment barcodes of known containers."""
    b = m.compartment_barcodes.join(all_container_keys(m), "ContainerPrimaryKey", "left_semi")
    return _scalar(m, b, F.count_distinct(F.struct("ContainerPrimaryKey", "XPosition", "YPosition")).cast("bigint"),
                   "Total Locations")


def pct_locations(m, empty: bool = False) -> DataFrame:
    """M09 / M10."""
    n = (locations_empty(m) if empty else locations_occupied_2(m))
    n = n.withColumnRenamed(n.columns[-1], "_n")
    d = total_locations(m).withColumnRenamed("Total Locations", "_d")
    return _value(m, _pair(m, n, d), pct_text("_n", "_d").alias("% Locations Empty" if empty else "% Locations Occupied"))


def distinct_skus_stocked(m) -> DataFrame:
    """Distinct unit-of-measure keys, not Pending, container not Outside."""
    inv = m.inventory.filter(not_pending()).join(valid_container_keys(m), "ContainerPrimaryKey", "left_semi")
    return _scalar(m, inv, F.count_distinct("UnitOfMeasurePrimaryKey").cast("bigint"), "Distinct SKUs Stocked")


def units_stocked(m, name: str = "Units Stocked") -> DataFrame:
    """M12 (and M20 Total_Units, the same with all filters removed): sum of
    quantity over distinct (PrimaryKey, Quantity), not Pending."""
    u = m.inventory.filter(not_pending()).select("PrimaryKey", "Quantity", *_slices(m, m.inventory)).dropDuplicates()
    return _scalar(m, u, F.coalesce(F.sum("Quantity"), F.lit(0)).cast("bigint"), name)


def pct_units_stocked(m) -> DataFrame:
    """DIVIDE(Units Stocked, Total_Units, 0); the total is that of the
    whole model, without the caller's filters and grouping."""
    a = units_stocked(m).withColumnRenamed("Units Stocked", "_a")
    b = units_stocked(m.all(), "Total_Units").withColumnRenamed("Total_Units", "_b")
    return _value(m, _pair(m, a, b), F.when(F.col("_b") == 0, F.lit(0.0)).otherwise(F.col("_a") / F.col("_b")).alias("% Units Stocked"))


def pct_total_bins(m) -> DataFrame:
    """DIVIDE(w/ + w/o inventory, Total Bin(s), 0)."""
    a = total_bins_with_inventory(m).withColumnRenamed("Total Bin(s) w/ Inventory", "_a")
    b = total_bins_with_inventory(m, True).withColumnRenamed("Total Bin(s) w/ No Inventory", "_b")
    c = total_bins(m).withColumnRenamed("Total Bin(s)", "_c")
    j = _pair(m, _pair(m, a, b), c)
    return _value(m, j, F.when(F.col("_c") == 0, F.lit(0.0)).otherwise((F.col("_a") + F.col("_b")) / F.col("_c"))
                  .alias("% of Total Bin(s)"))


def avg_units_per_location(m) -> DataFrame:
    """Quantity of inventory whose container, x and y are known values,
    over (#containers × #x values × #y values).  The denominator is a product
    of three distinct counts; no cross product is built."""
    cont = keys_of(m, m.containers, "PrimaryKey", "ContainerPrimaryKey")
    xs = keys_of(m, m.template_compartments, "XPosition", "ContainerX")
    ys = keys_of(m, m.template_compartments, "YPosition", "ContainerY")
    reached(m, m.inventory, cont, xs)
    inv = within(m, within(m, within(m, m.inventory, cont, "ContainerPrimaryKey"), xs, "ContainerX"), ys, "ContainerY")
    total = _agg(m, inv, F.coalesce(F.sum("Quantity"), F.lit(0)).alias("_t"))
    n = [_agg(m, d, F.count(F.lit(1)).alias(name)) for d, name in ((cont, "_c"), (xs, "_x"), (ys, "_y"))]
    every = _pair(m, _pair(m, _pair(m, total, n[0]), n[1]), n[2])
    d = F.col("_c") * F.col("_x") * F.col("_y")
    return _value(m, every, F.when(d == 0, F.lit(0.0)).otherwise(F.col("_t") / d).alias("Avg Units Stocked Per Location"))


def avg_units_per_bin(m) -> DataFrame:
    """Average over inventory containers of their summed quantity, rounded
    to 2; in a slice, over the containers with inventory there."""
    reached(m, m.inventory)
    per = _agg_by(m.inventory, ["ContainerPrimaryKey", *(c for c in _slices(m, m.inventory) if c != "ContainerPrimaryKey")], F.coalesce(F.sum("Quantity"), F.lit(0)).alias("_q"))
    tot = _agg(m, per, F.sum("_q").alias("_s"), F.count(F.lit(1)).alias("_n"))
    cents = F.expr("(_s * 200 + _n) div (2 * _n)")
    return _value(m, tot, F.when(F.col("_n") == 0, F.lit(0.0)).otherwise(cents / F.lit(100)).alias("Avg Units Stocked per Bin(s)"))


def avg_units_per_sku(m) -> DataFrame:
    """Average over products of the quantity of inventory in any of the
    product's units of measure (0 for products without stock)."""
    uom = m.units_of_measure.select(F.col("PrimaryKey").alias("UnitOfMeasurePrimaryKey"), "ProductPrimaryKey").dropDuplicates()
    prods = keys_of(m, m.products, "PrimaryKey", "ProductPrimaryKey")
    reached(m, m.inventory, prods)
    held = within(m, m.inventory.join(uom, "UnitOfMeasurePrimaryKey"), prods, "ProductPrimaryKey")
    every = _pair(m, _agg(m, held, F.coalesce(F.sum("Quantity"), F.lit(0)).alias("_s")), _agg(m, prods, F.count(F.lit(1)).alias("_n")))
    return _value(m, every, F.when(F.col("_n") == 0, F.lit(0.0)).otherwise(F.col("_s") / F.col("_n")).alias("Avg Units Stocked per SKU"))


def avg_locations_per_sku(m) -> DataFrame:
    """Inventory rows whose unit of measure belongs to a known product,
    over the number of products."""
    prods = keys_of(m, m.products, "PrimaryKey", "ProductPrimaryKey")
    reached(m, m.inventory, prods)
    uom = m.units_of_measure.join(prods.select("ProductPrimaryKey").distinct(), "ProductPrimaryKey", "left_semi")
    inv = m.inventory.join(_keys(uom, "PrimaryKey", "UnitOfMeasurePrimaryKey"), "UnitOfMeasurePrimaryKey", "left_semi")
    every = _pair(m, _agg(m, inv, F.count(F.lit(1)).alias("_r")), _agg(m, m.products, F.count(F.lit(1)).alias("_p")))
    return _value(m, every, F.when(F.col("_p") == 0, F.lit(0.0)).otherwise(F.col("_r") / F.col("_p")).alias("Avg Locations Stocked per SKU"))


def quantity(m) -> DataFrame:
    """M46."""
    return _scalar(m, m.inventory, F.coalesce(F.sum("Quantity"), F.lit(0)).cast("bigint"), "Quantity")


def distinct_locations_occupied(m) -> DataFrame:
    """Distinct (container, x, y) of non-Pending inventory."""
    inv = m.inventory.filter(not_pending())
    return _scalar(m, inv, F.count_distinct(F.struct("ContainerPrimaryKey", "ContainerX", "ContainerY")).cast("bigint"),
                   "_DistinctLocationsOccupied")


def distinct_total_inducted(m) -> DataFrame:
    """Distinct containers of non-Pending inventory whose container is not Outside."""
    inv = m.inventory.filter(not_pending()).join(valid_container_keys(m), "ContainerPrimaryKey", "left_semi")
    return _scalar(m, inv, F.count_distinct("ContainerPrimaryKey").cast("bigint"), "_DistinctTotalInducted")


# ---- throughput measures (M19, M21-M23, M34, M49) ----------------------------------------------

def throughput_sums(m) -> DataFrame:
    """M19 Bins, M21 Orders, M49 Lines and M22 All_Orders+Lines+Bins in one pass."""
    t = _agg(m, m.throughput, F.sum("BinPresentationsCompleted").alias("Bins"), F.sum("OrdersCompleted").alias("Orders"),
             F.sum("LinesCompleted").alias("Lines"))
    return t.withColumn("All_Orders+Lines+Bins", F.col("Orders") + F.col("Lines") + F.col("Bins"))


def kpi_selected(m, metric: str, name: str = "KPI_Selected") -> DataFrame:
    """The throughput total for the slicer's metric (NULL otherwise)."""
    col = {"Orders": "Orders", "Lines": "Lines", "Bins": "Bins", "All": "All_Orders+Lines+Bins"}.get(metric)
    t = throughput_sums(m)
    return _value(m, t, (F.col(f"`{col}`") if col else F.lit(None).cast("bigint")).alias(name))


# ---- row counts on event tables (M24, M27-M29, M31) ------------------------------------------------

def pick_count(m) -> DataFrame:
    """M24."""
    return _scalar(m, m.pick, F.count(F.lit(1)), "Pick")


def put_count(m) -> DataFrame:
    """M25."""
    return _scalar(m, m.put_away, F.count(F.lit(1)), "Put")


def cycle_count(m) -> DataFrame:
    """M26."""
    return _scalar(m, m.cycle_counts, F.count(F.lit(1)), "Cycle Count")


def num_bins_occupied(m) -> DataFrame:
    """Close-bin inventory records that are not Pending (an unknown status
    counts) with a quantity above 0; 0 where there is none."""
    kept = not_pending("InventoryStatus") & (F.coalesce("ProductQuantity", F.lit(0)) > 0)
    return _scalar(m, m.close_bin_records, F.count_if(kept), "Num Bins Occupied")


#: The key whose presence makes an event count for a chosen metric; all events count for All.
OWH_KEYS = {
    "put_away": {"Orders": "InventoryTaskGroupPrimaryKey", "Lines": "PutAwayContainerPrimaryKey", "Bins": "ReasonCodePrimaryKey"},
    "cycle_counts": {"Orders": "TransportOrderPrimaryKey", "Lines": "LocationBarcode", "Bins": "ReasonCodePrimaryKey"},
}


def _event_owh(m, table: str, metric: str, name: str) -> DataFrame:
    key = OWH_KEYS[table].get(metric)
    value = F.count(F.lit(1)) if metric == "All" else F.count(key) if key else F.lit(None).cast("bigint")
    return _scalar(m, getattr(m, table), value, name)


def put_owh(m, metric: str) -> DataFrame:
    """M32, with the metric's name passed explicitly as in M31."""
    return _event_owh(m, "put_away", metric, "Put OWH")


def cycle_count_owh(m, metric: str) -> DataFrame:
    """M33, likewise."""
    return _event_owh(m, "cycle_counts", metric, "CycleCount OWH")


def order_measures(m) -> DataFrame:
    """M27 Orders HD, M28 Lines HD, M29 Units HD."""
    return _agg(m, m.order_rows, F.count_distinct("OrderNumber").alias("Orders HD"), F.count(F.lit(1)).alias("Lines HD"),
                F.sum("EachUnitCount").cast("bigint").alias("Units HD"))


def pick_owh(m, metric: str) -> DataFrame:
    """M31 with the metric name passed explicitly (the model compares the
    numeric selected value to text, which cannot evaluate)."""
    p = m.pick
    col = {"Orders": "TransportOrderPrimaryKey", "Lines": "PercentOfOrderLine", "Bins": "PrimaryKey"}.get(metric)
    if metric == "All":
        v = F.count(F.lit(1))
    elif col is None:
        v = F.lit(None).cast("bigint")
    elif col not in p.columns:
        v = F.lit(None).cast("bigint")
    else:
        v = F.count(F.col(col))
    return _scalar(m, p, v, "Pick OWH")


# ---- putaway / open-work measures (M35-M45, M91-M92) ------------------------------------------------

def _same_day_text(a: str, b: str) -> Column:
    """FORMAT(a, "YYYY-MM-DD") = FORMAT(b, "YYYY-MM-DD"): BLANK formats as ''."""
    fa = F.coalesce(F.date_format(F.col(a), "yyyy-MM-dd"), F.lit(""))
    fb = F.coalesce(F.date_format(F.col(b), "yyyy-MM-dd"), F.lit(""))
    return fa == fb


def test_orders_putaway(m) -> DataFrame:
    """Closed putaway containers whose two dates fall on the same day."""
    c = m.putaway_containers.filter((F.col("Status") == "Closed") & _same_day_text("LastUpdatedDate", "LastUpdatedDateInventory"))
    return _scalar(m, c, F.count("PrimaryKey"), "test Orders Putaway")


def open_pick_lines(m) -> DataFrame:
    """M38 (status list compared case-insensitively, as DAX does)."""
    li = m.fulfillment_lines.filter(F.lower("Status").isin(P.OPEN_LINE_STATUSES))
    return _scalar(m, li, F.count(F.lit(1)), "FulfillmentOrderLinesCount (Lines)")


def open_putaway_lines(m, require_open_container: bool = True) -> DataFrame:
    """M39 (and M91 without the open-container filter)."""
    li = m.putaway_lines.filter(
        F.coalesce(F.col("ActualQuantity"), F.lit(0)) + F.coalesce(F.col("MissingQuantity"), F.lit(0)) < qty())
    if require_open_container:
        open_c = _keys(m.putaway_containers.filter(F.col("IsClosed") == F.lit(False)), "PrimaryKey", "PutAwayContainerPrimaryKey")
        li = li.join(open_c, "PutAwayContainerPrimaryKey", "left_semi")
    return _scalar(m, li, F.count(F.lit(1)), "PutAwayLineItemsCount (Lines)")


# The older model's open-order status list (8 statuses).
OLDER_OPEN_ORDER_STATUSES = ["allocated", "allocating", "active", "batched", "new", "released", "importing",
                             "falied allocation"]


def open_pick_orders(m, statuses=None) -> DataFrame:
    """M40 (and M92 with the older status list)."""
    st = statuses or P.OPEN_ORDER_STATUSES
    o = m.fulfillment_orders.filter(F.lower("Status").isin(st))
    return _scalar(m, o, F.count(F.lit(1)), "FulfillmentOrdersCount (Orders)")


def open_putaway_containers(m) -> DataFrame:
    """M41."""
    return _scalar(m, m.putaway_containers.filter(F.col("IsClosed") == F.lit(False)), F.count(F.lit(1)),
                   "PutAwayContainersOpenCount (Orders)")


def _open_tasks(m) -> DataFrame:
    return m.inventory_tasks.filter(F.col("IsClosed") == F.lit(False))


def test_open_cycle_count_tasks(m) -> DataFrame:
    """Cycle-count rows whose task looks up as not closed (a missing task
    looks up as BLANK, which equals 0/FALSE in DAX)."""
    closed = _keys(m.inventory_tasks.filter(F.col("IsClosed") == F.lit(True)), "PrimaryKey", "InventoryTaskPrimaryKey")
    return _scalar(m, m.tasks_cyclecount.join(closed, "InventoryTaskPrimaryKey", "left_anti"), F.count(F.lit(1)),
                   "test OpenCycleCountTasks (Lines)")


def distinct_task_groups(m) -> DataFrame:
    """Distinct task groups of open tasks."""
    return _scalar(m, _open_tasks(m), F.count_distinct("TaskGroupPrimaryKey"), "DistinctTaskGroupCount (Orders)")


def cycle_count_open_tasks(m) -> DataFrame:
    """Cycle-count rows of open tasks (relationship filter)."""
    open_keys = _keys(_open_tasks(m), "PrimaryKey", "InventoryTaskPrimaryKey")
    return _scalar(m, m.tasks_cyclecount.join(open_keys, "InventoryTaskPrimaryKey", "left_semi"), F.count(F.lit(1)),
                   "CycleCountOpenTasks (Lines)")


OWH_SERIES = {
    "Orders Pick": open_pick_orders, "Orders Put": open_putaway_containers, "Orders Cycle Count": distinct_task_groups,
    "Lines Pick": open_pick_lines, "Lines Put": open_putaway_lines, "Lines Cycle Count": cycle_count_open_tasks,
}


def kpi_selected_owh(m, metric: str, series: str) -> DataFrame:
    """The open-work count for the selected metric and series."""
    allowed = {"Orders": [s for s in OWH_SERIES if s.startswith("Orders")],
               "Lines": [s for s in OWH_SERIES if s.startswith("Lines")], "All": list(OWH_SERIES)}.get(metric, [])
    if series not in allowed:
        return m.fulfillment_orders.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("KPI_Selected_OWH"))
    r = OWH_SERIES[series](m)
    return _value(m, r, F.col(f"`{r.columns[-1]}`").cast("bigint").alias("KPI_Selected_OWH"))


# ---- fragmentation (M47, M48, M94) ---------------------------------------------------------------------

def fragmentation(m, blank_as_zero: bool = False) -> DataFrame:
    """M47 (M94: the older model returns 0 instead of BLANK)."""
    d = _agg(m, m.defrag_detail, F.sum("TotalUnrealizedCapacity").alias("_u"), F.sum("Quantity").alias("_q"))
    v = F.when(F.col("_u").isNull() | (F.col("_u") + F.col("_q") == 0), F.lit(None).cast("double")) \
        .otherwise(F.col("_u") / (F.col("_u") + F.col("_q")))
    if blank_as_zero:
        v = F.coalesce(v, F.lit(0.0))
    return _value(m, d, v.alias("Fragmentation"))


def total_compartments(m) -> DataFrame:
    """M48."""
    return _scalar(m, m.defrag_detail, F.sum("TotalCompartments").cast("bigint"), "Total Compartments")


# ---- daily KPI sums (M52, M54-M65) and the KPI matrix (M50 / P35) ------------------------------------------

# The KPI matrix rows (GroupName, MeasureName, SortOrder, GroupSortOrder) and the
# daily view / measure behind each row.
KPI_ROWS = [
    ("Inventory", "Total SKUs On Hand", 1, 1, "Total SKUs On Hand"),
    ("Inventory", "Total Units On Hand", 2, 1, "Total Units On Hand"),
    ("Inventory", "Total Locations Occupied", 3, 1, "Total Locations Occupied"),
    ("Inbound", "Orders Put Away", 4, 2, "Orders Putaway"),
    ("Inbound", "Units Put Away", 5, 2, "Units Putaway"),
    ("Inbound", "SKUs Put Away", 6, 2, "Skus Putaway"),
    ("Inbound", "Bin Presentations Put Away", 7, 2, "Presentations Putaway"),
    ("Inbound", "Distinct Bins With Inventory", 8, 2, "Distinct bins inventory added"),
    ("Inbound", "Distinct Bin Compartments With Inventory", 9, 2, "Distinct bin compartments that had inventory"),
    ("Picking", "Customer Orders Picked", 10, 3, "Customer Orders Picked"),
    ("Picking", "Customer Order Lines", 11, 3, "Customer Order Lines"),
    ("Picking", "Units Picked", 12, 3, "Units Picked"),
    ("Picking", "Distinct SKUs Picked", 13, 3, "Distinct Skus Picked"),
]


# Report name of each daily KPI view that is not on-hand, and how it is built.
KPI_VIEWS = {
    "Orders Putaway": lambda m: P.putaway("Orders Putaway", m.putaway_containers),
    "Units Putaway": lambda m: P.putaway("Units Putaway", m.putaway_containers, m.putaway_lines),
    "Skus Putaway": lambda m: P.putaway("Skus Putaway", m.putaway_containers, m.putaway_lines, m.units_of_measure),
    "Presentations Putaway": lambda m: P.putaway("Presentations Putaway", m.putaway_containers, tasks_putaway=m.tasks_putaway,
                                                 tasks=m.inventory_tasks, actions=m.task_actions),
    "Customer Orders Picked": lambda m: P.historical(m.daily, "Customer_Orders_Picked"),
    "Customer Order Lines": lambda m: P.historical(m.daily, "Customer_Order_Lines"),
    "Units Picked": lambda m: P.historical(m.daily, "Units_Picked"),
    "Distinct Skus Picked": lambda m: P.distinct_skus_picked(m.pick),
}


def _long(df: DataFrame) -> DataFrame:
    metric = df.columns[1]
    return df.select(F.lit(metric).alias("Metric"), F.col("Date"), F.col(f"`{metric}`").cast("bigint").alias("Value"))


def kpi_views_long(m, as_of: dt.date) -> DataFrame:
    """The 13 daily KPI views in long form (Metric, Date, Value); the five
    on-hand views share one join and one aggregate."""
    out = P.on_hand_all(m.inventory, m.containers, m.units_of_measure, as_of)
    for view in KPI_VIEWS.values():
        out = out.unionByName(_long(view(m)))
    return out


def kpi_sum(m, metric: str, as_of: dt.date) -> DataFrame:
    """SUM(view[metric]) + 0 over all dates, from that view alone."""
    if metric in P.ON_HAND_METRICS:
        v = P.on_hand(m.inventory, m.containers, m.units_of_measure, metric, as_of)
    else:
        v = KPI_VIEWS[metric](m)
    v = _long(v)
    return _scalar(m, v, F.coalesce(F.sum("Value"), F.lit(0)).cast("bigint"), metric)


def kpi_matrix(m, start: dt.date, end: dt.date, as_of: dt.date) -> DataFrame:
    """The Daily-KPI matrix in long form, 13 rows × each calendar
    date of the window, missing values 0, with group and row sort orders.
    The grid is 13 × window days, built by ``explode``; the values join on
    (metric, date)."""
    rows = F.array(*[F.struct(F.lit(g).alias("GroupName"), F.lit(n).alias("MeasureName"), F.lit(s).alias("SortOrder"),
                              F.lit(gs).alias("GroupSortOrder"), F.lit(v).alias("Metric")) for g, n, s, gs, v in KPI_ROWS])
    grid = m.daily.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("Date"), F.explode(rows).alias("r")
    ).select("Date", "r.*")
    vals = kpi_views_long(m, as_of).filter(F.col("Date").between(F.lit(start), F.lit(end))) \
        .groupBy("Metric", "Date").agg(F.sum("Value").alias("Value"))
    return grid.join(vals, ["Metric", "Date"], "left").select(
        "GroupName", "MeasureName", "SortOrder", "GroupSortOrder", "Date",
        F.coalesce(F.col("Value"), F.lit(0)).cast("bigint").alias("_DynamicMeasure"))


# ---- productivity measures (M66-M90) and the productivity table (P37) ------------------------------------

# Measure names per dimension, with their definition kind and source column.
PRODUCTIVITY = {
    "Users": [
        ("Total Logged Time per User", "sum_dec", "TotalLoggedMinutes"),
        ("Average Handle Time/Presentation per User", "aht", None),
        ("Orders Completed per User", "sum", "OrdersCompleted"),
        ("Bin Presentations Completed per User", "sum", "BinPresentationsCompleted"),
        ("Lines Completed per User", "sum", "LinesCompleted"),
        ("Units Completed per User", "sum", "UnitsCompleted"),
        ("Orders/HR per User", "rate", "OrdersCompleted"),
        ("Bins/HR per User", "rate", "BinPresentationsCompleted"),
        ("Units/HR per User", "rate", "UnitsCompleted"),
        ("Lines/HR per User", "rate", "LinesCompleted"),
        ("Machine wait time per User", "sum_dec", "MachineWaitMinutes"),
    ],
    "Ports": [
        ("Total Logged Time per Port", "sum_dec", "TotalLoggedMinutes"),
        ("Average Handle Time/Presentation per Port", "aht", None),
        ("Bin Presentations Completed per Port", "sum", "BinPresentationsCompleted"),
        ("Bins/HR per Port", "rate", "BinPresentationsCompleted"),
        ("Lines Completed per Port", "sum", "LinesCompleted"),
        ("Lines/HR per Port", "rate", "LinesCompleted"),
        ("Machine wait time per Port", "sum_dec", "MachineWaitMinutes"),
        ("Orders Completed per Port", "sum", "OrdersCompleted"),
        ("Orders/HR per Port", "rate", "OrdersCompleted"),
        ("Units Completed per Port", "sum", "UnitsCompleted"),
        ("Units/HR per Port", "rate", "UnitsCompleted"),
    ],
}

COUNT_COLS = ["OrdersCompleted", "BinPresentationsCompleted", "LinesCompleted", "UnitsCompleted"]
_UNIT_COLS = ["TotalLoggedMinutes", "ActiveHandleMinutes", "MachineWaitMinutes", "RateDenominatorHours"]


def _pick_sums(daily: DataFrame, keys) -> DataFrame:
    d = daily.filter(F.col("WorkType") == "Pick")
    aggs = [F.sum(c).cast("bigint").alias(c) for c in COUNT_COLS] + \
           [F.sum((F.col(c) * 10000).cast("bigint")).alias(f"{c}_u") for c in _UNIT_COLS]
    return d.groupBy(*keys).agg(*aggs) if keys else d.agg(*aggs)


def _activity(cols_present=True) -> Column:
    """M66 Productivity Pick Activity > 0, in 1e-4 units (exact)."""
    counts = sum((F.coalesce(F.col(c), F.lit(0)) * 10000 for c in COUNT_COLS), F.lit(0))
    units = sum((F.coalesce(F.col(f"{c}_u"), F.lit(0)) for c in _UNIT_COLS), F.lit(0))
    return counts + units


def _productivity_value(kind: str, src) -> Column:
    if kind == "sum":
        v = F.col(src).cast("bigint")
    elif kind == "sum_dec":
        v = F.col(f"{src}_u") / F.lit(10000)
    elif kind == "aht":
        b = F.col("BinPresentationsCompleted")
        v = F.when(b != 0, F.col("ActiveHandleMinutes_u") / (b * F.lit(10000)))
    else:
        h = F.col("RateDenominatorHours_u")
        v = F.when(h != 0, F.col(src) * F.lit(10000) / h)
    return F.when(_activity() > 0, v)


def productivity_activity(daily: DataFrame) -> DataFrame:
    """M66 over the whole model (no slicers)."""
    s = _pick_sums(daily, [])
    return s.select((_activity() / F.lit(10000)).alias("Productivity Pick Activity"))


def _dim_rows(daily: DataFrame, dim: str) -> DataFrame:
    """Rows reachable from the distinct user / port dimension."""
    excluded = ["Unattributed"] if dim == "Users" else ["No Data", "Unattributed"]
    return daily.filter(F.col(dim).isNotNull() & ~F.col(dim).isin(excluded))


def productivity_measure(daily: DataFrame, name: str, dim: str, start=None, end=None) -> DataFrame:
    """One productivity measure per user or port (blank rows dropped)."""
    spec = {n: (k, s) for n, k, s in PRODUCTIVITY[dim]}[name]
    d = _window(_dim_rows(daily, dim), start, end)
    s = _pick_sums(d, [dim])
    return s.select(dim, _productivity_value(*spec).alias(name)).filter(F.col(f"`{name}`").isNotNull())


def _window(daily: DataFrame, start, end) -> DataFrame:
    if start is not None:
        daily = daily.filter(F.col("EventDate") >= F.lit(start))
    if end is not None:
        daily = daily.filter(F.col("EventDate") <= F.lit(end))
    return daily


def productivity_table(daily: DataFrame, dim: str, start=None, end=None) -> DataFrame:
    """The productivity table by user or port over a date window: the 11
    measures as columns; rows where every measure is blank are dropped."""
    d = _window(_dim_rows(daily, dim), start, end)
    s = _pick_sums(d, [dim])
    cols = [_productivity_value(k, src).alias(n) for n, k, src in PRODUCTIVITY[dim]]
    out = s.select(dim, *cols)
    any_value = None
    for n, _, _ in PRODUCTIVITY[dim]:
        c = F.col(f"`{n}`").isNotNull()
        any_value = c if any_value is None else (any_value | c)
    return out.filter(any_value)


def older_helper_sums(rollup_users: DataFrame, rollup_ports: DataFrame) -> DataFrame:
    """The older model's 22 measures, SUM(view[value]) + 0 over each
    P01-P22 helper view (rates are summed, not re-divided), computed as one
    aggregate per roll-up.  Summed rates are floating-point sums whose last
    bit depends on order; they are rounded to 1e-9."""
    out = []
    for dim, roll in (("Users", rollup_users), ("Ports", rollup_ports)):
        aggs = []
        for name, vdim, _, src, kind in P.HELPER_VIEWS:
            if vdim != dim:
                continue
            v = F.coalesce(F.sum(P._helper_value(src, kind)), F.lit(0))
            if kind in ("rate", "float"):
                v = F.round(v.cast("double"), 9)
            aggs.append(v.alias(name))
        out.append(roll.filter(F.col("WorkType") == "Pick").agg(*aggs))
    return beside(out[0], out[1])


def older_port_sort(c: Column) -> Column:
    """M95: 'No Data' -> 'P-1', then the number after the first character."""
    t = F.replace(c, F.lit("No Data"), F.lit("P-1"))
    return F.substring(t, 2, 1 << 20).try_cast("double")


def measure(fn: Callable, m, by: Sequence[str] = (), where: dict[str, Column | str] | None = None, both: Sequence[tuple[str, str]] = (),
            treatas: Sequence[Edge] = (), **options) -> DataFrame:
    """Evaluate a measure function under filters, per value of ``by`` (see
    ``relations.Slice``)."""
    return fn(Slice(m, by, where, both, treatas), **options)


class Model:
    """The semantic model's tables: the input catalogue plus the derived report
    tables the measures read (daily grain, throughput, compartment barcodes)."""

    by: Sequence[str] = ()

    def all(self):
        return self

    def __init__(self, tables, daily: Callable[[], DataFrame], throughput: Callable[[], DataFrame]):
        self._t = tables
        self._daily, self._throughput = daily, throughput

    @cached_property
    def daily(self) -> DataFrame:
        return self._daily()

    @cached_property
    def throughput(self) -> DataFrame:
        return self._throughput()

    def __getattr__(self, name):
        return getattr(self._t, name)

    @property
    def calendar(self) -> DataFrame:
        """The dates of the order lines, which a slicer filters."""
        d = self._t.fulfillment_lines.select(F.to_date("LastUpdatedDate").alias("Date")).dropna().distinct()
        return d.select("Date", F.year("Date").alias("Year"), F.month("Date").alias("Month"))

    @property
    def compartment_barcodes(self) -> DataFrame:
        """One barcode per (container, compartment position) of the latest
        container snapshot: a join on the template key (fan-out bounded by the
        compartments of one template)."""
        from opsgrain.sources.staging import latest_snapshot
        c = latest_snapshot(self._t.containers).select(F.col("PrimaryKey").alias("ContainerPrimaryKey"), "TemplatePrimaryKey")
        k = self._t.template_compartments.select("TemplatePrimaryKey", "ContainerSide", "XPosition", "YPosition")
        return c.join(broadcast_if_small(k), "TemplatePrimaryKey").select(
            "ContainerPrimaryKey", "ContainerSide", "XPosition", "YPosition",
            F.concat_ws("-", F.col("ContainerPrimaryKey").cast("string"), F.col("XPosition").cast("string"),
                        F.col("YPosition").cast("string")).alias("Barcode"))


def test_customer_orders_picked(m) -> DataFrame:
    """Completed fulfillment orders whose LastUpdatedDate and
    LastUpdatedDateInventory fall on the same day (BLANK formats as '')."""
    fo = m.fulfillment_orders
    if "LastUpdatedDateInventory" not in fo.columns:
        fo = fo.withColumn("LastUpdatedDateInventory", F.lit(None).cast("timestamp"))
    f = fo.filter((F.lower("Status") == "completed") & _same_day_text("LastUpdatedDate", "LastUpdatedDateInventory"))
    return _scalar(m, f, F.count(F.lit(1)), "test Customer Orders Picked")


def older_cycle_count_open(m) -> DataFrame:
    """The older model's DistinctTaskGroupCount and CycleCountOpenTasks:
    cycle-count rows joined to open tasks on the task key and the same
    LastUpdatedDate day (the model's cross join + filter is this equi-join)."""
    tasks = m.inventory_tasks.filter(F.col("IsClosed") == F.lit(False))
    reached(m, tasks, m.tasks_cyclecount)
    key = [F.to_date("LastUpdatedDate").alias("_d")]
    t = tasks.select(F.col("PrimaryKey").alias("InventoryTaskPrimaryKey"), F.col("TaskGroupPrimaryKey").alias("_group"), *key, *(c for c in _slices(m, tasks) if c != "InventoryTaskPrimaryKey"))
    cc = m.tasks_cyclecount.select("InventoryTaskPrimaryKey", *key, *(c for c in _slices(m, m.tasks_cyclecount) if c != "InventoryTaskPrimaryKey"))
    both = [c for c in m.by if c in t.columns and c in cc.columns and c != "InventoryTaskPrimaryKey"]  # a slice's counts meet that slice's tasks
    same = [cc[c].eqNullSafe(t[c]) for c in both]
    j = cc.join(t, [*(cc[c] == t[c] for c in ("InventoryTaskPrimaryKey", "_d")), *same]).drop(t["InventoryTaskPrimaryKey"], t["_d"], *(t[c] for c in both))
    return _agg(m, j, F.count_distinct("_group").alias("DistinctTaskGroupCount (Orders)"),
                F.count(F.lit(1)).alias("CycleCountOpenTasks (Lines)"))


def test_customer_order_lines(m) -> DataFrame:
    """Fulfillment order lines whose LastUpdatedDate and
    LastUpdatedDateInventory fall on the same day.  The model's filter on
    FulfillmentOrders does not reach the lines: no relationship joins the two
    tables, so only the lines' own date condition applies."""
    li = m.fulfillment_lines
    if "LastUpdatedDateInventory" not in li.columns:
        li = li.withColumn("LastUpdatedDateInventory", F.lit(None).cast("timestamp"))
    return _scalar(m, li.filter(_same_day_text("LastUpdatedDate", "LastUpdatedDateInventory")), F.count(F.lit(1)),
                   "test Customer Order Lines")
