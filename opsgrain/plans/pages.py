"""Report-facing views (P01-P40) over the daily grain, the event stream and
the snapshot tables.

Scalar "latest snapshot" filters are equi-joins against a one-row aggregate
(``Snapshot_Id = max``), which Spark plans as a broadcast hash join and can
use for dynamic partition pruning when snapshots are stored partitioned.
Small label-level totals use an unpartitioned window over a table whose size
is bounded by the number of labels (a dimension), never by the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain.functions.frames import broadcast_if_small
from opsgrain.functions.tsql import hour_label, nullif_blank, trimmed, weeknum_sunday
from opsgrain.operators.temporal import nearest_after
from opsgrain.sources.staging import latest_snapshot

# ---- helper views P01-P22 -------------------------------------------------------------

# Fixed values: (view name, dimension, output column, source column, kind).
# kind: int/bigint count, rate (SESSION denominator only, float), float, minutes (rounded bigint).
HELPER_VIEWS = [
    ("OrdersCompletedPerUser", "Users", "OrdersCompleted", "OrdersCompleted", "count"),
    ("OrdersCompletedPerPort", "Ports", "OrdersCompleted", "OrdersCompleted", "count"),
    ("BinPresentationsCompletedPerUser", "Users", "BinPresentationsCompleted", "BinPresentationsCompleted", "count"),
    ("BinPresentationsCompletedPerPort", "Ports", "BinPresentationsCompleted", "BinPresentationsCompleted", "count"),
    ("LinesCompletedPerUser", "Users", "LinesCompleted", "LinesCompleted", "count"),
    ("LinesCompletedPerPort", "Ports", "LinesCompleted", "LinesCompleted", "count"),
    ("UnitsCompletedPerUser", "Users", "UnitsCompleted", "UnitsCompleted", "count"),
    ("UnitsCompletedPerPort", "Ports", "UnitsCompleted", "UnitsCompleted", "count"),
    ("OrdersPerHourPerUser", "Users", "OrdersPerHourPerUser", "OrdersPerHour", "rate"),
    ("OrdersPerHourPerPort", "Ports", "OrdersPerHourPerPort", "OrdersPerHour", "rate"),
    ("BinsPerHourPerUser", "Users", "BinsPerHour", "BinsPerHour", "rate"),
    ("BinsPerHourPerPort", "Ports", "BinsPerHour", "BinsPerHour", "rate"),
    ("LinesperHourPerUser", "Users", "LinesPerHour", "LinesPerHour", "rate"),
    ("LinesperHourPerPort", "Ports", "LinesPerHour", "LinesPerHour", "rate"),
    ("UnitsPerHourPerUser", "Users", "UnitsPerHour", "UnitsPerHour", "rate"),
    ("UnitsPerHourPerPort", "Ports", "UnitsPerHour", "UnitsPerHour", "rate"),
    ("AverageHandlingTimePerUser", "Users", "AverageHandlingTime", "AverageHandleTimePerPresentationMinutes", "float"),
    ("AverageHandlingTimePerPort", "Ports", "AverageHandlingTime", "AverageHandleTimePerPresentationMinutes", "float"),
    ("MachineWaitTimePerUser", "Users", "MachineWaitTime", "MachineWaitMinutes", "minutes"),
    ("MachineWaitTimePerPort", "Ports", "MachineWaitTime", "MachineWaitMinutes", "minutes"),
    ("TotalLoggedTimePerUser", "Users", "TotalLoggedTime", "TotalLoggedMinutes", "minutes"),
    ("TotalLoggedTimePerPort", "Ports", "TotalLoggedTime", "TotalLoggedMinutes", "minutes"),
]


def _helper_value(src: str, kind: str) -> Column:
    if kind == "count":
        return F.col(src).cast("int" if src != "UnitsCompleted" else "bigint")
    if kind == "rate":
        return F.when(F.col("RateDenominatorSource") == "SESSION", F.col(src)).cast("double")
    if kind == "float":
        return F.col(src).cast("double")
    return F.round(F.col(src), 0).cast("bigint")


def _helper_key(dim: str) -> Column:
    key = F.col(dim)
    if dim == "Ports":
        key = F.when(key == "Unattributed", "No Data").otherwise(key)
    return key.alias(dim)


def helper_columns(rollup: DataFrame, dim: str) -> DataFrame:
    """All helper views of one dimension as columns of one projection
    (Old<value> names as in the old-vs-new comparison)."""
    from opsgrain.plans.rollups import COMPARE_OLD
    suffix = "User" if dim == "Users" else "Port"
    spec = {v[0]: v for v in HELPER_VIEWS}
    cols = []
    for stem, _, out in COMPARE_OLD:
        _, _, _, src, kind = spec[f"{stem}Per{suffix}"]
        cols.append(_helper_value(src, kind).alias(out))
    return rollup.filter(F.col("WorkType") == "Pick").select(_helper_key(dim), *cols)


def helper_view(rollup: DataFrame, name: str) -> DataFrame:
    """One report helper view over R05 (users) or R06 (ports),
    Pick work only; ports relabel 'Unattributed' to 'No Data'; rates only when
    the denominator is SESSION; minutes rounded to whole numbers."""
    spec = {v[0]: v for v in HELPER_VIEWS}[name]
    _, dim, out, src, kind = spec
    return rollup.filter(F.col("WorkType") == "Pick").select(_helper_key(dim), _helper_value(src, kind).alias(out))


# ---- daily KPI views P23-P25 -----------------------------------------------------------

HISTORICAL = {  # view -> (daily column, output column)
    "OrdersCompletedHD": ("OrdersCompleted", "OrdersCompleted"),
    "LinesCompletedHD": ("LinesCompleted", "LinesCompleted"),
    "UnitsPickedHD": ("UnitsCompleted", "UnitsPicked"),
    "BinPresentedHD": ("BinPresentationsCompleted", "BinPresented"),
    "Customer_Orders_Picked": ("OrdersCompleted", "Customer Orders Picked"),
    "Customer_Order_Lines": ("LinesCompleted", "Customer Order Lines"),
    "Units_Picked": ("UnitsCompleted", "Units Picked"),
}


def historical(daily: DataFrame, view: str) -> DataFrame:
    """Pick totals per event date from the daily grain."""
    src, out = HISTORICAL[view]
    return (
        daily.filter(F.col("WorkType") == "Pick")
        .groupBy(F.col("EventDate").alias("Date"))
        .agg(F.sum(src).cast("bigint").alias(out))
    )


def completed_pick_date(pick: DataFrame) -> Column:
    return F.to_date(F.coalesce(F.col("PickCompleteDate"), F.col("TimeStamp")))


def distinct_skus_picked(pick: DataFrame) -> DataFrame:
    """P25: distinct SKUs of completed pick lines with a user, per completion date."""
    act = F.coalesce(F.col("ActualPickQuantity"), F.lit(0))
    req = F.coalesce(F.col("RequiredPickQuantity"), F.lit(0))
    p = pick.filter(
        F.col("Sku").isNotNull() & F.col("UserName").isNotNull()
        & F.coalesce(F.col("PickCompleteDate"), F.col("TimeStamp")).isNotNull() & (act >= req)
    )
    # distinct (date, sku) first: the shuffle carries each pair once
    return (
        p.select(completed_pick_date(p).alias("Date"), "Sku").dropDuplicates()
        .groupBy("Date").agg(F.count(F.lit(1)).alias("Distinct Skus Picked"))
    )


# ---- on-hand inventory P26-P27 -----------------------------------------------------------

def on_hand_rows(inventory: DataFrame, containers: DataFrame) -> DataFrame:
    """Latest inventory snapshot rows in a container of the same snapshot,
    not Pending, container not Outside, quantity > 0."""
    inv = latest_snapshot(inventory)
    c = containers.select(
        F.col("PrimaryKey").alias("ContainerPrimaryKey"), F.col("Snapshot_Id"),
        F.col("Status").alias("_c_status"),
    )
    return (
        inv.join(c, on=["ContainerPrimaryKey", "Snapshot_Id"], how="inner")
        .filter((F.coalesce(F.col("Status"), F.lit("")) != "Pending")
                & (F.coalesce(F.col("_c_status"), F.lit("")) != "Outside")
                & (F.coalesce(F.col("Quantity"), F.lit(0)) > 0))
        .drop("_c_status")
    )


def location_key(prefix: str = "") -> Column:
    """(container, x, y) as one value; counts like the text key
    CONCAT(container,'|',x,'|',y) because the parts are numeric."""
    return F.struct(F.col(f"{prefix}ContainerPrimaryKey"), F.col(f"{prefix}ContainerX"), F.col(f"{prefix}ContainerY"))


def on_hand(inventory: DataFrame, containers: DataFrame, units_of_measure: DataFrame, metric: str,
            as_of: dt.date | None = None) -> DataFrame:
    """Current-state inventory KPIs, one row dated ``as_of``."""
    as_of = as_of or dt.date.today()
    rows = on_hand_rows(inventory, containers)
    if metric == "Total SKUs On Hand":
        uom = units_of_measure.select(F.col("PrimaryKey").alias("UnitOfMeasurePrimaryKey"), "Snapshot_Id",
                                      F.col("ProductPrimaryKey"))
        rows = rows.join(uom, on=["UnitOfMeasurePrimaryKey", "Snapshot_Id"], how="left")
        value = F.count_distinct(F.coalesce(F.col("ProductPrimaryKey"), F.col("UnitOfMeasurePrimaryKey")))
    elif metric == "Total Units On Hand":
        value = F.sum(F.coalesce(F.col("Quantity"), F.lit(0)))
    elif metric in ("Total Locations Occupied", "Distinct bin compartments that had inventory"):
        value = F.count_distinct(location_key())
    elif metric == "Distinct bins inventory added":
        value = F.count_distinct(F.col("ContainerPrimaryKey"))
    else:
        raise ValueError(metric)
    return rows.agg(value.cast("bigint").alias(metric)).select(F.lit(as_of).alias("Date"), metric)


ON_HAND_METRICS = ["Total SKUs On Hand", "Total Units On Hand", "Total Locations Occupied",
                   "Distinct bins inventory added", "Distinct bin compartments that had inventory"]


def on_hand_all(inventory: DataFrame, containers: DataFrame, units_of_measure: DataFrame,
                as_of: dt.date | None = None) -> DataFrame:
    """P26 + P27 in one pass: the five on-hand KPIs from a single join and a
    single aggregate, in long form (Metric, Date, Value)."""
    as_of = as_of or dt.date.today()
    uom = units_of_measure.select(F.col("PrimaryKey").alias("UnitOfMeasurePrimaryKey"), "Snapshot_Id",
                                  F.col("ProductPrimaryKey"))
    rows = on_hand_rows(inventory, containers).join(uom, on=["UnitOfMeasurePrimaryKey", "Snapshot_Id"], how="left")
    a = rows.agg(
        F.count_distinct(F.coalesce(F.col("ProductPrimaryKey"), F.col("UnitOfMeasurePrimaryKey"))).cast("bigint").alias("m0"),
        F.sum(F.coalesce(F.col("Quantity"), F.lit(0))).cast("bigint").alias("m1"),
        F.count_distinct(location_key()).cast("bigint").alias("m2"),
        F.count_distinct(F.col("ContainerPrimaryKey")).cast("bigint").alias("m3"),
    )
    vals = [F.col("m0"), F.col("m1"), F.col("m2"), F.col("m3"), F.col("m2")]
    arr = F.array(*[F.struct(F.lit(n).alias("Metric"), v.alias("Value")) for n, v in zip(ON_HAND_METRICS, vals)])
    return a.select(F.explode(arr).alias("k")).select("k.Metric", F.lit(as_of).alias("Date"), "k.Value")


# ---- inbound P28 ---------------------------------------------------------------------------

def _closed_containers(pac: DataFrame) -> DataFrame:
    return pac.filter((F.col("Status") == "Closed") & F.col("LastUpdatedDateInventory").isNotNull()).select(
        F.col("PrimaryKey").alias("PutAwayContainerPrimaryKey"),
        F.to_date("LastUpdatedDateInventory").alias("Date"),
    )


def putaway(metric: str, pac: DataFrame, lines: DataFrame | None = None, uom: DataFrame | None = None,
            tasks_putaway: DataFrame | None = None, tasks: DataFrame | None = None,
            actions: DataFrame | None = None) -> DataFrame:
    """Inbound dailies by business date (LastUpdatedDateInventory).

    As in the source, only the units-of-measure join is snapshot-matched;
    the other joins see every snapshot of their tables."""
    c = _closed_containers(pac)
    if metric == "Orders Putaway":
        return c.groupBy("Date").agg(F.count_distinct("PutAwayContainerPrimaryKey").cast("bigint").alias(metric))
    if metric in ("Units Putaway", "Skus Putaway"):
        li = lines.filter(F.coalesce(F.col("ActualQuantity"), F.lit(0)) > 0)
        if metric == "Units Putaway":  # summed by container before the shuffle
            held = li.groupBy("PutAwayContainerPrimaryKey").agg(F.sum("ActualQuantity").alias("_units"))
            return c.join(held, "PutAwayContainerPrimaryKey").groupBy("Date").agg(F.sum("_units").cast("bigint").alias(metric))
        j = c.join(li, on="PutAwayContainerPrimaryKey", how="inner")
        u = uom.select(F.col("PrimaryKey").alias("UnitOfMeasurePrimaryKey"), "Snapshot_Id", "ProductPrimaryKey")
        j = j.join(u, on=["UnitOfMeasurePrimaryKey", "Snapshot_Id"], how="left")
        sku = F.coalesce(F.col("ProductPrimaryKey"), F.col("UnitOfMeasurePrimaryKey"))
        return j.select("Date", sku.alias("_sku")).dropDuplicates().groupBy("Date") \
            .agg(F.count("_sku").cast("bigint").alias(metric))
    if metric == "Presentations Putaway":
        itp = tasks_putaway.select("PutAwayContainerPrimaryKey", "InventoryTaskPrimaryKey", "LocationPrimaryKey")
        it = tasks.select(F.col("PrimaryKey").alias("InventoryTaskPrimaryKey"))
        ita = actions.select("InventoryTaskPrimaryKey", "NewContainerPrimaryKey")
        j = c.join(itp, on="PutAwayContainerPrimaryKey").join(it, on="InventoryTaskPrimaryKey") \
            .join(ita, on="InventoryTaskPrimaryKey")
        key = F.struct(F.col("PutAwayContainerPrimaryKey"), F.coalesce(F.col("LocationPrimaryKey"), F.lit(-1)),
                       F.coalesce(F.col("NewContainerPrimaryKey"), F.lit(-1)))
        return j.select("Date", key.alias("_k")).dropDuplicates().groupBy("Date") \
            .agg(F.count(F.lit(1)).cast("bigint").alias(metric))
    raise ValueError(metric)


# ---- throughput P29 / P36 --------------------------------------------------------------------

def port_label(c: Column) -> Column:
    t = trimmed(c)
    return F.when(nullif_blank(c).isNull() | (t == "No Data"), "Unattributed").otherwise(t)


def category_label(c: Column) -> Column:
    t = trimmed(c)
    return F.when(nullif_blank(c).isNull() | F.upper(t).isin("NO VALUE", "UNKNOWN"), "Uncategorized").otherwise(t)


def throughput(ev: DataFrame, pick: DataFrame) -> DataFrame:
    """Pick orders / lines / bins per date × hour label × port × order category.

    Category lookups: orders take the first pick of the transport order and
    lines the first pick of the pick key (both pre-aggregated with ``min_by``
    to one row per key before the join); bins take the nearest later pick of
    the container (E01).  Dates come from StartTime."""
    e = ev.filter((F.col("WorkType") == "Pick") & F.col("StartTime").isNotNull())
    first_by_order = pick.groupBy(F.col("TransportOrderPrimaryKey").alias("FulfillmentOrderPrimaryKey")).agg(
        F.min_by("OrderCategory", F.struct("TimeStamp", "PrimaryKey")).alias("_cat"))
    first_by_line = pick.groupBy(F.col("PickPrimaryKey").alias("FulfillmentOrderLinePrimaryKey")).agg(
        F.min_by("OrderCategory", F.col("PrimaryKey")).alias("_cat"))
    orders = e.filter(F.col("EventType") == "ORDER_COMPLETED").join(first_by_order, "FulfillmentOrderPrimaryKey", "left") \
        .select("StartTime", "Port", "_cat", F.col("OrderCompletedCount").alias("o"), F.lit(0).alias("l"), F.lit(0).alias("b"))
    lines = e.filter(F.col("EventType") == "LINE_COMPLETED").join(first_by_line, "FulfillmentOrderLinePrimaryKey", "left") \
        .select("StartTime", "Port", "_cat", F.lit(0).alias("o"), F.col("LineCompletedCount").alias("l"), F.lit(0).alias("b"))
    bins_ev = e.filter(F.col("EventType") == "BIN_PRESENTATION").select("StartTime", "Port", "ContainerBarcode", "BinPresentationCount")
    picks = pick.select("ContainerBarcode", "TimeStamp", "PrimaryKey", "OrderCategory")
    bins = nearest_after(bins_ev, picks, ["ContainerBarcode"], "StartTime", "TimeStamp", ["PrimaryKey"], ["OrderCategory"], "_m") \
        .select("StartTime", "Port", F.col("_m.OrderCategory").alias("_cat"), F.lit(0).alias("o"), F.lit(0).alias("l"),
                F.col("BinPresentationCount").alias("b"))
    u = orders.unionByName(lines).unionByName(bins)
    return u.groupBy(
        F.to_date("StartTime").alias("Date"), hour_label(F.col("StartTime")).alias("Hour"),
        port_label(F.col("Port")).alias("Ports"), category_label(F.col("_cat")).alias("OrderCategory"),
    ).agg(
        F.sum("o").cast("bigint").alias("OrdersCompleted"),
        F.sum("l").cast("bigint").alias("LinesCompleted"),
        F.sum("b").cast("bigint").alias("BinPresentationsCompleted"),
    ).select("Date", "Hour", "Ports", "OrdersCompleted", "LinesCompleted", "OrderCategory", "BinPresentationsCompleted")


THROUGHPUT_METRICS = {"Orders": "OrdersCompleted", "Lines": "LinesCompleted", "Bins": "BinPresentationsCompleted"}


def throughput_chart(t: DataFrame, metric: str, series: str = "Ports") -> DataFrame:
    """The hour chart for one metric by port or category; the display
    filter drops only 'No Data' / 'Unknown' labels."""
    col = THROUGHPUT_METRICS[metric] if metric in THROUGHPUT_METRICS else metric
    if metric == "All":
        val = F.col("OrdersCompleted") + F.col("LinesCompleted") + F.col("BinPresentationsCompleted")
    else:
        val = F.col(col)
    return (
        t.filter(~F.col(series).isin("No Data", "Unknown"))
        .groupBy("Hour", series)
        .agg(F.sum(val).cast("bigint").alias("KPI_Selected"))
    )


# ---- inventory & location matrix P30-P31 ---------------------------------------------------------

# The 18 metric names of the matrix, in display order (MetricSort 1..18).
MATRIX_METRICS = [
    "Total Bin(s) w/ Inventory", "Total Bin(s) w/ No Inventory", "Total Bin(s)",
    "% of Bin(s) w/ Inventory", "% of Bin(s) w/ No Inventory", "% of Total Bin(s)",
    "Total Locations Occupied", "Total Locations Empty", "Total Locations",
    "% Locations Occupied", "% Locations Empty", "Distinct SKUs Stocked", "Units Stocked",
    "% Units Stocked", "Avg Units Stocked Per Location", "Avg Units Stocked per Bin(s)",
    "Avg Units Stocked per SKU", "Avg Locations Stocked per SKU",
]


def fmt_int(c: Column) -> Column:
    """FORMAT(n, 'N0') for an integer."""
    return F.format_number(c.cast("bigint"), 0)


def fmt_cents(cents: Column) -> Column:
    """FORMAT(x, 'N2') given x as an exact integer count of hundredths (>= 0)."""
    c = cents.cast("bigint")
    whole = (c - c % 100) / 100
    return F.concat(F.format_number(whole.cast("bigint"), 0), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def ratio_cents(num: str, den: str, scale: int = 100) -> Column:
    """round_half_up(num * scale / den, 2) as hundredths in exact integer
    arithmetic (SQL expressions over non-negative counts); 0 when den = 0."""
    return F.expr(
        f"CASE WHEN ({den}) = 0 OR ({den}) IS NULL THEN 0 "
        f"ELSE (CAST({num} AS BIGINT) * {2 * scale * 100} + ({den})) div (2 * ({den})) END")


def template_compartment_labels(templates: DataFrame, compartments: DataFrame, sizes: DataFrame) -> DataFrame:
    """Goods-to-person template compartments with the label
    'size (template without the "Autostore " prefix)'."""
    ct = latest_snapshot(templates).filter(F.col("IsGoodsToPerson") & (F.nullif(F.col("TemplateName"), F.lit("")).isNotNull()))
    cs = latest_snapshot(sizes).filter(F.nullif(F.col("Name"), F.lit("")).isNotNull())
    tail = F.nullif(trimmed(F.replace(F.col("TemplateName"), F.lit("Autostore "), F.lit(""))), F.lit(""))
    label = F.concat_ws("", F.col("Name"), F.lit(" ("), tail, F.lit(")"))
    return (
        ct.select(F.col("PrimaryKey").alias("TemplatePrimaryKey"), "TemplateName")
        .join(compartments.select("TemplatePrimaryKey", "ContainerSide", "XPosition", "YPosition",
                                  F.col("CompartmentSizePrimaryKey").alias("_size")), "TemplatePrimaryKey")
        .join(cs.select(F.col("PrimaryKey").alias("_size"), "Name"), "_size")
        .select("TemplatePrimaryKey", "TemplateName", F.col("Name").alias("CompartmentName"),
                "ContainerSide", "XPosition", "YPosition", label.alias("CompartmentLabel"))
        .dropDuplicates()
    )


def inventory_location_metrics(inventory: DataFrame, containers: DataFrame, templates: DataFrame,
                               compartments: DataFrame, sizes: DataFrame, uom: DataFrame) -> DataFrame:
    """Per compartment label: the numeric inputs of the P30 matrix (wide).

    Capacity is arithmetic: containers per template times the label's positions
    in that template, so no container is multiplied by its compartments.  Stock
    is one pass over inventory, reduced to one row per (label, position, SKU);
    all stock figures are counts over that grain."""
    kinds = template_compartment_labels(templates, compartments, sizes)
    boxes = latest_snapshot(containers).filter(F.coalesce(F.col("Status"), F.lit("")) != "Outside") \
        .select(F.col("PrimaryKey").alias("ContainerPrimaryKey"), "TemplatePrimaryKey")
    spots = kinds.groupBy("CompartmentLabel", "TemplatePrimaryKey").agg(F.count(F.lit(1)).alias("_spots"))
    per_template = boxes.groupBy("TemplatePrimaryKey").agg(F.count_distinct("ContainerPrimaryKey").alias("_boxes"))
    capacity = spots.join(per_template, "TemplatePrimaryKey", "left").groupBy("CompartmentLabel").agg(
        F.coalesce(F.sum("_boxes"), F.lit(0)).alias("TotalBins"),
        F.coalesce(F.sum(F.col("_boxes") * F.col("_spots")), F.lit(0)).alias("TotalLocations"))
    place = ["TemplatePrimaryKey", "ContainerSide", "XPosition", "YPosition"]
    stocked = latest_snapshot(inventory).filter((F.coalesce(F.col("Status"), F.lit("")) != "Pending") & (F.col("Quantity") > 0)).select(
        "ContainerPrimaryKey", "ContainerSide", F.col("ContainerX").alias("XPosition"), F.col("ContainerY").alias("YPosition"),
        "UnitOfMeasurePrimaryKey", "Quantity")
    units = latest_snapshot(uom).select(F.col("PrimaryKey").alias("UnitOfMeasurePrimaryKey"), "ProductPrimaryKey", "BaseMultiple")
    grain = (
        stocked.join(boxes, "ContainerPrimaryKey")
        .join(broadcast_if_small(kinds.select("CompartmentLabel", *place)), place)
        .join(units, "UnitOfMeasurePrimaryKey", "left")
        .groupBy("CompartmentLabel", "ContainerPrimaryKey", *place[1:],
                 F.coalesce("ProductPrimaryKey", "UnitOfMeasurePrimaryKey").alias("SkuKey"))
        .agg(F.sum(F.col("Quantity") * F.coalesce(F.nullif(F.col("BaseMultiple"), F.lit(0)), F.lit(1))).alias("Units"))
    )
    stock = grain.groupBy("CompartmentLabel").agg(
        F.count_distinct("ContainerPrimaryKey").alias("BinsWithStock"),
        F.count_distinct(F.struct("ContainerPrimaryKey", *place[1:])).alias("LocationsOccupied"),
        F.count_distinct("SkuKey").alias("DistinctSkusStocked"),
        F.sum("Units").alias("UnitsStocked"),
        F.count("SkuKey").alias("_loc_sum"),  # the grain has each SKU once a position
    ).withColumn("_sku_n", F.col("DistinctSkusStocked"))
    base = capacity.join(stock, "CompartmentLabel", "left").na.fill(0)
    everything = Window.partitionBy()  # a row per label, bounded by templates x sizes; a sub-query would scan inventory again
    return base.select("*", F.sum("UnitsStocked").over(everything).alias("AllUnitsStocked"),
                       F.sum("TotalBins").over(everything).alias("AllDisplayedBins"))


def inventory_location_summary(inventory: DataFrame, containers: DataFrame, templates: DataFrame,
                               compartments: DataFrame, sizes: DataFrame, uom: DataFrame) -> DataFrame:
    """Long-form matrix (CompartmentLabel, MetricName, MetricValue), 18
    formatted metrics per label, as the truncate-and-insert procedure writes it."""
    b = inventory_location_metrics(inventory, containers, templates, compartments, sizes, uom)
    bins, stock, locs, occ = F.col("TotalBins"), F.col("BinsWithStock"), F.col("TotalLocations"), F.col("LocationsOccupied")
    empty_bins = F.when(bins > stock, bins - stock).otherwise(0)
    empty_locs = F.when(locs > occ, locs - occ).otherwise(0)
    pct = lambda n, d: F.concat(fmt_cents(ratio_cents(n, d, 100)), F.lit("%"))
    avg = lambda n, d: fmt_cents(ratio_cents(n, d, 1))
    values = [
        fmt_int(stock), fmt_int(empty_bins), fmt_int(bins),
        pct("BinsWithStock", "TotalBins"), pct("TotalBins - BinsWithStock", "TotalBins"),
        pct("TotalBins", "AllDisplayedBins"),
        fmt_int(occ), fmt_int(empty_locs), fmt_int(locs),
        pct("LocationsOccupied", "TotalLocations"), pct("TotalLocations - LocationsOccupied", "TotalLocations"),
        fmt_int(F.col("DistinctSkusStocked")), fmt_cents(F.col("UnitsStocked") * 100),
        pct("UnitsStocked", "AllUnitsStocked"), avg("UnitsStocked", "TotalLocations"),
        avg("UnitsStocked", "TotalBins"), avg("UnitsStocked", "DistinctSkusStocked"),
        avg("_loc_sum", "_sku_n"),
    ]
    pairs = F.array(*[F.struct(F.lit(n).alias("MetricName"), v.alias("MetricValue")) for n, v in zip(MATRIX_METRICS, values)])
    return b.select("CompartmentLabel", F.explode(pairs).alias("_m")).select(
        "CompartmentLabel", "_m.MetricName", "_m.MetricValue")


def metric_sort(df: DataFrame, col: str = "MetricName") -> DataFrame:
    """Display order 1-18 of the matrix metrics, else 99999."""
    expr = F.lit(99999)
    for i, name in reversed(list(enumerate(MATRIX_METRICS, start=1))):
        expr = F.when(F.col(col) == name, F.lit(i)).otherwise(expr)
    return df.withColumn("MetricSort", expr)


# ---- consolidation P32 ------------------------------------------------------------------------------

# The 13 columns of the consolidation table and their types.
CONSOLIDATION_COLUMNS = [
    ("Sku", "string"), ("UnitOfMeasurePrimaryKey", "int"), ("CompartmentSizeName", "string"), ("Quantity", "int"),
    ("TotalCompartments", "int"), ("TotalUnrealizedCapacity", "int"), ("PercentFragmentation", "decimal(30,11)"),
    ("AverageUnrealizedCapacity", "decimal(29,11)"), ("StandardDeviationUnrealizedCapacity", "double"),
    ("CompartmentSizeCapacity", "int"), ("IdealizedCompartmentUsage", "int"), ("IdealizedUnrealizedCapacity", "int"),
    ("IdealizedPercentFragmentation", "int"),
]


def consolidation(src: DataFrame) -> DataFrame:
    """The consolidation copy: 13 typed columns; columns the source
    lacks come through as NULL.  Write with ``mode('overwrite')``."""
    cols = set(src.columns)
    return src.select(*[(F.col(c) if c in cols else F.lit(None)).cast(t).alias(c) for c, t in CONSOLIDATION_COLUMNS])


# ---- open work P33-P34 -----------------------------------------------------------------------------

# Open statuses (compared lower-case).
OPEN_ORDER_STATUSES = ["allocated", "allocating", "active", "batched", "new", "released", "importing",
                       "falied allocation", "failed allocation", "shorted"]
OPEN_LINE_STATUSES = ["active", "allocated", "allocating", "new", "pending"]
OPEN_WORK_SERIES = ["Orders Pick", "Lines Pick", "Orders Put", "Lines Put", "Orders Cycle Count", "Lines Cycle Count"]


def open_work_rows(fo: DataFrame, fol: DataFrame, pac: DataFrame, pacli: DataFrame, tasks: DataFrame,
                   tasks_cc: DataFrame) -> DataFrame:
    """Open-work items of the six series as (MetricName, LastUpdatedDate, ItemKey);
    'Orders Cycle Count' items are task groups (counted distinct)."""
    o = fo.filter(F.lower("Status").isin(OPEN_ORDER_STATUSES)).select(
        F.lit("Orders Pick").alias("MetricName"), "LastUpdatedDate", F.col("PrimaryKey").alias("ItemKey"))
    li = fol.filter(F.lower("Status").isin(OPEN_LINE_STATUSES)).select(
        F.lit("Lines Pick").alias("MetricName"), "LastUpdatedDate", F.col("PrimaryKey").alias("ItemKey"))
    open_c = pac.filter(~F.col("IsClosed"))
    put_o = open_c.select(F.lit("Orders Put").alias("MetricName"), "LastUpdatedDate", F.col("PrimaryKey").alias("ItemKey"))
    put_l = (
        pacli.join(open_c.select(F.col("PrimaryKey").alias("PutAwayContainerPrimaryKey")), "PutAwayContainerPrimaryKey")
        .filter(F.coalesce(F.col("ActualQuantity"), F.lit(0)) + F.coalesce(F.col("MissingQuantity"), F.lit(0))
                < F.coalesce(F.col("Quantity"), F.lit(0)))
        .select(F.lit("Lines Put").alias("MetricName"), "LastUpdatedDate", F.col("PrimaryKey").alias("ItemKey"))
    )
    t = tasks.filter(~F.col("IsClosed")).select(F.col("PrimaryKey").alias("InventoryTaskPrimaryKey"),
                                                "TaskGroupPrimaryKey", F.col("LastUpdatedDate").alias("_tdate"))
    cc = tasks_cc.select("InventoryTaskPrimaryKey").join(t, "InventoryTaskPrimaryKey")
    series = [F.struct(F.lit(name).alias("MetricName"), F.col(key).alias("ItemKey"))
              for name, key in (("Orders Cycle Count", "TaskGroupPrimaryKey"), ("Lines Cycle Count", "InventoryTaskPrimaryKey"))]
    counted = cc.select(F.col("_tdate").alias("LastUpdatedDate"), F.explode(F.array(*series)).alias("_s"))  # both from one join
    counted = counted.select("_s.MetricName", "LastUpdatedDate", "_s.ItemKey")
    return o.unionByName(li).unionByName(put_o).unionByName(put_l).unionByName(counted)


def _open_items() -> Column:
    """Items of a series; only those of cycle-count orders are compared, so that
    the keys of other series are not shuffled."""
    orders = F.col("MetricName") == "Orders Cycle Count"
    return F.when(orders, F.count_distinct(F.when(orders, F.col("ItemKey")))).otherwise(F.count(F.lit(1))).cast("bigint")


def open_work(rows: DataFrame) -> DataFrame:
    """Open work per series: rows (distinct task groups for cycle-count
    orders) and the LastUpdatedDate range."""
    d = F.to_date("LastUpdatedDate")
    return rows.groupBy("MetricName").agg(_open_items().alias("SourceRows"), F.min(d).alias("MinDate"), F.max(d).alias("MaxDate"))


def open_work_trend(rows: DataFrame) -> DataFrame:
    """Open work per series and calendar date of LastUpdatedDate."""
    d = F.to_date("LastUpdatedDate")
    return rows.groupBy("MetricName", d.alias("Date")).agg(_open_items().alias("OpenWork"))


# ---- calendar, date hierarchy, dimensions P38-P40 --------------------------------------------------

def calendar(spark, start: dt.date = dt.date(2024, 1, 1), as_of: dt.date | None = None) -> DataFrame:
    """One row per day from ``start`` to ``as_of`` with the report's
    calendar attributes (Sunday-based week numbers)."""
    as_of = as_of or dt.date.today()
    d = F.col("Date")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(as_of))).alias("Date"))
    wk = weeknum_sunday(d)
    return days.select(
        d,
        F.dayofmonth(d).alias("day"),
        wk.alias("week"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.date_format(d, "yyyy/MM").alias("yearMonth"),
        F.quarter(d).alias("quarter"),
        F.concat(F.year(d).cast("string"), F.lit("/Q"), F.quarter(d).cast("string")).alias("yearQuarter"),
        F.concat(F.date_format(d, "yyyy"), F.lit("/Week"), wk.cast("string")).alias("yearweek"),
        F.when(F.year(d) == F.year(F.lit(as_of)), 1).otherwise(0).alias("yearNow"),
        F.when(F.year(d) == F.year(F.lit(as_of)), F.lit("Current year")).otherwise(F.year(d).cast("string")).alias("years"),
        F.when(d > F.lit(as_of), F.lit("1")).otherwise(F.lit("0")).alias("upcoming"),
        d.alias("DateOnly"),
    )


def date_hierarchy(df: DataFrame, col: str) -> DataFrame:
    """Auto date table spanning the full years of ``col``: Date, Year,
    MonthNo, Month, QuarterNo, Quarter, Day."""
    bounds = df.agg(F.min(F.year(col)).alias("y0"), F.max(F.year(col)).alias("y1"))
    days = bounds.select(F.explode(F.sequence(F.make_date("y0", F.lit(1), F.lit(1)),
                                              F.make_date("y1", F.lit(12), F.lit(31)))).alias("Date"))
    d = F.col("Date")
    q = F.floor((F.month(d) + 2) / 3).cast("int")
    return days.select(
        d, F.year(d).alias("Year"), F.month(d).alias("MonthNo"), F.date_format(d, "MMMM").alias("Month"),
        q.alias("QuarterNo"), F.concat(F.lit("Qtr "), q.cast("string")).alias("Quarter"), F.dayofmonth(d).alias("Day"),
    )


def dim_users(daily: DataFrame) -> DataFrame:
    """Distinct users of the daily grain without blanks or 'Unattributed'."""
    return daily.select("Users").distinct().filter(F.col("Users").isNotNull() & (F.col("Users") != "Unattributed"))


def port_sort(c: Column) -> Column:
    """S08 (model form): remove every 'P', parse a number, else 999999."""
    v = F.regexp_replace(c, "P", "").try_cast("double")
    return F.coalesce(v, F.lit(999999.0))


def dim_ports(daily: DataFrame) -> DataFrame:
    """Distinct ports without blanks, 'No Data' or 'Unattributed', with SortOrder."""
    p = daily.select("Ports").distinct().filter(
        F.col("Ports").isNotNull() & ~F.col("Ports").isin("No Data", "Unattributed"))
    return p.select("Ports", port_sort(F.col("Ports")).alias("SortOrder"))
