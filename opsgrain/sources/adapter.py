"""Reference-shaped input tables derived from the driver's synthetic tables.

Each method returns one input table of the reporting layer (FIXTURES.md §2)
as a lazy DataFrame over the parquet files.  Every source row is used: where a
source table plays two roles, a deterministic rule on its id splits it (clicks
with an even id are close-bin events, odd ones open-bin events), and special
cases are values (an older snapshot, a missing date), never missing rows.
Snapshot copies and source copies are produced with ``explode`` over a
literal array, which is a bounded per-row fan-out and not a join.

Column pruning reaches the scan: each table selects only the columns it uses.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.operators.timeline import COLUMNS
from opsgrain.session import ensure_small_tasks, ensure_utc
from opsgrain.sources.staging import inventory_records


def _s(c: Column) -> Column:
    return c.cast("string")


def _ifnull_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


#: Days that bring the latest order and ship dates of the test data to the end of its event period.
ORDER_SHIFT, SHIP_SHIFT = 8217, 8122


def _ordered(c: str = "o_orderdate") -> Column:
    return F.col(c).cast("timestamp") + F.expr(f"INTERVAL {ORDER_SHIFT} DAYS")


def _shipped(c: str = "l_shipdate") -> Column:
    return F.col(c).cast("timestamp") + F.expr(f"INTERVAL {SHIP_SHIFT} DAYS")


def _later(c: Column, cond: Column) -> Column:
    """A day later where ``cond`` holds."""
    return F.when(cond, c + F.expr("INTERVAL 1 DAYS")).otherwise(c)


class Tables:
    """Lazy catalogue of the reporting inputs for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_utc(spark)
        ensure_small_tasks(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- telemetry-shaped tables ------------------------------------------------
    @cached_property
    def ev(self) -> DataFrame:
        e = self.raw("events").select("event_id", "ts", "user_id", "event_type", "value")
        uid = F.col("user_id")
        wt_idx = F.floor(uid / 10).cast("bigint") % 4
        return e.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            "user_id",
            "event_type",
            "value",
            F.concat(F.lit("u"), _s(uid % 10)).alias("usr"),
            (uid % 5 + 1).alias("loc"),
            F.concat(F.lit("P"), _s(uid % 5 + 1)).alias("port"),
            F.concat(F.lit("C"), _s(uid % 25)).alias("bin"),
            F.when(wt_idx == 0, "Pick").when(wt_idx == 1, "PutAway").when(wt_idx == 2, "CycleCount")
            .otherwise("OnDemand").alias("wt"),
        )

    def _events_of(self, *types: str) -> DataFrame:
        return self.ev.filter(F.col("event_type").isin(*types))

    @staticmethod
    def _kinds() -> dict[str, tuple[str, Column, dict[str, Column]]]:
        """Event type, condition and columns of each kind of typed events."""
        eid, at, every = F.col("event_id"), F.col("ts"), F.lit(True)
        to = F.floor(eid / 7).cast("bigint")
        m6 = eid % 6
        secs = F.lpad(_s(F.floor(F.col("value")).cast("bigint") % 60), 2, "0")
        key = {"PrimaryKey": eid, "TimeStamp": at}
        return {
            "SignIn": ("signup", every, {
                "WorkType": F.col("wt"), **key, "LocationPrimaryKey": F.col("loc"), "UserName": _ifnull_when(eid % 23 == 0, F.col("usr"))}),
            "SignOut": ("error", every, {
                "WorkType": F.col("wt"), **key, "LocationPrimaryKey": F.col("loc"), "UserName": F.col("usr")}),
            "BinPresented": ("view", every, {
                **key, "LocationPrimaryKey": _ifnull_when(eid % 17 == 0, F.col("loc")), "LocationBarcode": F.col("port"), "ContainerBarcode": F.col("bin"),
                "LocationTaskType": F.when(eid % 19 == 0, F.lit(None).cast("string")).when(eid % 29 == 0, F.lit("")).otherwise(F.col("wt")),
                "BinActionTime": F.when(eid % 11 == 0, F.lit("n/a")).otherwise(F.concat(F.lit("00:00:"), secs, F.lit(".500")))}),
            "CloseBin": ("click", eid % 2 == 0, {
                **key, "LocationPrimaryKey": _ifnull_when(eid % 17 == 1, F.col("loc")), "LocationBarcode": F.col("port"), "ContainerBarcode": F.col("bin")}),
            "OpenBin": ("click", eid % 2 == 1, {
                **key, "LocationPrimaryKey": F.col("loc"),
                "LocationBarcode": F.when(eid % 5 == 0, F.concat(F.col("port"), F.lit("X"))).otherwise(F.col("port")), "ContainerBarcode": F.col("bin")}),
            "Pick": ("purchase", every, {
                **key, "PickPrimaryKey": eid, "PercentOfOrderLine": _ifnull_when(eid % 10 == 0, F.lit(100).cast("bigint")),
                "TransportOrderPrimaryKey": to, "LocationBarcode": F.col("port"), "ContainerBarcode": F.col("bin"),
                "OrderNumber": F.concat(F.lit("SO"), _s(to)),
                "OrderCategory": F.when(m6 == 0, F.lit(None).cast("string")).when(m6 == 1, "NO VALUE").when(m6 == 2, "Unknown")
                .when(m6 == 3, " Retail ").when(m6 == 4, "Web").otherwise("B2B"),
                "PickCompleteDate": _ifnull_when(eid % 9 == 0, at + F.expr("INTERVAL 90 SECONDS")), "Sku": F.concat(F.lit("SKU"), _s(eid % 40)),
                "ActualPickQuantity": F.floor(F.col("value")).cast("bigint") % 10, "RequiredPickQuantity": eid % 6,
                "UserName": _ifnull_when(eid % 13 == 0, F.col("usr"))}),
            "Order": ("signup", every, {
                **key, "OrderPrimaryKey": to, "OrderNumber": F.concat(F.lit("SO"), _s(to)), "CompletedDate": _ifnull_when(eid % 8 == 0, at),
                "UserName": F.col("usr"), "Port": F.col("port"), "OrderLineCount": eid % 4 + 1, "EachUnitCount": eid % 9}),
        }

    def _of_kind(self, kind: str) -> DataFrame:
        event_type, condition, columns = self._kinds()[kind]
        return self._events_of(event_type).filter(condition).select(*(c.alias(name) for name, c in columns.items()))

    def typed(self, *kinds: str) -> DataFrame:
        """``Kind`` and the typed columns of some kinds of events, by one scan
        (an event can be of two kinds)."""
        own = {k: v for k, v in self._kinds().items() if k in kinds}
        rows = self._events_of(*sorted({v[0] for v in own.values()}))
        of = F.array_compact(F.array(*(F.when((F.col("event_type") == event_type) & condition, k) for k, (event_type, condition, _) in own.items())))
        rows = rows.withColumn("Kind", F.explode(of))

        def column(name: str, kind: str) -> Column:
            out = None
            for k, (_, _, columns) in own.items():
                if name in columns:
                    out = (F if out is None else out).when(F.col("Kind") == k, columns[name])
            return (F.lit(None) if out is None else out).cast(kind).alias(name)

        return rows.select("Kind", *(column(name, kind) for name, kind in COLUMNS.items()))

    @cached_property
    def sign_in(self) -> DataFrame:
        return self._of_kind("SignIn")

    @cached_property
    def sign_out(self) -> DataFrame:
        return self._of_kind("SignOut")

    @cached_property
    def bin_presented(self) -> DataFrame:
        return self._of_kind("BinPresented")

    @cached_property
    def close_bin(self) -> DataFrame:
        return self._of_kind("CloseBin")

    @cached_property
    def open_bin(self) -> DataFrame:
        return self._of_kind("OpenBin")

    @cached_property
    def pick(self) -> DataFrame:
        return self._of_kind("Pick")

    @cached_property
    def order_rows(self) -> DataFrame:
        return self._of_kind("Order")

    @cached_property
    def put_away(self) -> DataFrame:
        eid = F.col("event_id")
        return self._events_of("purchase").filter("wt = 'PutAway'").select(
            eid.alias("PrimaryKey"), F.col("ts").alias("TimeStamp"), F.col("usr").alias("UserName"),
            _ifnull_when(eid % 4 == 0, F.floor(eid / 8).cast("bigint")).alias("InventoryTaskGroupPrimaryKey"),
            _ifnull_when(eid % 7 == 0, F.floor(eid / 3).cast("bigint")).alias("PutAwayContainerPrimaryKey"),
            F.when(eid % 5 == 0, eid % 3).alias("ReasonCodePrimaryKey"))

    @cached_property
    def cycle_counts(self) -> DataFrame:
        eid = F.col("event_id")
        return self._events_of("purchase").filter("wt = 'CycleCount'").select(
            eid.alias("PrimaryKey"), F.col("ts").alias("TimeStamp"), F.col("usr").alias("UserName"),
            _ifnull_when(eid % 6 == 0, F.floor(eid / 7).cast("bigint")).alias("TransportOrderPrimaryKey"),
            _ifnull_when(eid % 11 == 0, F.col("port")).alias("LocationBarcode"),
            F.when(eid % 5 == 0, eid % 3).alias("ReasonCodePrimaryKey"))

    @cached_property
    def close_bin_payloads(self) -> DataFrame:
        """Close-bin telemetry with the bin's inventory records as a nested
        array: none to three of them, or no array at all."""
        eid = F.col("event_id")
        n = (eid % 4).cast("int")
        record = lambda i: F.struct(
            F.when((eid + i) % 3 == 0, "Pending").when((eid + i) % 3 == 1, "Available").alias("InventoryStatus"),
            F.when((eid + i) % 7 != 0, (F.floor(F.col("value")).cast("bigint") + i) % 5).alias("ProductQuantity"))
        records = F.when(n == 0, F.array().cast("array<struct<InventoryStatus:string,ProductQuantity:bigint>>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), record))
        return self._events_of("click").filter(eid % 2 == 0).select(
            eid.alias("PrimaryKey"), F.col("ts").alias("TimeStamp"),
            F.to_json(F.struct(F.col("bin").alias("ContainerBarcode"), F.when(eid % 9 != 0, records).alias("InventoryRecords"))).alias("JsonData"))

    @cached_property
    def close_bin_records(self) -> DataFrame:
        return inventory_records(self.close_bin_payloads)

    @cached_property
    def status_history(self) -> DataFrame:
        eid = F.col("event_id")
        return self._events_of("signup", "error").select(
            eid.alias("PrimaryKey"),
            F.floor(eid / 14).cast("bigint").alias("FulfillmentOrderPrimaryKey"),
            F.col("usr").alias("UserName"),
            F.col("ts").alias("StatusDate"),
            F.when(eid % 3 == 0, "Released").otherwise("Completed").alias("Status"),
        )

    @cached_property
    def metric_sources(self) -> DataFrame:
        eid = F.col("event_id")
        copies = F.filter(F.array(*[F.lit(i) for i in (1, 2, 3, 4)]), lambda s: (s == 1) | (eid % s == 0))
        e = self.ev.withColumn("sid", F.explode(copies))
        js = F.concat(
            F.lit('{"User":"'), F.col("usr"), F.lit('","LocationPrimaryKey":"'), _s(F.col("loc")),
            F.lit('","LocationBarcode":"'), F.col("port"), F.lit('","ContainerBarcode":"'), F.col("bin"),
            F.lit('","Quantity":"'), _s(F.floor(F.col("value")).cast("bigint")), F.lit('"}'),
        )
        kind, wt = F.col("event_type"), F.col("wt")
        description = (
            F.when(kind == "signup", F.concat(wt, F.lit("-SignIn"))).when(kind == "error", F.concat(wt, F.lit("-SignOut")))
            .when(kind == "view", "BinPresented").when((kind == "click") & (eid % 2 == 0), "CloseBin").when(kind == "click", "OpenBin")
            .when(wt == "PutAway", "PutAway").when(wt == "CycleCount", "CycleCountService").when(wt == "OnDemand", "Order").otherwise("Pick")
        )
        return e.select(
            F.col("sid").alias("SourcePriority"),
            F.concat(F.lit("db"), _s(F.col("sid"))).alias("SourceDatabase"),
            F.lit("ReportedMetrics").alias("SourceTable"),
            (eid + F.col("sid")).alias("SourcePrimaryKey"),
            description.alias("DataDescription"),
            F.col("ts").alias("EventTimestamp"),
            js.alias("JsonData"),
        )

    def reported_metrics(self, priority: int) -> DataFrame:
        """One raw telemetry source table (PrimaryKey, DataDescription, JsonData, TimeStamp)."""
        return self.metric_sources.filter(F.col("SourcePriority") == priority).select(
            F.col("SourcePrimaryKey").alias("PrimaryKey"), "DataDescription", "JsonData",
            F.col("EventTimestamp").alias("TimeStamp"))

    @cached_property
    def report_data(self) -> DataFrame:
        """Report_Data: the live source's rows as loaded by the sync, one batch
        per 500-key range (the sync appends by primary-key range)."""
        return self.metric_sources.filter(F.col("SourcePriority") == 1).select(
            F.col("SourcePrimaryKey").alias("PrimaryKey"), "DataDescription",
            F.col("EventTimestamp").alias("TimeStamp"),
            F.floor(F.col("SourcePrimaryKey") / 500).cast("bigint").alias("BatchId"))

    # ---- snapshot / master-data tables -----------------------------------------
    @staticmethod
    def _snapshots(df: DataFrame, key: Column) -> DataFrame:
        """Snapshot 2 holds every row, snapshot 1 the rows with an even key."""
        ids = F.filter(F.array(F.lit(1), F.lit(2)), lambda s: (s == 2) | (key % 2 == 0))
        return df.withColumn("Snapshot_Id", F.explode(ids))

    @cached_property
    def containers(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        st = F.col("o_orderstatus")
        return self._snapshots(o, F.col("o_orderkey")).select(
            F.col("o_orderkey").alias("PrimaryKey"),
            (F.col("o_custkey") % 6 + 1).alias("TemplatePrimaryKey"),
            F.when(st == "P", "Outside").when(st == "O", "Stored").otherwise(F.lit(None).cast("string")).alias("Status"),
            _ordered().alias("LastUpdatedDate"),
            F.col("Snapshot_Id").cast("int").alias("Snapshot_Id"),
        )

    @cached_property
    def inventory(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", "l_shipdate")
        rf = F.col("l_returnflag")
        ln = F.col("l_linenumber")
        return self._snapshots(li, F.col("l_orderkey")).select(
            (F.col("l_orderkey") * 10 + ln).alias("PrimaryKey"),
            F.col("l_partkey").alias("UnitOfMeasurePrimaryKey"),
            F.col("l_orderkey").alias("ContainerPrimaryKey"),
            F.when(rf == "R", "Pending").when(rf == "A", "Available").otherwise(F.lit(None).cast("string")).alias("Status"),
            F.lit(0).alias("ContainerSide"),
            ((ln - 1) % 4).alias("ContainerX"),
            F.floor((ln - 1) / 4).cast("bigint").alias("ContainerY"),
            F.when(F.col("l_partkey") % 12 == 0, F.lit(0).cast("bigint")).otherwise(F.col("l_quantity").cast("bigint")).alias("Quantity"),
            _shipped().alias("LastUpdatedDate"),
            F.col("Snapshot_Id").cast("int").alias("Snapshot_Id"),
        )

    @cached_property
    def units_of_measure(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_size")
        return p.select(
            F.col("p_partkey").alias("PrimaryKey"),
            (F.col("p_partkey") % 500).alias("ProductPrimaryKey"),
            (F.col("p_size") % 4).alias("BaseMultiple"),
            F.when(F.col("p_partkey") % 10 == 9, 1).otherwise(2).alias("Snapshot_Id"),
        )

    @cached_property
    def products(self) -> DataFrame:
        p = self.raw("part").select((F.col("p_partkey") % 500).alias("PrimaryKey")).distinct()
        return p.select("PrimaryKey", F.concat(F.lit("SKU"), _s(F.col("PrimaryKey"))).alias("Sku"))

    @cached_property
    def container_templates(self) -> DataFrame:
        t = self.spark.range(1, 7).select(F.col("id").alias("t"))
        return t.select(
            F.col("t").alias("PrimaryKey"),
            F.when(F.col("t") == 5, F.lit("")).otherwise(F.concat(F.lit("Autostore "), _s(F.col("t")), F.lit("/8"))).alias("TemplateName"),
            (F.col("t") != 6).alias("IsGoodsToPerson"),
            F.lit(2).alias("Snapshot_Id"),
        )

    @cached_property
    def compartment_sizes(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(1, "Small", 2), (2, "Medium", 2), (3, "", 2)],
            "PrimaryKey bigint, Name string, Snapshot_Id int",
        )

    @cached_property
    def template_compartments(self) -> DataFrame:
        # The 7 compartment positions (x, y) of every template.
        positions = [(0, 0), (1, 0), (2, 0), (3, 0), (0, 1), (1, 1), (2, 1)]
        pos = F.array(*[F.struct(F.lit(x).cast("bigint").alias("x"), F.lit(y).cast("bigint").alias("y")) for x, y in positions])
        t = self.spark.range(1, 7).select(F.col("id").alias("t"), F.explode(pos).alias("p"))
        x, y = F.col("p.x"), F.col("p.y")
        return t.select(
            (F.col("t") * 100 + x * 10 + y).alias("PrimaryKey"),
            F.col("t").alias("TemplatePrimaryKey"),
            F.lit(0).cast("bigint").alias("ContainerSide"),
            x.alias("XPosition"),
            y.alias("YPosition"),
            ((F.col("t") + x) % 3 + 1).alias("CompartmentSizePrimaryKey"),
        )

    @cached_property
    def putaway_containers(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        closed = F.col("o_orderstatus") == "F"
        od = _ordered()
        return o.select(
            F.col("o_orderkey").alias("PrimaryKey"),
            F.when(closed, "Closed").otherwise("Open").alias("Status"),
            closed.alias("IsClosed"),
            _ifnull_when(F.col("o_orderkey") % 10 == 0, od).alias("LastUpdatedDateInventory"),
            od.alias("LastUpdatedDate"),
            (od - F.expr("INTERVAL 2 DAYS")).alias("CreatedDate"),
            F.lit(2).alias("Snapshot_Id"),
        )

    def _lines(self, *cols: str) -> DataFrame:
        return self.raw("lineitem").select("l_orderkey", "l_linenumber", *cols)

    @cached_property
    def putaway_lines(self) -> DataFrame:
        li = self._lines("l_partkey", "l_quantity", "l_shipdate")
        ln = F.col("l_linenumber")
        q = F.col("l_quantity").cast("bigint")
        return li.select(
            (F.col("l_orderkey") * 10 + ln).alias("PrimaryKey"),
            F.col("l_orderkey").alias("PutAwayContainerPrimaryKey"),
            F.col("l_partkey").alias("UnitOfMeasurePrimaryKey"),
            q.alias("Quantity"),
            _ifnull_when(ln == 7, q - ln % 3).alias("ActualQuantity"),
            (ln % 2).cast("bigint").alias("MissingQuantity"),
            _shipped().alias("LastUpdatedDate"),
            F.lit(2).alias("Snapshot_Id"),
        )

    @cached_property
    def inventory_tasks(self) -> DataFrame:
        li = self._lines("l_suppkey", "l_linestatus", "l_shipdate")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("PrimaryKey"),
            F.col("l_suppkey").alias("TaskGroupPrimaryKey"),
            (F.col("l_linestatus") == "F").alias("IsClosed"),
            _shipped().alias("LastUpdatedDate"),
            F.lit(2).alias("Snapshot_Id"),
        )

    @cached_property
    def tasks_putaway(self) -> DataFrame:
        li = self._lines("l_suppkey")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("InventoryTaskPrimaryKey"),
            F.col("l_orderkey").alias("PutAwayContainerPrimaryKey"),
            _ifnull_when(F.col("l_linenumber") == 3, F.col("l_suppkey") % 5).alias("LocationPrimaryKey"),
        )

    @cached_property
    def task_actions(self) -> DataFrame:
        li = self._lines("l_partkey")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("InventoryTaskPrimaryKey"),
            _ifnull_when(F.col("l_linenumber") == 4, F.col("l_partkey") % 100).alias("NewContainerPrimaryKey"),
        )

    @cached_property
    def tasks_cyclecount(self) -> DataFrame:
        li = self._lines("l_shipdate")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("InventoryTaskPrimaryKey"),
            F.col("l_orderkey").alias("ContainerPrimaryKey"),
            _shipped().alias("LastUpdatedDate"),
        )

    @cached_property
    def fulfillment_orders(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
        pr = F.col("o_orderpriority")
        return o.select(
            F.col("o_orderkey").alias("PrimaryKey"),
            F.concat(F.lit("SO"), _s(F.col("o_orderkey"))).alias("ExternalOrderNumber"),
            F.when(pr == "1-URGENT", "Active").when(pr == "2-HIGH", "allocated").when(pr == "3-MEDIUM", "Completed")
            .when(pr == "5-LOW", "falied allocation").otherwise("Shorted").alias("Status"),
            _ordered().alias("LastUpdatedDate"),
            _later(_ordered(), F.col("o_orderkey") % 4 == 0).alias("LastUpdatedDateInventory"),
        )

    @cached_property
    def fulfillment_lines(self) -> DataFrame:
        li = self._lines("l_returnflag", "l_shipdate")
        rf = F.col("l_returnflag")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("PrimaryKey"),
            F.col("l_orderkey").alias("FulfillmentOrderPrimaryKey"),
            F.when(rf == "A", "Active").when(rf == "N", "pending").otherwise("Completed").alias("Status"),
            _shipped().alias("LastUpdatedDate"),
            _later(_shipped(), F.col("l_linenumber") % 3 == 0).alias("LastUpdatedDateInventory"),
        )

    @cached_property
    def defrag_detail(self) -> DataFrame:
        li = self._lines("l_partkey", "l_quantity")
        g = li.groupBy((F.col("l_partkey") % 200).alias("u"), (F.col("l_linenumber") % 2).alias("half")).agg(
            F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"), F.sum(60 - F.col("l_quantity")).alias("unreal")
        )
        return g.select(
            F.concat(F.lit("SKU"), _s(F.col("u"))).alias("Sku"),
            F.col("u").alias("UnitOfMeasurePrimaryKey"),
            F.when(F.col("half") == 0, "Small").otherwise("Medium").alias("CompartmentSizeName"),
            F.col("q").cast("bigint").alias("Quantity"),
            F.col("n").alias("TotalCompartments"),
            F.col("unreal").cast("bigint").alias("TotalUnrealizedCapacity"),
            F.lit(60).alias("CompartmentSizeCapacity"),
            (F.col("unreal") * 100 / 4096).cast("double").alias("PercentFragmentation"),
            F.expr("cast(cast(unreal as bigint) div n as double)").alias("AverageUnrealizedCapacity"),
            (F.col("n") / 8).cast("double").alias("StandardDeviationUnrealizedCapacity"),
            F.expr("(cast(q as bigint) + 59) div 60").alias("IdealizedCompartmentUsage"),
            F.expr("((cast(q as bigint) + 59) div 60) * 60 - cast(q as bigint)").alias("IdealizedUnrealizedCapacity"),
            F.expr("100 * (((cast(q as bigint) + 59) div 60) * 60 - cast(q as bigint)) div greatest(((cast(q as bigint) + 59) div 60) * 60, 1)").alias("IdealizedPercentFragmentation"),
        )
