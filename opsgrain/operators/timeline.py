"""The matchers of the work-event grain over typed events.

``typed(catalogue, *kinds)`` gives events of several kinds as one table with
one set of typed columns, from one scan where the catalogue has a typed staging
table.  Each builder here takes such rows and does all its matching on as few
partitionings as its keys allow: rows are dealt out once by (key, hour), and
finer windows reuse that partitioning with a sort.  What a row needs from later
hours comes as one extra row per (key, hour), from a table bounded by keys and
hours, so no result is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain.operators.temporal import DEFAULT_BUCKET_SECONDS, _bucket

#: Kinds of typed events and the catalogue's tables of them.
TABLES = {"SignIn": "sign_in", "SignOut": "sign_out", "BinPresented": "bin_presented", "OpenBin": "open_bin", "CloseBin": "close_bin", "Pick": "pick", "Order": "order_rows"}

COLUMNS = {
    "PrimaryKey": "bigint", "TimeStamp": "timestamp", "WorkType": "string", "LocationPrimaryKey": "bigint", "LocationBarcode": "string", "ContainerBarcode": "string",
    "UserName": "string", "LocationTaskType": "string", "BinActionTime": "string", "PickPrimaryKey": "bigint", "TransportOrderPrimaryKey": "bigint", "OrderNumber": "string",
    "PickCompleteDate": "timestamp", "ActualPickQuantity": "bigint", "RequiredPickQuantity": "bigint", "OrderPrimaryKey": "bigint", "CompletedDate": "timestamp", "Port": "string",
    "OrderLineCount": "bigint", "EachUnitCount": "bigint",
}


def typed(t, *kinds: str) -> DataFrame:
    """``Kind`` and the typed columns of some kinds of events."""
    if hasattr(t, "typed"):
        return t.typed(*kinds)
    out = None
    for kind in kinds:
        df = getattr(t, TABLES[kind])
        part = df.select(F.lit(kind).alias("Kind"), *((F.col(c) if c in df.columns else F.lit(None)).cast(ty).alias(c) for c, ty in COLUMNS.items()))
        out = part if out is None else out.unionAll(part)
    return out


def _is(kind: str) -> Column:
    return F.col("Kind") == kind


def barcode_of_location(seen: DataFrame) -> DataFrame:
    """The most frequent barcode per location (ties: last seen, then the
    smaller text), from two aggregates and no window."""
    n = seen.where("LocationPrimaryKey is not null and LocationBarcode is not null").groupBy("LocationPrimaryKey", "LocationBarcode").agg(
        F.count(F.lit(1)).alias("n"), F.max("TimeStamp").alias("last"))
    rank = F.struct(-F.col("n"), F.coalesce(-F.unix_micros("last"), F.lit((1 << 63) - 1)), "LocationBarcode")
    return n.groupBy("LocationPrimaryKey").agg(F.min_by("LocationBarcode", rank).alias("LocationBarcode"))


def paired_sessions(signs: DataFrame, *more: str) -> DataFrame:
    """The n-th sign-in with the n-th sign-out of a (work type, location,
    user, day), kept if later.  Both sides are numbered in one window, and the
    grouping by number needs no further partitioning.  ``more`` columns of both
    sides come along, with ``SignIn`` and ``SignOut`` before their names."""
    keys = ["WorkType", "LocationPrimaryKey", "UserName", "SessionDate"]
    rows = signs.where("TimeStamp is not null").withColumn("SessionDate", F.to_date("TimeStamp")).dropna(subset=keys)
    so_far = Window.partitionBy(*keys).orderBy("TimeStamp", "PrimaryKey", "Kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.when(_is("SignIn"), F.count(F.when(_is("SignIn"), 1)).over(so_far)).otherwise(F.count(F.when(_is("SignOut"), 1)).over(so_far))
    at = F.struct("TimeStamp", "PrimaryKey", *more)
    pairs = rows.withColumn("n", number).groupBy(*keys, "n").agg(F.max(F.when(_is("SignIn"), at)).alias("i"), F.max(F.when(_is("SignOut"), at)).alias("o"))
    return pairs.where("o.TimeStamp > i.TimeStamp").select(
        *keys, F.col("i.PrimaryKey").alias("SignInPrimaryKey"), F.col("o.PrimaryKey").alias("SignOutPrimaryKey"), F.col("i.TimeStamp").alias("SignInTime"), F.col("o.TimeStamp").alias("SignOutTime"),
        *(F.col(f"{side}.{c}").alias(f"{name}{c}") for side, name in (("i", "SignIn"), ("o", "SignOut")) for c in more))


def with_session_user(bins: DataFrame, sessions: DataFrame, any_task_type: bool = False, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``bins`` with ``session_user`` of the session at the location that
    contains the row (latest sign-in, ties by the smaller key), of the bin's
    task type where it has one (unless ``any_task_type``).  ``sessions`` come from ``paired_sessions``,
    whose ends rise with their starts for one (work type, user), so the last
    one started before a bin is the only one of that stream that can hold it."""
    rank = F.struct(F.col("SignInTime").alias("s"), (-F.col("SignInPrimaryKey")).alias("k"))
    held = sessions.groupBy("WorkType", "LocationPrimaryKey", "UserName", "SessionDate", "SignInTime").agg(
        F.collect_list(F.struct(rank.alias("r"), F.col("SignOutTime").alias("e"), F.col("UserName").alias("u"))).alias("_iv"), F.max("SignOutTime").alias("_end"))
    stream = F.struct(F.col("WorkType").alias("w"), F.col("UserName").alias("u"))
    spans = held.select("LocationPrimaryKey", F.col("SignInTime").alias("_at"), F.lit(0).alias("_o"), stream.alias("_st"), "_iv",
                        F.explode(F.sequence(_bucket(F.col("SignInTime"), bucket_seconds), _bucket(F.col("_end"), bucket_seconds))).alias("_b"))
    points = bins.select("LocationPrimaryKey", F.col("TimeStamp").alias("_at"), F.lit(1).alias("_o"), _bucket(F.col("TimeStamp"), bucket_seconds).alias("_b"),
                         F.struct(*bins.columns).alias("_row"))
    both = points.unionByName(spans, allowMissingColumns=True)
    there = F.collect_set("_st").over(Window.partitionBy("LocationPrimaryKey", "_b"))
    kind = F.col("_row.LocationTaskType")
    own = F.when(F.col("_o") == 0, F.array("_st")).otherwise(F.filter(there, lambda s: F.lit(any_task_type) | kind.isNull() | (s["w"] == kind)))
    streams = both.withColumn("_own", own).drop("_st").withColumn("_st", F.explode_outer("_own")).drop("_own")
    last = F.last("_iv", ignorenulls=True).over(
        Window.partitionBy("LocationPrimaryKey", "_b", "_st").orderBy("_at", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = streams.withColumn("_last", last).where("_o = 1").withColumn("_hit", F.array_max(F.filter("_last", lambda x: x["e"] >= F.col("_at"))))
    best = found.groupBy("LocationPrimaryKey", "_b", F.col("_row.PrimaryKey").alias("_pk")).agg(F.max("_hit").alias("_hit"), F.first("_row").alias("_row"))
    return best.select("_row.*", F.col("_hit.u").alias("session_user"))


def with_later_events(bins: DataFrame, later: DataFrame, keys: DataFrame, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``bins`` with ``pick_user`` (of the first pick of the
    container by someone, at or after the row) and ``CloseTime`` (the first
    closing of the container at the same location, or with either location
    unknown).  ``later`` are the picks and closings, ``keys`` the bins', picks'
    and closings' typed rows, from which the rows for later hours come."""
    mark = F.struct(F.col("TimeStamp").alias("ts"), F.col("PrimaryKey").alias("k"), F.col("UserName").alias("u"))
    pick = F.when(_is("Pick") & F.col("UserName").isNotNull(), mark)
    close = F.when(_is("CloseBin"), F.struct(F.col("TimeStamp").alias("ts"), F.col("PrimaryKey").alias("k")))
    place = ["ContainerBarcode", "LocationPrimaryKey"]

    def ready(df: DataFrame) -> DataFrame:
        return df.where("ContainerBarcode is not null and TimeStamp is not null").withColumn("_b", _bucket(F.col("TimeStamp"), bucket_seconds))

    # first events of each (container, location, hour), then of the next hours that have some
    firsts = ready(keys).groupBy(*place, "_b").agg(F.min(pick).alias("p"), F.min(close).alias("c")).repartition("ContainerBarcode")
    hour = Window.partitionBy("ContainerBarcode", "_b")
    firsts = firsts.select(*place, "_b", "c", F.min("p").over(hour).alias("p"), F.min(F.when(F.col("LocationPrimaryKey").isNull(), F.col("c"))).over(hour).alias("w"), F.min("c").over(hour).alias("a"))
    next_hours = Window.partitionBy("ContainerBarcode").orderBy(F.col("_b").desc()).rangeBetween(Window.unboundedPreceding, -1)
    there = Window.partitionBy(*place).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = firsts.select(
        *place, "_b", F.lit(2).alias("_o"), *(F.last(x, ignorenulls=True).over(next_hours).alias(f"_{x}") for x in ("p", "w", "a")),
        F.when(F.col("LocationPrimaryKey").isNotNull(), F.last("c", ignorenulls=True).over(there)).alias("_c"))
    known = F.col("LocationPrimaryKey").isNotNull()
    rights = ready(later).select(*place, "_b", F.lit(1).alias("_o"), F.col("TimeStamp").alias("_at"), pick.alias("_p"), F.when(~known, close).alias("_w"), close.alias("_a"), F.when(known, close).alias("_c"))
    lefts = bins.select(*place, _bucket(F.col("TimeStamp"), bucket_seconds).alias("_b"), F.lit(0).alias("_o"), F.col("TimeStamp").alias("_at"), F.struct(*bins.columns).alias("_row"))
    every = lefts.unionByName(rights, allowMissingColumns=True).unionByName(carry, allowMissingColumns=True)
    order = [(F.col("_o") == 2).desc(), F.col("_at").desc(), F.col("_o").desc(), *(F.col(f"_{x}").desc() for x in "pwac")]

    def running(name: str, *by: str) -> Column:
        w = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last(name, ignorenulls=True).over(w)

    every = every.select("*", *(running(f"_{x}", "ContainerBarcode").alias(x) for x in "pwa")).select("*", running("_c", *place).alias("c")).where("_o = 0")
    closed = F.when(F.col("LocationPrimaryKey").isNull(), F.col("a")).otherwise(F.least("c", "w"))
    return every.select("_row.*", F.col("p.u").alias("pick_user"), closed["ts"].alias("CloseTime"))


def orders_with_pick_flag(rows: DataFrame) -> DataFrame:
    """E17's NOT EXISTS: completed orders with ``has_pick``, whether some pick
    shares the order key or the order number.  ``rows`` are orders and picks;
    picks are reduced to their distinct keys before they meet the orders."""
    order = F.when(_is("Order"), F.struct("PrimaryKey", "UserName", "Port", "CompletedDate", "OrderLineCount", "EachUnitCount"))
    keys = [F.when(_is("Order"), F.col("OrderPrimaryKey")).otherwise(F.col("TransportOrderPrimaryKey")).alias("OrderPrimaryKey"), "OrderNumber"]
    some = rows.where(_is("Pick") | F.col("CompletedDate").isNotNull()).select(*keys, order.alias("o")).groupBy("OrderPrimaryKey", "OrderNumber", "o").agg(F.count(F.lit(1)).alias("n"))

    def shared(c: str) -> Column:
        # rows without the key have a group of their own
        alone = F.concat(F.lit("~"), F.coalesce(F.col("o.PrimaryKey").cast("string"), F.xxhash64("OrderPrimaryKey", "OrderNumber").cast("string")))
        key = F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), alone)
        return F.col(c).isNotNull() & F.max(F.col("o").isNull()).over(Window.partitionBy(key))

    some = some.withColumn("_k", shared("OrderPrimaryKey")).withColumn("has_pick", F.col("_k") | shared("OrderNumber")).where("o is not null")
    return some.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("OrderPrimaryKey", "OrderNumber", "o.*", "has_pick")
