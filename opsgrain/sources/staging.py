"""Staging of raw telemetry and snapshots (S01-S10) and the raw-JSON session
pairing (E06).

De-duplication (S03) is an aggregation, not a window: ``groupBy(content)``
with ``min_by`` keeps the best-priority copy and counts the copies with
map-side partial aggregation, so a record copied into every source (or one
content repeated millions of times) never lands in one task as raw rows.  The
copies are first dealt out by their source key, to tasks of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.functions.frames import spread
from opsgrain.functions.tsql import ms_between, ms_to_seconds
from opsgrain.operators.timeline import paired_sessions

METRIC_COLUMNS = ["SourceDatabase", "SourceTable", "SourcePriority", "SourcePrimaryKey", "DataDescription",
                  "JsonData", "EventTimestamp"]

# The 15 event kinds of the telemetry (description whitelist).
EVENT_DESCRIPTIONS = [
    "Order", "Pick", "Pick-SignIn", "Pick-SignOut", "BinPresented", "CloseBin", "OpenBin", "PutAway",
    "PutAway-SignIn", "PutAway-SignOut", "CycleCountService", "CycleCount-SignIn", "CycleCount-SignOut",
    "OnDemand-SignIn", "OnDemand-SignOut",
]
SIGN_IN_DESCRIPTIONS = ["Pick-SignIn", "PutAway-SignIn", "CycleCount-SignIn", "OnDemand-SignIn"]
SIGN_OUT_DESCRIPTIONS = ["Pick-SignOut", "PutAway-SignOut", "CycleCount-SignOut", "OnDemand-SignOut"]


def metric_sources(sources: Sequence[tuple[str, str, int, DataFrame]]) -> DataFrame:
    """Union of telemetry tables (PrimaryKey, DataDescription, JsonData,
    TimeStamp) tagged with source database, table and priority."""
    out = None
    for db, table, prio, df in sources:
        part = df.select(
            F.lit(db).alias("SourceDatabase"), F.lit(table).alias("SourceTable"), F.lit(prio).cast("int").alias("SourcePriority"),
            F.col("PrimaryKey").cast("bigint").alias("SourcePrimaryKey"), F.col("DataDescription").cast("string"),
            F.col("JsonData").cast("string"), F.col("TimeStamp").alias("EventTimestamp"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def iso126(ts: Column) -> Column:
    """CONVERT(nvarchar, datetime2(7), 126): 'yyyy-MM-ddTHH:mm:ss' plus a
    7-digit fraction unless the fraction is zero."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac, F.lit("0")))


def event_hash(df: DataFrame) -> DataFrame:
    """SHA2-256 (hex) of description | ISO timestamp | JSON, over the
    UTF-16LE bytes of the text, as the source hashes nvarchar values."""
    text = F.concat_ws("", F.col("DataDescription"), F.lit("|"), iso126(F.col("EventTimestamp")), F.lit("|"), F.col("JsonData"))
    return df.withColumn("EventHash", F.sha2(F.encode(text, "UTF-16LE"), 256))


def dedupe_metrics(df: DataFrame) -> DataFrame:
    """One row per (description, timestamp, content hash): the copy with
    the best (priority, database, table, key), plus the number of copies."""
    h = event_hash(spread(df, "SourceDatabase", "SourceTable", "SourcePrimaryKey", "EventTimestamp"))
    order = F.struct("SourcePriority", "SourceDatabase", "SourceTable", "SourcePrimaryKey")
    keep = F.struct(*[c for c in METRIC_COLUMNS if c not in ("DataDescription", "EventTimestamp")])
    g = h.groupBy("DataDescription", "EventTimestamp", "EventHash").agg(
        F.min_by(keep, order).alias("_k"), F.count(F.lit(1)).alias("DuplicateSourceRows"))
    return g.select(
        "_k.SourceDatabase", "_k.SourceTable", "_k.SourcePriority", "_k.SourcePrimaryKey", "DataDescription",
        "_k.JsonData", "EventTimestamp", "EventHash", "DuplicateSourceRows",
    )


def parse_events(df: DataFrame, description: str, schema: T.StructType) -> DataFrame:
    """A typed event table from the JSON payload of one description."""
    p = df.filter(F.col("DataDescription") == description).withColumn("_j", F.from_json("JsonData", schema))
    return p.select(F.col("SourcePrimaryKey").alias("PrimaryKey"), F.col("EventTimestamp").alias("TimeStamp"),
                    *[F.col(f"_j.{f.name}").alias(f.name) for f in schema.fields])


# The payload's fields, and their types.
TELEMETRY_FIELDS = {"User": "string", "LocationPrimaryKey": "bigint", "LocationBarcode": "string", "ContainerBarcode": "string", "Quantity": "bigint"}


def typed_telemetry(deduped: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """S04 for all descriptions at once: each payload is parsed once, to a
    VARIANT, and its fields are taken from that.

    Defined results: a payload that is no JSON, or no JSON object, keeps its
    row, with ``Malformed`` true and all fields null; a missing field, one of
    another type, or a nested value where a scalar is wanted is null; a null
    payload is not malformed."""
    fields = fields or TELEMETRY_FIELDS
    parsed = deduped.withColumn("_v", F.try_parse_json("JsonData"))

    def field(name: str, kind: str) -> Column:
        text = F.try_variant_get("_v", f"$.{name}", "string")
        nested = text.startswith("{") | text.startswith("[")
        return F.when(~nested, text if kind == "string" else F.try_variant_get("_v", f"$.{name}", kind)).alias(name)

    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    return parsed.select(
        "DataDescription", F.col("SourcePrimaryKey").alias("PrimaryKey"), F.col("EventTimestamp").alias("TimeStamp"), "SourceDatabase", "SourceTable",
        *(field(name, kind) for name, kind in fields.items()), (F.col("JsonData").isNotNull() & ~is_object).alias("Malformed"))


def inventory_records(payloads: DataFrame) -> DataFrame:
    """The inventory records nested in close-bin payloads, one row each, with
    their place in the array.  A payload without the array, with an empty one
    or malformed has no records; a null record is a row of nulls."""
    records = F.from_json("JsonData", "InventoryRecords array<struct<InventoryStatus:string,ProductQuantity:bigint>>")["InventoryRecords"]
    return payloads.select("PrimaryKey", "TimeStamp", F.posexplode(records).alias("Position", "_r")).select(
        F.col("PrimaryKey").alias("CloseBinPrimaryKey"), "TimeStamp", "Position", "_r.InventoryStatus", "_r.ProductQuantity")


def latest_snapshot(df: DataFrame, col: str = "Snapshot_Id") -> DataFrame:
    """Rows of the greatest snapshot id.  The max is a scalar subquery
    (evaluated once, no join); on snapshot-partitioned storage the filter
    becomes a partition filter and prunes to one partition."""
    return df.filter(F.col(col) == df.agg(F.max(col)).scalar())


def latest_by_day(df: DataFrame, keys: Sequence[str], day: Column, snapshot: str = "Snapshot_Id") -> DataFrame:
    """Per key and day, the rows of the latest snapshot of that day
    (a window max over (key, day): partitions are as small as one key-day)."""
    w = Window.partitionBy(*keys, day)
    return df.withColumn("_max_snap", F.max(snapshot).over(w)).filter(F.col(snapshot) == F.col("_max_snap")).drop("_max_snap")


def with_date(df: DataFrame, col: str, out: str = "Date") -> DataFrame:
    """Import-time date column from a timestamp (or ISO text) column."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, T.StringType):
        c = F.to_date(F.try_to_timestamp(c))
    else:
        c = F.to_date(c)
    return df.withColumn(out, c)


def port_sort(c: Column) -> Column:
    """Drop one leading 'P', parse the number, else 999999 (Int64)."""
    v = F.regexp_replace(c.cast("string"), "^P", "").try_cast("double")
    return F.coalesce(F.round(v, 0).cast("bigint"), F.lit(999999).cast("bigint"))


def hour_columns(df: DataFrame, ts: str) -> DataFrame:
    """Hour label ('1 PM') and hour sort (0-23)."""
    return df.withColumn("Hour", F.date_format(F.col(ts), "h a")).withColumn("HourSort", F.hour(F.col(ts)))


def template_names(templates: DataFrame, compartments: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per template, CompartmentName (the size name of its compartments,
    goods-to-person only; NULL when the template maps to several sizes, where
    the model's single-value lookup fails) and CombinedName
    '<size> (<template name after its first space>)' for goods-to-person rows."""
    per = compartments.select("TemplatePrimaryKey", "CompartmentSizePrimaryKey").dropDuplicates()
    one = per.groupBy("TemplatePrimaryKey").agg(
        F.count_distinct("CompartmentSizePrimaryKey").alias("_n"), F.max("CompartmentSizePrimaryKey").alias("_size"))
    one = one.withColumn("_size", F.when(F.col("_n") == 1, F.col("_size")))
    sz = sizes.select(F.col("PrimaryKey").alias("_size"), F.col("Name").alias("_name"))
    t = templates.join(one.withColumnRenamed("TemplatePrimaryKey", "PrimaryKey"), "PrimaryKey", "left").join(sz, "_size", "left")
    gtp = F.col("IsGoodsToPerson") == F.lit(True)
    name = F.when(gtp & F.col("_name").isNotNull(), F.col("_name"))
    pos = F.instr(F.col("TemplateName"), " ")
    tail = F.when(pos > 0, F.expr("substr(TemplateName, instr(TemplateName, ' ') + 1)")).otherwise(F.lit(""))
    combined = F.when(gtp, F.concat(F.coalesce(name, F.lit("")), F.lit(" ("), tail, F.lit(")")))
    return t.select("PrimaryKey", "TemplateName", name.alias("CompartmentName"), combined.alias("CombinedName"))


# ---- E06: sessions from raw telemetry ----------------------------------------------------

def raw_work_sessions(deduped: DataFrame) -> DataFrame:
    """E04 over de-duplicated telemetry, in one pass of it; ties ordered
    by the text 'db:table:key' (text order, not numeric)."""
    way = F.when(F.col("DataDescription").isin(*SIGN_IN_DESCRIPTIONS), "SignIn").when(F.col("DataDescription").isin(*SIGN_OUT_DESCRIPTIONS), "SignOut")
    signs = typed_telemetry(deduped.withColumn("_way", way).where("_way is not null").drop("_way")).select(
        way.alias("Kind"), F.substring_index("DataDescription", "-Sign", 1).alias("WorkType"), "LocationPrimaryKey", F.col("User").alias("UserName"), "TimeStamp",
        F.concat_ws(":", "SourceDatabase", "SourceTable", F.col("PrimaryKey").cast("string")).alias("PrimaryKey"),
        "SourceDatabase", "SourceTable", F.col("PrimaryKey").alias("SourcePrimaryKey"))
    s = paired_sessions(signs, "SourceDatabase", "SourceTable", "SourcePrimaryKey")
    ms = ms_between("SignInTime", "SignOutTime")
    return s.select(
        "WorkType", "UserName", "LocationPrimaryKey", F.lit(None).cast("string").alias("Port"), "SignInTime", "SignOutTime",
        ms.alias("SessionMs"), ms_to_seconds(ms).alias("SessionSeconds"),
        *(f"{side}{c}" for side in ("SignIn", "SignOut") for c in ("SourceDatabase", "SourceTable", "SourcePrimaryKey")))
