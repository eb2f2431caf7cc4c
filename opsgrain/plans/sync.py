"""Snapshot and incremental sync as Spark batch jobs (Y items).

The source system appends telemetry by primary-key range every 2 minutes and
re-appends whole snapshot tables hourly, recording each load in a ledger
(``DataSyncDetail``).  Here the loads are parquet appends and the ledger is an
append-only parquet table: a correction (completing a stuck batch) is a new
row for the same Id, and the newest row per Id wins.  Jobs write to paths
under the cluster's shared folder; nothing is collected to the driver except
the one-row key watermark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.functions.frames import beside

LEDGER_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType()), T.StructField("JobName", T.StringType()),
    T.StructField("DatabaseName", T.StringType()), T.StructField("TableName", T.StringType()),
    T.StructField("BatchId", T.LongType()), T.StructField("StartPrimaryKey", T.LongType()),
    T.StructField("EndPrimaryKey", T.LongType()), T.StructField("SyncStartTime", T.TimestampType()),
    T.StructField("SyncEndTime", T.TimestampType()), T.StructField("IsStarted", T.BooleanType()),
    T.StructField("IsCompleted", T.BooleanType()), T.StructField("TotalRecordSource", T.LongType()),
    T.StructField("TotalRecordSynced", T.LongType()), T.StructField("IsDeleted", T.BooleanType()),
    T.StructField("RecordedAt", T.TimestampType()),
])
LEDGER_COLUMNS = [f.name for f in LEDGER_SCHEMA.fields if f.name != "RecordedAt"]


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one where the path does not exist; any other
    failure to read it is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def current_ledger(ledger: DataFrame) -> DataFrame:
    """Latest row per Id (append-only corrections)."""
    w = Window.partitionBy("Id").orderBy(F.col("RecordedAt").desc_nulls_last())
    return ledger.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def sync_increment(spark: SparkSession, src: DataFrame, target: str, ledger_path: str, job: str, database: str,
                   table: str, now: dt.datetime, key: str = "PrimaryKey") -> dict:
    """Append the source rows with ``key`` above the last synced key,
    then append a completed ledger row for the batch.  Returns the ledger row.

    The batch is the key range up to the largest key seen at the start, so rows
    that arrive meanwhile belong to the next one.  It is written to the
    partition ``SyncBatch`` of its number, replacing what a run that failed
    before its ledger row may have left there."""
    led = current_ledger(_read_or_empty(spark, ledger_path, LEDGER_SCHEMA))
    mine = led.filter((F.col("JobName") == job) & (F.col("TableName") == table) & F.col("IsCompleted"))
    wm = mine.agg(F.max("EndPrimaryKey").alias("k"), F.max("BatchId").alias("b")).first()
    last_id = led.agg(F.max("Id").alias("i")).first()["i"] or 0
    batch = (wm["b"] or 0) + 1
    above = src if wm["k"] is None else src.filter(F.col(key) > F.lit(wm["k"]))
    k1 = above.agg(F.max(key).alias("k1")).first()["k1"]
    k0, n = None, 0
    if k1 is not None:
        (above.filter(F.col(key) <= F.lit(k1)).withColumn("SyncBatch", F.lit(batch).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("SyncBatch").parquet(target))
        written = spark.read.parquet(target).filter(F.col("SyncBatch") == batch).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("k0")).first()
        k0, n = written["k0"], written["n"]
    row = {
        "Id": last_id + 1, "JobName": job, "DatabaseName": database, "TableName": table, "BatchId": batch,
        "StartPrimaryKey": k0, "EndPrimaryKey": wm["k"] if k1 is None else k1,
        "SyncStartTime": now, "SyncEndTime": now, "IsStarted": True, "IsCompleted": True,
        "TotalRecordSource": n, "TotalRecordSynced": n, "IsDeleted": False, "RecordedAt": now,
    }
    spark.createDataFrame([row], LEDGER_SCHEMA).write.mode("append").parquet(ledger_path)
    return row


def begin_batch(spark: SparkSession, ledger_path: str, job: str, now: dt.datetime) -> dict:
    """The top-level ledger row of a run of ``job``, begun and not finished."""
    led = current_ledger(_read_or_empty(spark, ledger_path, LEDGER_SCHEMA))
    last = led.agg(F.max("Id").alias("id"), F.max(F.when((F.col("JobName") == job) & F.col("TableName").isNull(), F.col("BatchId"))).alias("batch")).first()
    row = dict.fromkeys(LEDGER_SCHEMA.names) | {
        "Id": (last["id"] or 0) + 1, "JobName": job, "BatchId": (last["batch"] or 0) + 1, "SyncStartTime": now, "IsStarted": True, "IsCompleted": False,
        "IsDeleted": False, "RecordedAt": now}
    spark.createDataFrame([row], LEDGER_SCHEMA).write.mode("append").parquet(ledger_path)
    return row


def finish_batch(spark: SparkSession, ledger_path: str, begun: dict, now: dt.datetime, rows: int) -> None:
    """Append the correction that closes a run's top-level row."""
    row = begun | {"SyncEndTime": now, "IsCompleted": True, "TotalRecordSource": rows, "TotalRecordSynced": rows, "RecordedAt": now}
    spark.createDataFrame([row], LEDGER_SCHEMA).write.mode("append").parquet(ledger_path)


def _manifest(target: str) -> str:
    return f"{target.rstrip('/')}-manifest"


def _record(spark: SparkSession, target: str, rows: list[tuple]) -> None:
    """Replace the manifest's entries of some snapshots."""
    df = spark.createDataFrame(rows, "Snapshot_Id bigint, Snapshot_Timestamp timestamp, Live boolean").coalesce(1)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Snapshot_Id").parquet(_manifest(target))


def append_snapshot(src: DataFrame, target: str, snapshot_id: int, ts: dt.datetime) -> None:
    """Stamp Snapshot_Id / Snapshot_Timestamp and write a snapshot
    partition (``partitionBy('Snapshot_Id')`` so readers of the latest snapshot
    prune to one folder), then its manifest entry.  A retry replaces its own
    partition and entry; a run that died in between left rows that no reader of
    the manifest sees."""
    spark = src.sparkSession
    (src.withColumn("Snapshot_Id", F.lit(snapshot_id).cast("bigint"))
        .withColumn("Snapshot_Timestamp", F.lit(ts).cast("timestamp"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Snapshot_Id").parquet(target))
    _record(spark, target, [(snapshot_id, ts, True)])


def read_snapshots(spark: SparkSession, target: str) -> DataFrame:
    """The snapshots that the manifest holds as live: a filter on the partition
    column, whose values are as many as retention keeps."""
    live = [r["Snapshot_Id"] for r in spark.read.parquet(_manifest(target)).where("Live").select("Snapshot_Id").collect()]
    return spark.read.parquet(target).where(F.col("Snapshot_Id").isin(live) if live else F.lit(False))


def purge(spark: SparkSession, target: str, keep: int) -> list[int]:
    """Retention: retire all but the newest ``keep`` snapshots in the
    manifest.  No kept file is touched; the retired ids are returned, whose
    folders may be removed once no reader holds them."""
    live = spark.read.parquet(_manifest(target)).where("Live").orderBy(F.col("Snapshot_Id").desc()).collect()  # one row a snapshot
    old = [(r["Snapshot_Id"], r["Snapshot_Timestamp"], False) for r in live[keep:]]
    if old:
        _record(spark, target, old)
    return [r[0] for r in old]


# ---- ledger reports (Y04, Y05, Y10) ------------------------------------------------------------

def ledger_from_batches(report_data: DataFrame, job: str = "TableSync", database: str = "db1",
                        table: str = "ReportedMetrics") -> DataFrame:
    """The ledger rows a key-range sync writes for the batches present in a
    synced table: per batch a top-level row (TableName NULL) and a table row;
    the newest batch is still open."""
    b = report_data.groupBy("BatchId").agg(
        F.min("PrimaryKey").alias("StartPrimaryKey"), F.max("PrimaryKey").alias("EndPrimaryKey"),
        F.min("TimeStamp").alias("SyncStartTime"), F.max("TimeStamp").alias("_end"), F.count(F.lit(1)).alias("_n"))
    b = b.withColumn("IsCompleted", F.col("BatchId") < b.agg(F.max("BatchId")).scalar())
    def rows(top: bool) -> DataFrame:
        return b.select(
            (F.col("BatchId") * 2 + (0 if top else 1)).alias("Id"), F.lit(job).alias("JobName"),
            (F.lit(None).cast("string") if top else F.lit(database)).alias("DatabaseName"),
            (F.lit(None).cast("string") if top else F.lit(table)).alias("TableName"), "BatchId",
            (F.lit(None).cast("bigint") if top else F.col("StartPrimaryKey")).alias("StartPrimaryKey"),
            (F.lit(None).cast("bigint") if top else F.col("EndPrimaryKey")).alias("EndPrimaryKey"),
            "SyncStartTime", F.when(F.col("IsCompleted"), F.col("_end")).alias("SyncEndTime"),
            F.lit(True).alias("IsStarted"), "IsCompleted", F.col("_n").alias("TotalRecordSource"),
            F.when(F.col("IsCompleted"), F.col("_n")).otherwise(F.lit(0)).cast("bigint").alias("TotalRecordSynced"),
            F.lit(False).alias("IsDeleted"))
    return rows(True).unionByName(rows(False))


# The job and table names the ledger reports select.
SYNC_JOBS = ["TableSync", "DynamicTableInsert", "DeleteDynamicData"]
TOP_LEVEL_JOBS = ["DynamicTableInsert", "DyanamicTableInsert", "DeleteDynamicData", "TableSync"]
SYNC_TABLES = ["ReportedMetrics", "ContainerCompartmentBarcodes", "ContainerTemplateCompartments",
               "InventoryTaskActions", "TaskCategories"]


def ledger_recent(ledger: DataFrame, n: int = 200) -> DataFrame:
    """Y04 (WE sync diagnostics): newest ``n`` ledger rows of the sync jobs / tables."""
    f = ledger.filter(F.col("JobName").isin(SYNC_JOBS) | F.col("TableName").isin(SYNC_TABLES))
    return f.orderBy(F.col("Id").desc()).limit(n).select(*LEDGER_COLUMNS)


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Top-level batch summary per job."""
    f = ledger.filter(F.col("TableName").isNull() & F.col("JobName").isin(TOP_LEVEL_JOBS))
    done = F.coalesce(F.col("IsCompleted"), F.lit(False))
    return f.groupBy("JobName").agg(
        F.count(F.lit(1)).alias("Rows"), F.max("SyncStartTime").alias("LastStartTime"), F.max("SyncEndTime").alias("LastEndTime"),
        F.sum(F.when(F.col("IsStarted") & ~done, 1).otherwise(0)).cast("bigint").alias("OpenRows"),
        F.sum(F.when(F.col("IsStarted") & done, 1).otherwise(0)).cast("bigint").alias("CompletedRows"),
        F.sum(F.when(F.coalesce(F.col("IsDeleted"), F.lit(False)), 1).otherwise(0)).cast("bigint").alias("DeletedRows"))


def ledger_tables(ledger: DataFrame, now: dt.datetime, n: int = 40) -> DataFrame:
    """Newest ``n`` table-level rows with durations up to ``now`` for open rows."""
    f = ledger.filter(F.col("TableName").isin("ReportedMetrics", "InventoryTaskActions"))
    dur = F.unix_seconds(F.coalesce(F.col("SyncEndTime"), F.lit(now).cast("timestamp"))) - F.unix_seconds(F.col("SyncStartTime"))
    return f.orderBy(F.col("Id").desc()).limit(n).select(
        "Id", "JobName", "DatabaseName", "TableName", "BatchId", "StartPrimaryKey", "EndPrimaryKey", "SyncStartTime",
        "SyncEndTime", dur.alias("DurationSeconds"), "IsStarted", "IsCompleted", "TotalRecordSource", "TotalRecordSynced")


def recover_stuck(ledger: DataFrame, now: dt.datetime, job: str = "DynamicTableInsert") -> DataFrame:
    """The newest open top-level row of ``job`` marked completed at
    ``now`` (the correcting ledger row to append); empty when none is open."""
    open_rows = ledger.filter(F.col("TableName").isNull() & F.col("IsStarted") & ~F.coalesce(F.col("IsCompleted"), F.lit(False))
                              & (F.col("JobName") == job))
    newest = open_rows.agg(F.max_by(F.struct(*LEDGER_COLUMNS), F.col("Id")).alias("r")).filter(F.col("r").isNotNull())
    return newest.select("r.*").withColumn("IsCompleted", F.lit(True)).withColumn(
        "SyncEndTime", F.lit(now).cast("timestamp")).select(*LEDGER_COLUMNS)


def apply_corrections(ledger: DataFrame, corrections: DataFrame) -> DataFrame:
    """The ledger after appending corrections: the correction wins per Id."""
    a = ledger.select(*LEDGER_COLUMNS).withColumn("_v", F.lit(0))
    b = corrections.select(*LEDGER_COLUMNS).withColumn("_v", F.lit(1))
    w = Window.partitionBy("Id").orderBy(F.col("_v").desc())
    return a.unionByName(b).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r", "_v")


def stuck_batches(ledger: DataFrame) -> DataFrame:
    """Dynamic-job rows (including the misspelt job name) by job and flags."""
    f = ledger.filter(F.col("JobName").like("%Dynamic%") | F.col("JobName").like("%Dyanamic%"))
    return f.groupBy("JobName", "IsStarted", "IsCompleted").agg(
        F.count(F.lit(1)).alias("RowCount"), F.max("SyncStartTime").alias("LastStart"), F.max("SyncEndTime").alias("LastEnd"))


# ---- health checks (Y06-Y09) -------------------------------------------------------------------------

def _opt(df: DataFrame, name: str, typ: str) -> "F.Column":
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


def snapshot_health(targets, default_start: dt.date) -> DataFrame:
    """Per snapshot table (name, used_by, DataFrame or None): rows,
    snapshot ids, snapshot date range, rows in the latest snapshot and in the
    report's default window; a status row when the table is missing."""
    out = None
    spark = None
    for _, _, df in targets:
        if df is not None:
            spark = df.sparkSession
            break
    for name, used_by, df in targets:
        if df is None:
            part = spark.createDataFrame([(used_by, name, "MISSING_OR_INACCESSIBLE")], "UsedBy string, TableName string, ObjectStatus string") \
                .select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
                    ("Rows", "bigint"), ("DistinctSnapshotIds", "bigint"), ("MinSnapshotDate", "date"), ("MaxSnapshotDate", "date"),
                    ("MaxSnapshotId", "bigint"), ("RowsInLatestSnapshot", "bigint"), ("RowsInPowerBIDefaultWindow", "bigint"))])
        else:
            d = F.to_date(_opt(df, "Snapshot_Timestamp", "timestamp"))
            j = df.withColumn("_mx", df.agg(F.max("Snapshot_Id")).scalar())
            part = j.agg(
                F.lit(used_by).alias("UsedBy"), F.lit(name).alias("TableName"), F.lit("OK").alias("ObjectStatus"),
                F.count(F.lit(1)).alias("Rows"), F.count_distinct("Snapshot_Id").alias("DistinctSnapshotIds"),
                F.min(d).alias("MinSnapshotDate"), F.max(d).alias("MaxSnapshotDate"), F.max("_mx").cast("bigint").alias("MaxSnapshotId"),
                F.sum(F.when(F.col("Snapshot_Id") == F.col("_mx"), 1).otherwise(0)).cast("bigint").alias("RowsInLatestSnapshot"),
                F.sum(F.when(d >= F.lit(default_start), 1).otherwise(0)).cast("bigint").alias("RowsInPowerBIDefaultWindow"))
        out = part if out is None else out.unionByName(part)
    return out


def source_health(targets, default_start: dt.date) -> DataFrame:
    """Live source tables (used_by, db, table, DataFrame or None, key
    column, date column); columns that a table lacks yield NULL measures."""
    out = None
    spark = next(t[3].sparkSession for t in targets if t[3] is not None)
    cols = (("Rows", "bigint"), ("MaxPrimaryKey", "bigint"), ("MinSourceDate", "timestamp"), ("MaxSourceDate", "timestamp"),
            ("RowsInPowerBIDefaultWindow", "bigint"))
    for used_by, db, table, df, key, date_col in targets:
        if df is None:
            part = spark.createDataFrame([(used_by, db, table, "SOURCE_TABLE_MISSING_OR_INACCESSIBLE")],
                                         "UsedBy string, SourceDb string, TableName string, ObjectStatus string") \
                .select("*", *[F.lit(None).cast(t).alias(c) for c, t in cols])
        else:
            has_key = key is not None and key in df.columns
            has_date = date_col is not None and date_col in df.columns
            ts = F.col(date_col).try_cast("timestamp") if has_date else None
            sec = F.date_trunc("second", ts + F.expr("INTERVAL 500 MILLISECONDS")) if has_date else None  # datetime2(0) rounds
            part = df.agg(
                F.lit(used_by).alias("UsedBy"), F.lit(db).alias("SourceDb"), F.lit(table).alias("TableName"), F.lit("OK").alias("ObjectStatus"),
                F.count(F.lit(1)).alias("Rows"),
                (F.max(F.col(key).try_cast("bigint")) if has_key else F.lit(None).cast("bigint")).alias("MaxPrimaryKey"),
                (F.min(sec) if has_date else F.lit(None).cast("timestamp")).alias("MinSourceDate"),
                (F.max(sec) if has_date else F.lit(None).cast("timestamp")).alias("MaxSourceDate"),
                (F.sum(F.when(F.to_date(ts) >= F.lit(default_start), 1).otherwise(0)).cast("bigint") if has_date
                 else F.lit(None).cast("bigint")).alias("RowsInPowerBIDefaultWindow"))
        out = part if out is None else out.unionByName(part)
    return out


def _dyn_top(ledger: DataFrame, job: str = "DynamicTableInsert") -> DataFrame:
    return ledger.filter(F.col("TableName").isNull() & (F.col("JobName") == job))


def sync_checks(snap: DataFrame, src: DataFrame, ledger: DataFrame, now: dt.datetime, default_start: dt.date) -> DataFrame:
    """The five data checks of the sync diagnostic (CheckName, Status, Details).
    The procedure-text check is catalog introspection and is not reproduced."""
    ds = F.lit(default_start.isoformat())
    dyn = _dyn_top(ledger)
    done = F.coalesce(F.col("IsCompleted"), F.lit(False))
    led = dyn.agg(
        F.max(F.when(F.col("IsStarted") & done & (F.col("SyncEndTime") >= F.lit(now - dt.timedelta(hours=4))), 1)).alias("recent"),
        F.max(F.when(done, F.col("SyncEndTime"))).alias("last_end"),
        F.sum(F.when(F.col("IsStarted") & ~done, 1).otherwise(0)).cast("bigint").alias("open"))
    sh = snap.agg(*[x for used in ("Inventory", "Inbound") for x in (
        F.max(F.when((F.col("UsedBy") == used) & (F.col("ObjectStatus") == "OK") & (F.col("RowsInPowerBIDefaultWindow") > 0), 1))
        .alias(f"ok_{used}"), F.max(F.when(F.col("UsedBy") == used, F.col("MaxSnapshotDate"))).alias(f"max_{used}"))])
    so = src.agg(F.max(F.when((F.col("ObjectStatus") == "OK") & (F.col("RowsInPowerBIDefaultWindow") > 0), 1)).alias("src_ok"),
                 F.max(F.when(F.col("ObjectStatus") == "OK", F.col("MaxSourceDate"))).alias("src_max"))
    j = beside(led, sh, so)
    fmt_d = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("NULL"))
    fmt_t = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("NULL"))
    def check(name, status, details):
        return F.struct(F.lit(name).alias("CheckName"), status.alias("Status"), details.alias("Details"))
    rows = F.array(
        check("Inventory snapshots exist in Power BI default window", F.when(F.col("ok_Inventory") == 1, "PASS").otherwise("WARN"),
              F.concat(F.lit("window from "), ds, F.lit(", newest inventory snapshot "), fmt_d(F.col("max_Inventory")),
                       F.lit("."))),
        check("Inbound snapshots exist in Power BI default window", F.when(F.col("ok_Inbound") == 1, "PASS").otherwise("WARN"),
              F.concat(F.lit("window from "), ds, F.lit(", newest inbound snapshot "), fmt_d(F.col("max_Inbound")),
                       F.lit("."))),
        check("DynamicTableInsert completed recently", F.when(F.col("recent") == 1, "PASS").otherwise("WARN"),
              F.concat(F.lit("last insert ended "), fmt_t(F.col("last_end")), F.lit("."))),
        check("No open DynamicTableInsert row", F.when(F.coalesce(F.col("open"), F.lit(0)) > 0, "WARN").otherwise("PASS"),
              F.concat(F.lit("open insert rows: "), F.coalesce(F.col("open"), F.lit(0)).cast("string"), F.lit("."))),
        check("Live source has recent inventory/inbound rows", F.when(F.col("src_ok") == 1, "PASS").otherwise("WARN"),
              F.concat(F.lit("newest live row: "), fmt_t(F.col("src_max")), F.lit("."))),
    )
    return j.select(F.explode(rows).alias("c")).select("c.*")


def repair_gate(ledger: DataFrame, inventory_snaps: list, inbound_snaps: list, today: dt.date) -> DataFrame:
    """After the stuck-batch recovery: no open snapshot batch, today's
    snapshot load completed, and today's inventory and inbound snapshots."""
    dyn = _dyn_top(ledger)
    done = F.coalesce(F.col("IsCompleted"), F.lit(False))
    led = dyn.agg(F.sum(F.when(F.col("IsStarted") & ~done, 1).otherwise(0)).cast("bigint").alias("open"),
                  F.max(F.when(F.col("IsStarted") & done, F.col("SyncEndTime"))).alias("last_end"))

    def max_date(dfs):
        parts = [d.agg(F.max(F.to_date(_opt(d, "Snapshot_Timestamp", "timestamp"))).alias("m")) for d in dfs]
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        return u.agg(F.max("m").alias("m"))
    inv = max_date(inventory_snaps).withColumnRenamed("m", "InventoryMaxSnapshotDate")
    inb = max_date(inbound_snaps).withColumnRenamed("m", "InboundMaxSnapshotDate")
    j = beside(led, inv, inb)
    t = F.lit(today)
    ok = ((F.coalesce(F.col("open"), F.lit(0)) == 0) & (F.to_date("last_end") == t) & (F.col("InventoryMaxSnapshotDate") == t)
          & (F.col("InboundMaxSnapshotDate") == t))
    return j.select(
        F.lit("DailyKpiSyncRepairGate").alias("CheckName"), F.when(ok, "PASS").otherwise("WARN").alias("Status"),
        F.concat(F.lit("OpenRows="), F.coalesce(F.col("open"), F.lit(0)).cast("string"), F.lit("; LatestDynamicTableInsertEnd="),
                 F.coalesce(F.date_format("last_end", "yyyy-MM-dd HH:mm:ss"), F.lit("NULL")), F.lit("; InventoryMaxSnapshotDate="),
                 F.coalesce(F.date_format("InventoryMaxSnapshotDate", "yyyy-MM-dd"), F.lit("NULL")), F.lit("; InboundMaxSnapshotDate="),
                 F.coalesce(F.date_format("InboundMaxSnapshotDate", "yyyy-MM-dd"), F.lit("NULL"))).alias("Details"))
