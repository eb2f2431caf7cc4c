"""Structured Streaming re-aim of the source's 2-minute polling sync.

* T01 ``stream_best_copies``: S03 over a stream, from partial results per
  batch; ``stream_dedupe`` is the form with a watermark and bounded state, in
  which the first arrival wins.
* T02 ``stream_hourly``: hourly event counts per port from partial sums per
  batch, open hours and late rows included; ``stream_throughput`` is the form
  in append mode, which gives an hour once the watermark passes its end.
* T03 ``stream_sessions``: incremental sign-in/sign-out pairing.  Each
  micro-batch stores its raw rows under (day, batch) and re-pairs only the days
  it touched, overwriting those day partitions of the session table.  Pairing
  ranks within a day, so re-pairing a day is exact; late rows are accepted.
* T04 ``foreach_sync``: micro-batch append of a synced table plus a ledger row.

Every write is idempotent per micro-batch id (dynamic partition overwrite of
the batch's own partition), so a batch replayed after an executor or driver
failure does not duplicate rows.  Checkpoints live under the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opsgrain.functions.frames import spread
from opsgrain.operators.temporal import pair_sessions
from opsgrain.plans.pages import port_label  # the batch page's port labels
from opsgrain.session import checkpoint_dir
from opsgrain.sources.staging import dedupe_metrics, event_hash


def _checkpoint(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


def stream_dedupe(metrics: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Telemetry rows de-duplicated by (description, timestamp, content hash)."""
    return (
        event_hash(metrics)
        .withWatermark("EventTimestamp", watermark)
        .dropDuplicatesWithinWatermark(["DataDescription", "EventTimestamp", "EventHash"])
    )


def stream_throughput(events: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Per hour window × port label: orders, lines and bins of Pick events."""
    e = events.filter(F.col("WorkType") == "Pick").withWatermark("StartTime", watermark)
    return e.groupBy(F.window("StartTime", "1 hour").alias("Hour"), port_label(F.col("Port")).alias("Ports")).agg(
        F.sum("OrderCompletedCount").cast("bigint").alias("OrdersCompleted"),
        F.sum("LineCompletedCount").cast("bigint").alias("LinesCompleted"),
        F.sum("BinPresentationCount").cast("bigint").alias("BinPresentationsCompleted"),
    )


# ---- exact incremental aggregates (T01, T02) ------------------------------------------------------
#
# Each micro-batch is reduced to partial results and written as its own (day, batch) partition, which a replay
# overwrites.  A reader merges the partials, so the result is that of the whole input in whatever order it came,
# with late rows and hours still open, and a lost or repeated batch does no harm.

def _partials(path: str, day: str, reduce):
    def run(batch: DataFrame, batch_id: int) -> None:
        part = reduce(batch).withColumn("_day", F.to_date(day)).withColumn("_batch", F.lit(batch_id).cast("bigint"))
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day", "_batch").parquet(path)
    return run


def _start(stream: DataFrame, run, name: str, trigger: dict | None) -> StreamingQuery:
    out = stream.writeStream.foreachBatch(run).option("checkpointLocation", _checkpoint(stream.sparkSession, name))
    return out.trigger(**(trigger or {"availableNow": True})).start()


def stream_best_copies(metrics: DataFrame, path: str, name: str = "best-copies", trigger: dict | None = None) -> StreamingQuery:
    """S03 over a stream: per batch the best copy of each content and the
    number of copies.  Read it with ``read_best_copies``."""
    return _start(metrics, _partials(path, "EventTimestamp", dedupe_metrics), name, trigger)


def read_best_copies(spark: SparkSession, path: str) -> DataFrame:
    """What S03 gives for all batches so far."""
    parts = spark.read.parquet(path).drop("_day", "_batch")
    content = ["DataDescription", "EventTimestamp", "EventHash"]
    order = F.struct("SourcePriority", "SourceDatabase", "SourceTable", "SourcePrimaryKey")
    kept = F.struct(*(c for c in parts.columns if c not in (*content, "DuplicateSourceRows")))
    best = spread(parts, *content).groupBy(*content).agg(F.min_by(kept, order).alias("_k"), F.sum("DuplicateSourceRows").alias("DuplicateSourceRows"))
    return best.select(*content, "_k.*", "DuplicateSourceRows").select(*parts.columns)


HOURLY = {"OrdersCompleted": "OrderCompletedCount", "LinesCompleted": "LineCompletedCount", "BinPresentationsCompleted": "BinPresentationCount"}


def stream_hourly(events: DataFrame, path: str, name: str = "hourly", trigger: dict | None = None) -> StreamingQuery:
    """T02 without a watermark: orders, lines and bins of Pick events per hour
    and port label, partial sums per batch.  Read it with ``read_hourly``."""
    def reduce(batch: DataFrame) -> DataFrame:
        e = batch.where("WorkType = 'Pick' and StartTime is not null").groupBy(F.date_trunc("hour", "StartTime").alias("Hour"), port_label(F.col("Port")).alias("Ports"))
        return e.agg(*(F.sum(c).cast("bigint").alias(name) for name, c in HOURLY.items()))

    return _start(events, _partials(path, "Hour", reduce), name, trigger)


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    """The totals of all batches so far."""
    return spark.read.parquet(path).groupBy("Hour", "Ports").agg(*(F.sum(c).alias(c) for c in HOURLY))


SIGN_KEYS = ["WorkType", "LocationPrimaryKey", "UserName"]


def _sessions_batch(raw_path: str, sessions_path: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = batch.withColumn("_day", F.to_date("TimeStamp")).withColumn("_batch", F.lit(batch_id).cast("bigint"))
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_day", "_batch").parquet(raw_path))
        touched = [r["_day"] for r in staged.select("_day").distinct().collect()]  # the days of one micro-batch
        if not touched:
            return
        days = spark.createDataFrame([(d,) for d in touched], "_day date")
        # only the folders of these days are listed, and nothing is inferred
        folders = [f"{raw_path}/_day={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in touched]
        hist = spark.read.schema(staged.schema).option("basePath", raw_path).parquet(*folders)
        ins = hist.filter(F.col("Side") == "in")
        outs = hist.filter(F.col("Side") == "out")
        s = pair_sessions(ins, outs, SIGN_KEYS).withColumn(
            "SessionMs", F.unix_millis("SignOutTime") - F.unix_millis("SignInTime")).withColumn("_marker", F.lit(False))
        # one marker row per touched day: a day whose re-pairing yields no
        # session still gets its partition replaced (no stale sessions survive)
        markers = days.select(F.col("_day").alias("SessionDate"), F.lit(True).alias("_marker"))
        out = s.unionByName(markers, allowMissingColumns=True)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("SessionDate").parquet(sessions_path))
    return run


def read_sessions(spark: SparkSession, sessions_path: str) -> DataFrame:
    """The session table written by ``stream_sessions`` (day markers removed)."""
    return spark.read.parquet(sessions_path).filter(~F.col("_marker")).drop("_marker")


def stream_sessions(sign_events: DataFrame, raw_path: str, sessions_path: str, name: str = "sessions",
                    trigger: dict | None = None) -> StreamingQuery:
    """Start the incremental pairing query.  ``sign_events`` is a stream
    of (Side 'in'/'out', WorkType, PrimaryKey, TimeStamp, LocationPrimaryKey, UserName)."""
    spark = sign_events.sparkSession
    w = sign_events.writeStream.foreachBatch(_sessions_batch(raw_path, sessions_path)) \
        .option("checkpointLocation", _checkpoint(spark, name))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


#: Ledger ids of streamed batches start here, apart from those of the batch sync.
STREAM_IDS = 1 << 40


def _sync_batch(target: str, ledger_path: str, job: str, database: str, table: str, key: str):
    from opsgrain.plans.sync import LEDGER_SCHEMA

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stats = batch.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("k0"), F.max(key).alias("k1")).first()
        (batch.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(target))
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = {"Id": STREAM_IDS + int(batch_id), "JobName": job, "DatabaseName": database, "TableName": table, "BatchId": int(batch_id),
               "StartPrimaryKey": stats["k0"], "EndPrimaryKey": stats["k1"], "SyncStartTime": now, "SyncEndTime": now,
               "IsStarted": True, "IsCompleted": True, "TotalRecordSource": int(stats["n"]),
               "TotalRecordSynced": int(stats["n"]), "IsDeleted": False, "RecordedAt": now}
        (spark.createDataFrame([row], LEDGER_SCHEMA).withColumn("_batch", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(ledger_path))
    return run


def foreach_sync(source: DataFrame, target: str, ledger_path: str, job: str = "TableSync", database: str = "db1",
                 table: str = "ReportedMetrics", key: str = "PrimaryKey", name: str = "sync",
                 trigger: dict | None = None) -> StreamingQuery:
    """Each micro-batch is appended to ``target`` with one ledger row
    (both keyed by the batch id, so a replay rewrites instead of duplicating)."""
    spark = source.sparkSession
    w = source.writeStream.foreachBatch(_sync_batch(target, ledger_path, job, database, table, key)) \
        .option("checkpointLocation", _checkpoint(spark, name))
    return w.trigger(**(trigger or {"availableNow": True})).start()
