"""Streaming (T01-T04) and sync jobs (Y01-Y03) against their batch forms."""

from __future__ import annotations

import datetime as dt
import glob
import os
import tempfile

from pyspark.sql import functions as F

import pytest

from opsgrain.functions import frames
from opsgrain.operators.temporal import pair_sessions
from opsgrain.plans import items_streaming
from opsgrain.plans import published
from opsgrain.plans import sync as Y
from opsgrain.sources.adapter import Tables
from opsgrain.sources.staging import dedupe_metrics, metric_sources
from opsgrain.streaming import streams as T

SF = "/root/testdata/sf0.001"


def _scratch() -> str:
    return tempfile.mkdtemp(prefix="opsgrain-test-", dir=os.environ.get("TMPDIR", "/tmp"))


def _write_in_files(df, path, n=4):
    df.repartition(n).write.mode("overwrite").parquet(path)


def test_stream_sessions_equals_batch_pairing(spark):
    t = Tables(spark, SF)
    sign = t.sign_in.withColumn("Side", F.lit("in")).unionByName(t.sign_out.withColumn("Side", F.lit("out")))
    d = _scratch()
    src = os.path.join(d, "src")
    _write_in_files(sign, src)
    stream = spark.readStream.schema(sign.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = T.stream_sessions(stream, os.path.join(d, "raw"), os.path.join(d, "sessions"), name=f"s-{os.path.basename(d)}")
    q.awaitTermination(300)
    got = T.read_sessions(spark, os.path.join(d, "sessions"))
    exp = pair_sessions(t.sign_in, t.sign_out, T.SIGN_KEYS)
    key = ["SignInPrimaryKey", "SignOutPrimaryKey"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, exp.select(*key).collect()))
    assert got.count() == 28  # FIXTURES.md stage count at sf0.001


def test_stream_dedupe_first_arrival(spark):
    t = Tables(spark, SF)
    src_df = metric_sources([(f"db{i}", "ReportedMetrics", i, t.reported_metrics(i)) for i in (1, 2, 3, 4)])
    d = _scratch()
    _write_in_files(src_df, os.path.join(d, "m"))
    stream = spark.readStream.schema(src_df.schema).parquet(os.path.join(d, "m"))
    out = os.path.join(d, "out")
    q = (T.stream_dedupe(stream, "1 day").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(d, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    # same set of distinct contents as the batch de-duplication
    assert got.count() == dedupe_metrics(src_df).count()


def test_stream_throughput_matches_batch_hours(spark):
    from opsgrain.plans.items_events import work_events
    t = Tables(spark, SF)
    ev = work_events(t).filter(F.col("StartTime").isNotNull())
    d = _scratch()
    _write_in_files(ev, os.path.join(d, "ev"))
    stream = spark.readStream.schema(ev.schema).parquet(os.path.join(d, "ev"))
    out = os.path.join(d, "tp")
    q = (T.stream_throughput(stream, "1 hour").writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(d, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    total = got.agg(F.sum("OrdersCompleted")).first()[0] or 0
    batch_total = ev.filter(F.col("WorkType") == "Pick").agg(F.sum("OrderCompletedCount")).first()[0]
    # hours still open at the end of the stream are not emitted in append mode
    assert 0 < total <= batch_total
    hourly = T.stream_hourly(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "ev")), os.path.join(d, "hourly"), f"h-{os.path.basename(d)}")
    hourly.awaitTermination(300)
    assert T.read_hourly(spark, os.path.join(d, "hourly")).agg(F.sum("OrdersCompleted")).first()[0] == batch_total


def test_foreach_sync_is_idempotent_per_batch(spark):
    t = Tables(spark, SF)
    d = _scratch()
    _write_in_files(t.report_data, os.path.join(d, "rd"), n=3)
    stream = spark.readStream.schema(t.report_data.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "rd"))
    q = T.foreach_sync(stream, os.path.join(d, "target"), os.path.join(d, "ledger"), name=f"y-{os.path.basename(d)}")
    q.awaitTermination(300)
    assert spark.read.parquet(os.path.join(d, "target")).count() == t.report_data.count()
    led = spark.read.parquet(os.path.join(d, "ledger"))
    assert led.agg(F.sum("TotalRecordSynced")).first()[0] == t.report_data.count()


def test_sync_increment_appends_only_new_keys(spark):
    t = Tables(spark, SF)
    d = _scratch()
    rd = t.report_data
    half = rd.filter(F.col("PrimaryKey") < 400)
    now = dt.datetime(2024, 1, 31)
    r1 = Y.sync_increment(spark, half, os.path.join(d, "tgt"), os.path.join(d, "led"), "TableSync", "db1", "ReportedMetrics", now)
    r2 = Y.sync_increment(spark, rd, os.path.join(d, "tgt"), os.path.join(d, "led"), "TableSync", "db1", "ReportedMetrics", now)
    r3 = Y.sync_increment(spark, rd, os.path.join(d, "tgt"), os.path.join(d, "led"), "TableSync", "db1", "ReportedMetrics", now)
    assert spark.read.parquet(os.path.join(d, "tgt")).count() == rd.count()
    assert r1["TotalRecordSynced"] + r2["TotalRecordSynced"] == rd.count()
    assert r3["TotalRecordSynced"] == 0 and r2["BatchId"] == 2


def test_increment_survives_a_crash_before_its_ledger_row(spark):
    rd = Tables(spark, SF).report_data
    d = _scratch()
    args = (os.path.join(d, "tgt"), os.path.join(d, "led"), "TableSync", "db1", "ReportedMetrics", dt.datetime(2024, 1, 31))
    Y.sync_increment(spark, rd.filter("PrimaryKey <= 300"), *args)
    # a run that wrote its data and died: the next one has the same batch number and replaces it
    rd.filter("PrimaryKey > 300 and PrimaryKey <= 500").withColumn("SyncBatch", F.lit(2).cast("bigint")).write.mode("append").partitionBy("SyncBatch").parquet(args[0])
    Y.sync_increment(spark, rd, *args)
    assert spark.read.parquet(args[0]).count() == rd.count()


def test_unreadable_ledger_is_an_error(spark):
    d = _scratch()
    path = os.path.join(d, "led")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet|read"):
        Y.sync_increment(spark, Tables(spark, SF).report_data, os.path.join(d, "tgt"), path, "j", "db", "t", dt.datetime(2024, 1, 31))


def test_snapshot_append_and_purge(spark):
    t = Tables(spark, SF)
    d = _scratch()
    tgt = os.path.join(d, "inv")
    base = t.inventory.drop("Snapshot_Id")
    for i in (1, 2, 3):
        Y.append_snapshot(base, tgt, i, dt.datetime(2024, 1, i))
        Y.append_snapshot(base, tgt, i, dt.datetime(2024, 1, i))  # a retry
    n = base.count()
    assert Y.read_snapshots(spark, tgt).groupBy("Snapshot_Id").count().collect() == Y.read_snapshots(spark, tgt).groupBy("Snapshot_Id").agg(F.lit(n).alias("count")).collect()
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tgt}/*/*.parquet")}
    assert Y.purge(spark, tgt, 2) == [1] and Y.purge(spark, tgt, 2) == []
    assert sorted(r[0] for r in Y.read_snapshots(spark, tgt).select("Snapshot_Id").distinct().collect()) == [2, 3]
    assert files == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tgt}/*/*.parquet")}  # no file was written anew
    # rows without an entry, as a run that died leaves them, are not seen
    base.withColumn("Snapshot_Id", F.lit(9)).withColumn("Snapshot_Timestamp", F.lit(None).cast("timestamp")).write.mode("append").partitionBy("Snapshot_Id").parquet(tgt)
    assert Y.read_snapshots(spark, tgt).where("Snapshot_Id = 9").count() == 0


def test_published_table_is_never_half_written(spark):
    path = os.path.join(_scratch(), "table")
    one, two = (spark.range(n).withColumn("v", F.lit(n)) for n in (5, 9))
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path)
    published.publish(one, path)
    before = published.read_published(spark, path)
    broken = two.withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("dies here"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="dies here"):
        published.publish(broken, path)
    two.write.parquet(f"{path}/versions/orphan")  # a version whose writer died before its pointer
    assert published.read_published(spark, path).count() == 5
    published.publish(two, path)
    assert published.read_published(spark, path).count() == 9 and before.count() == 5
    published.publish(one, path)
    assert published.read_published(spark, path).count() == 5 and len(published.versions_to_drop(spark, path)) == 1


def test_partial_results_converge_in_any_order_and_on_replay(spark):
    t = Tables(spark, SF)
    src = metric_sources([(f"db{i}", "ReportedMetrics", i, t.reported_metrics(i)) for i in (4, 1, 3, 2)])
    path = os.path.join(_scratch(), "best")
    run = T._partials(path, "EventTimestamp", dedupe_metrics)
    parts = [src.where(F.col("SourcePrimaryKey") % 3 == k) for k in (2, 0, 1)]
    for batch, part in enumerate(parts):
        run(part, batch)
    run(parts[2], 2)  # replayed
    want = dedupe_metrics(src)
    got = T.read_best_copies(spark, path).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


def test_copies_are_sorted_in_tasks_of_bounded_size(spark, monkeypatch, tmp_path):
    rows = spark.createDataFrame([("db1", "M", 1, i, "Pick", f"{i % 900}", dt.datetime(2024, 1, 1)) for i in range(3000)],
                                 "SourceDatabase string, SourceTable string, SourcePriority int, SourcePrimaryKey bigint, DataDescription string, JsonData string, EventTimestamp timestamp")
    want = sorted(map(tuple, dedupe_metrics(rows.coalesce(1)).collect()))
    monkeypatch.setattr(frames, "TASK_ROWS", 300)
    sizes = [n for _, n in frames.spread(rows.coalesce(1), "SourcePrimaryKey").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 300
    got = dedupe_metrics(rows.coalesce(1))
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString() and sorted(map(tuple, got.collect())) == want
    # the streamed files are of bounded size, too
    tables = Tables(spark, "/root/testdata/sf0.001")
    path = items_streaming._streamed(tables, "bounded", rows, T.stream_best_copies)
    files = spark.read.parquet(f"{os.path.dirname(path)}/source").groupBy(F.input_file_name()).count().collect()
    assert len(files) == 10 and max(n for _, n in files) < 2 * 300
    assert sorted(map(tuple, T.read_best_copies(spark, path).select(*got.columns).collect())) == want


def test_recover_stuck_completes_newest_open_row(spark):
    t = Tables(spark, SF)
    led = Y.ledger_from_batches(t.report_data)
    fix = Y.recover_stuck(led, dt.datetime(2024, 1, 31), job="TableSync")
    assert fix.count() == 1
    after = Y.apply_corrections(led, fix)
    assert after.filter(F.col("TableName").isNull() & ~F.col("IsCompleted")).count() == 0
    assert after.count() == led.count()


def _ledger_rows(spark, rows):
    return spark.createDataFrame(rows, Y.LEDGER_SCHEMA).drop("RecordedAt")


def test_fixture_f15_snapshot_health(spark):
    day = dt.date(2024, 1, 30)
    snaps = spark.createDataFrame(
        [(1, 1, dt.datetime(2024, 1, 20, 5)), (2, 1, dt.datetime(2024, 1, 20, 5)), (1, 2, dt.datetime(2024, 1, 29, 6)),
         (3, 2, dt.datetime(2024, 1, 29, 6))], "PrimaryKey bigint, Snapshot_Id bigint, Snapshot_Timestamp timestamp")
    empty = snaps.limit(0)
    h = Y.snapshot_health([("Inventory_Snapshot", "Inventory", snaps), ("Containers_Snapshot", "Inventory", empty),
                           ("PutAwayContainers_Snapshot", "Inbound", None)], day - dt.timedelta(days=7))
    r = {x.TableName: x for x in h.collect()}
    assert r["Inventory_Snapshot"].RowsInLatestSnapshot == 2 and r["Inventory_Snapshot"].DistinctSnapshotIds == 2
    assert r["Inventory_Snapshot"].RowsInPowerBIDefaultWindow == 2
    assert r["Containers_Snapshot"].Rows == 0 and r["Containers_Snapshot"].MaxSnapshotDate is None
    assert r["PutAwayContainers_Snapshot"].ObjectStatus == "MISSING_OR_INACCESSIBLE"


def test_fixture_f14_recover_and_repair_gate(spark):
    now = dt.datetime(2024, 1, 30, 12)
    base = dict(DatabaseName=None, TableName=None, StartPrimaryKey=None, EndPrimaryKey=None, TotalRecordSource=0,
                TotalRecordSynced=0, IsDeleted=False, RecordedAt=None, IsStarted=True, JobName="DynamicTableInsert")
    rows = [dict(base, Id=1, BatchId=1, SyncStartTime=dt.datetime(2024, 1, 30, 1), SyncEndTime=dt.datetime(2024, 1, 30, 2), IsCompleted=True),
            dict(base, Id=2, BatchId=2, SyncStartTime=dt.datetime(2024, 1, 30, 3), SyncEndTime=None, IsCompleted=False),
            dict(base, Id=3, BatchId=3, SyncStartTime=dt.datetime(2024, 1, 30, 4), SyncEndTime=None, IsCompleted=False)]
    led = _ledger_rows(spark, rows)
    fix = Y.recover_stuck(led, now)
    assert [r.Id for r in fix.collect()] == [3]          # newest open row only
    after = Y.apply_corrections(led, fix)
    assert after.filter(~F.col("IsCompleted")).count() == 1  # the other open row stays open
    snap = spark.createDataFrame([(1, dt.datetime(2024, 1, 30, 5))], "Snapshot_Id bigint, Snapshot_Timestamp timestamp")
    gate = Y.repair_gate(after, [snap], [snap], dt.date(2024, 1, 30)).first()
    assert gate.Status == "WARN" and gate.Details.startswith("OpenRows=1;")
    all_done = Y.apply_corrections(after, Y.recover_stuck(after, now))
    assert Y.repair_gate(all_done, [snap], [snap], dt.date(2024, 1, 30)).first().Status == "PASS"
    checks = {r.CheckName: r.Status for r in Y.sync_checks(
        Y.snapshot_health([("Inventory_Snapshot", "Inventory", snap), ("X", "Inbound", snap)], dt.date(2024, 1, 23)),
        Y.source_health([("Inventory", "db", "Inventory", snap, "Snapshot_Id", "Snapshot_Timestamp")], dt.date(2024, 1, 23)),
        all_done, now, dt.date(2024, 1, 23)).collect()}
    assert checks == {"Inventory snapshots exist in Power BI default window": "PASS",
                      "Inbound snapshots exist in Power BI default window": "PASS",
                      "DynamicTableInsert completed recently": "PASS", "No open DynamicTableInsert row": "PASS",
                      "Live source has recent inventory/inbound rows": "PASS"}
