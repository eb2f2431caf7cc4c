"""Registered queries for the streams (T01-T03): each writes the given events
into a folder of files of bounded size, runs the stream over them in a few
batches until all is read, and returns what its reader then gives."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from opsgrain.functions.frames import tasks_of
from opsgrain.plans.catalog import REGISTRY, canon, register, sel
from opsgrain.plans.items_events import work_events
from opsgrain.plans.items_staging import METRIC_SPEC, sources_of
from opsgrain.session import checkpoint_dir
from opsgrain.streaming import streams


#: Batches in which a stream reads its events.
BATCHES = 4


def _streamed(t, name: str, events, start) -> str:
    """Run ``start(stream, path, name)`` over ``events`` to the end; its path."""
    path = f"{checkpoint_dir(t.spark).rstrip('/')}/opsgrain-tables/{name}-{uuid.uuid4().hex}"
    files = max(BATCHES, tasks_of(events))
    events.repartition(files, *events.columns).write.parquet(f"{path}/source")
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", -(-files // BATCHES)).parquet(f"{path}/source")
    start(stream, f"{path}/target", f"{name}-{uuid.uuid4().hex}").awaitTermination()
    return f"{path}/target"


@register("T01_stream_best_copies", REGISTRY["S03_dedupe_metrics"][1])
def t01(t):
    path = _streamed(t, "best-copies", sources_of(t), streams.stream_best_copies)
    columns = [c.split(":")[0].strip() for c in METRIC_SPEC.split(",")]
    return canon(streams.read_best_copies(t.spark, path).select(*columns, "DuplicateSourceRows"))


@register("T02_stream_hourly", """select strftime(date_trunc('hour', StartTime), '%Y-%m-%d %H:%M:%S.%f') as Hour,
  case when Port is null or trim(Port) in ('', 'No Data') then 'Unattributed' else trim(Port) end as Ports,
  cast(sum(OrderCompletedCount) as bigint) as OrdersCompleted, cast(sum(LineCompletedCount) as bigint) as LinesCompleted,
  cast(sum(BinPresentationCount) as bigint) as BinPresentationsCompleted
from work_events where WorkType = 'Pick' and StartTime is not null group by 1, 2""")
def t02(t):
    return canon(streams.read_hourly(t.spark, _streamed(t, "hourly", work_events(t), streams.stream_hourly)))


@register("T03_stream_sessions", "select " + sel(
    "WorkType, LocationPrimaryKey:i, UserName, SignInPrimaryKey:i, SignOutPrimaryKey:i, SignInTime:T, SignOutTime:T") + " from sessions")
def t03(t):
    signs = t.sign_in.withColumn("Side", F.lit("in")).unionByName(t.sign_out.withColumn("Side", F.lit("out")))
    path = _streamed(t, "sessions", signs, lambda stream, target, name: streams.stream_sessions(stream, f"{target}/raw", f"{target}/sessions", name))
    return canon(streams.read_sessions(t.spark, f"{path}/sessions").select(
        "WorkType", "LocationPrimaryKey", "UserName", "SignInPrimaryKey", "SignOutPrimaryKey", "SignInTime", "SignOutTime"))
