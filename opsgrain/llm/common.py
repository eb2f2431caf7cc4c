"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.session import checkpoint_dir

#: A side with at most so many rows may be broadcast (some tens of bytes a row).
BROADCAST_ROWS = 200_000

#: A stored table of known size has a file for every so many narrow rows.
FILE_ROWS = 100_000

#: Bytes of rows that go to a Python worker at a time where a row may have megabytes.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Writer options for rows that may have megabytes: a writer and a reader hold a
#: row group whole, and without them its size is first looked at after 100 rows.
WIDE_ROWS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/opsgrain-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: int) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage ends there, several readers share one computation, and no executor
    holds the only copy.  ``options`` are the writer's."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is computed inside sends ``BATCH_BYTES`` of rows and one more row to
    a Python worker at a time.  Spark's usual 64 MB are held by the executor in
    buffers that double, and by the worker, for every task at once."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has at most ``rows`` narrow rows, in no more partitions than
    so many rows need.  Where Spark does not itself merge small partitions, each
    becomes a file, and on a local file system every file costs its writer two
    processes (``chmod`` of it and of its checksum); while one starts, the
    executor's memory is seen twice.  Partitions of large tables stay."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else
    as it is, for a shuffle join.  ``df`` should be a stored table, because it
    is counted first."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` with a hint that both sides of its join are shuffled and merged.
    Spark takes a stored table to be as large as its compressed files, and the
    result of a Python step as large as its input, so what a step makes of many
    rows, or what compresses well, may look small enough to broadcast."""
    return df.hint("merge")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
