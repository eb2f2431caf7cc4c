"""Truncate-and-insert tables that readers never see half written.

A published table is a folder of versions and a small table of pointers.  A
writer first writes a whole new version, then appends one pointer row; the
pointer's file appears in one rename, so a reader takes either the old version
or the new one.  A writer that dies before its pointer leaves the old version
in force, and a retry writes another version.  Old versions stay for readers
that began with them; ``versions_to_drop`` lists those that nobody new reads.
One writer at a time is assumed, as for the source's job.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "Seq bigint, Version string"


def _pointers(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(POINTER).parquet(f"{path}/pointers")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POINTER)


def publish(df: DataFrame, path: str) -> str:
    """Replace the table's content; returns the new version's name."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{version}")
    last = _pointers(spark, path).agg(F.coalesce(F.max("Seq"), F.lit(0))).first()[0]
    spark.createDataFrame([(last + 1, version)], POINTER).coalesce(1).write.mode("append").parquet(f"{path}/pointers")
    return version


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version in force; an error if nothing was published yet."""
    version = _pointers(spark, path).agg(F.max_by("Version", F.struct("Seq", "Version"))).first()[0]
    if version is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/versions/{version}")


def versions_to_drop(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Published versions but the newest ``keep``."""
    rows = _pointers(spark, path).orderBy(F.col("Seq").desc(), F.col("Version").desc()).collect()  # one row a run of the job
    return [r["Version"] for r in rows[keep:]]
