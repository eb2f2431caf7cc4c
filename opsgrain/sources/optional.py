"""Optional sources: tables that an installation may not have.

``optional`` gives a source's rows in the wanted types, or an empty relation of
those types if its path does not exist; ``OptionalSources`` reads several and
tells which were there.  Only an absent path counts as absent: any other error
is raised."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet table at ``path`` with the columns of ``schema`` (one that
    the table lacks is null), or None if there is none."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return df.select(*((F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


class OptionalSources:
    """Sources by name, at paths that may not exist, of one schema."""

    def __init__(self, spark: SparkSession, paths: dict[str, str], schema: T.StructType):
        found = {name: optional(spark, path, schema) for name, path in paths.items()}
        self.present = {name: df is not None for name, df in found.items()}
        self.tables = {name: spark.createDataFrame([], schema) if df is None else df for name, df in found.items()}
        self.spark = spark

    def status(self) -> DataFrame:
        """One row a source: whether it is there, and its rows."""
        out = None
        for name, df in self.tables.items():
            row = df.agg(F.count(F.lit(1)).alias("Rows")).select(F.lit(name).alias("Source"), F.lit(self.present[name]).alias("Present"), "Rows")
            out = row if out is None else out.unionAll(row)
        return out if out is not None else self.spark.createDataFrame([], "Source string, Present boolean, Rows bigint")
