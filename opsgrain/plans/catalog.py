"""Registry of build items as runnable queries plus their DuckDB oracles.

Each entry maps a key ``<id>_<name>`` to (spark_fn(Tables) -> DataFrame,
oracle SQL or None).  Query outputs are put in a canonical form for the
comparison (dates and timestamps as ISO text, decimals as double, integers as
bigint); the library functions themselves return the source's types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.oracle.adapter_sql import adapter_ctes

SparkFn = Callable[[object], DataFrame]

REGISTRY: dict[str, tuple[SparkFn, str | None]] = {}
CTES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: SparkFn) -> SparkFn:
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def add_ctes(ctes: dict[str, str]) -> None:
    for k, v in ctes.items():
        if k in CTES and CTES[k] != v:
            raise ValueError(f"duplicate CTE {k}")
        CTES[k] = v


def materialized(t, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build a derived table once per table catalogue, write it as parquet
    under the session's ``spark.checkpoint.dir`` (shared storage on a cluster),
    and return a reader of that table.

    Used for the grains that many pages, measures and gates read (the event
    grains, the daily grain, the roll-ups, throughput, de-duplicated
    telemetry): readers scan a columnar table with column pruning and
    statistics-based filtering instead of re-running the matching pipeline,
    the lineage is cut, and a lost executor cannot lose the table."""
    cached = t.__dict__.get(key)
    if cached is None:
        df = build()
        if getattr(t, "materialize", True):
            import os
            import uuid
            from opsgrain.session import checkpoint_dir
            spark = df.sparkSession
            path = os.path.join(checkpoint_dir(spark), "opsgrain-tables", f"{key.strip('_')}-{uuid.uuid4().hex}")
            df.write.mode("overwrite").parquet(path)
            df = spark.read.parquet(path)
        cached = t.__dict__[key] = df
    return cached


def canon(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def sel(spec: str) -> str:
    """SQL select list from 'name:kind, ...' (kinds: i bigint, d double, s text,
    D date text, T timestamp text, u 1e-4 units -> double, b boolean, x as is)."""
    parts = []
    for item in [s.strip() for s in spec.split(",") if s.strip()]:
        name, _, kind = item.partition(":")
        kind = kind or "x"
        if kind == "i":
            parts.append(f"cast({name} as bigint) as {name}")
        elif kind == "d":
            parts.append(f"cast({name} as double) as {name}")
        elif kind == "s":
            parts.append(f"cast({name} as varchar) as {name}")
        elif kind == "D":
            parts.append(f"strftime({name}, '%Y-%m-%d') as {name}")
        elif kind == "T":
            parts.append(f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') as {name}")
        elif kind == "u":
            parts.append(f"cast({name}_u as bigint) / 10000 as {name}")
        elif kind == "b":
            parts.append(f"cast({name} as boolean) as {name}")
        else:
            parts.append(name)
    return ", ".join(parts)


def oracle(final_select: str) -> str:
    """Full oracle text: adapter CTEs + all registered view CTEs + final query.
    DuckDB evaluates only the CTEs the final query reaches."""
    ctes = [adapter_ctes()] + [f"{k} AS (\n{v}\n)" for k, v in CTES.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + final_select


def oracle_texts() -> dict[str, str]:
    return {k: oracle(sql) for k, (_, sql) in REGISTRY.items() if sql is not None}
