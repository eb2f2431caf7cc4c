"""Session helpers: a local session for tests/bench and the few settings the
library relies on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "opsgrain") -> SparkSession:
    """A local session configured the way the library expects (UTC, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Most bytes of shuffled rows that one task reads where Spark chooses the number of partitions.
TASK_BYTES = 16 << 20
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def ensure_small_tasks(spark: SparkSession) -> None:
    """Keys compress about tenfold in a shuffle, so a task that joins Spark's
    usual 64 MB of them sorts over 1 GB of rows.  A smaller setting stays."""
    if _bytes(spark.conf.get(ADVISORY)) > TASK_BYTES:
        spark.conf.set(ADVISORY, str(TASK_BYTES))


def ensure_utc(spark: SparkSession) -> None:
    """Warehouse timestamps are wall-clock values without a zone; reading them
    as UTC keeps date casts and millisecond differences zone-free."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read; a
    missing setting is an error there.  With a ``local`` master the driver and
    the tasks are one process on one machine, so a scratch folder serves.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="opsgrain-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured
