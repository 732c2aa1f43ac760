"""Session helpers: a local session for tests and the lineage cut used by iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Broadcast budget (bytes) that every explicit broadcast in the library is checked against.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(app: str = "casewright", cpus: str = "*", shuffle_partitions: int = 8, more: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the benchmark, with a new folder for intermediate tables. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='run-casewright-')}")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CASEWRIGHT_DRIVER_MEMORY", "8g"))
        .config(map=more or {})
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_OWN_FOLDERS: dict[str, str] = {}


def _shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a session in one process (a test) gets a folder of its own; a cluster must set it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = f"file://{tempfile.mkdtemp(prefix='run-casewright-')}"
    return _OWN_FOLDERS[app]


def intermediate_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{_shared_folder(spark)}/casewright-{uuid.uuid4().hex}.{kind}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, so a lost executor never restarts a loop.

    A written table is used rather than ``checkpoint()``: a checkpointed frame keeps the constraints of its
    plan, which multiply in a loop until planning stalls, and a table also brings true sizes for join choices.
    """
    spark = df.sparkSession
    path = intermediate_path(spark, "parquet")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return cut_lineage(left.unionByName(right))


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
