"""Session helpers: building a session for tests and bench, shared scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FALLBACK_DIR: str | None = None


def get_session(master: str | None = None, partitions: int = 8, app: str = "riskframe") -> SparkSession:
    """Session for tests and local runs. On a cluster, build your own session."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # local mode: the driver JVM is the executor; only effective before the JVM starts
        .config("spark.driver.memory", os.environ.get("RISKFRAME_DRIVER_MEMORY", "8g"))
    )
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session. Unset, a private folder serves a local master (tests); on
    a cluster, whose machines don't share folders, that raises.
    """
    global _FALLBACK_DIR
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if _FALLBACK_DIR is None:
            _FALLBACK_DIR = tempfile.mkdtemp(prefix="riskframe-ckpt-")
        root = _FALLBACK_DIR
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/riskframe-scratch/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` as files of the shared folder, in folders by one column if asked: read as often as needed, made
    once; columns are compressed, and Spark knows the size, so that small tables are broadcast by it."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
