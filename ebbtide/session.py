"""Session defaults and the one place that decides where checkpoints go."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "ebbtide", memory: str = "12g") -> SparkSession:
    """A session for tests and the local benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints.

    ``spark.checkpoint.dir`` wins; a directory already set on the context comes
    next; only a session with neither (a test) gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    fresh = tempfile.mkdtemp(prefix="run-", dir="/tmp" if os.path.isdir("/tmp") else None)
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For inputs that several later passes read: the passes then cost a pruned scan
    each, and a lost executor replays from files instead of the whole upstream plan.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
