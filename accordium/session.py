"""Session settings used by the tests and the bench; on a cluster the caller's own session is used."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "accordium") -> SparkSession:
    """A local session with UTC time and adaptive execution."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ACCORDIUM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch(spark: SparkSession) -> str:
    """A new folder name below the one that driver and executors share: spark.checkpoint.dir. Only a local session, as in tests,
    may go without; elsewhere a folder of one machine would be lost to the others."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir isn't set")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = spark.sparkContext.getCheckpointDir()
    return f"{found.rstrip('/')}/{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, read back: it is made once, and outlives a lost executor."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A written table, to be broadcast where it has at most so many rows; beyond that Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= rows else df
