"""Session settings the plans rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", cores: str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and benchmarks; clusters pass their own session to the plans."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        # naming the call site of every column expression doubles the time to build a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # the feature plan alone generates more classes than the default cache of 100 holds
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.unionOutputPartitioning", "false")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """The session settings that plans need: instants in UTC, and unions that claim no partitioning (see ``stack_rows``).

    Joins may also keep a side where it lies if it is partitioned by some of the keys: the blocks of ``operators.shared`` rely on it.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for an unset local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so losing an executor re-reads, not recomputes.

    With a ``name`` the folder is always the same and overwritten, so work that repeats for ever leaves one folder.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}" if name else scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
