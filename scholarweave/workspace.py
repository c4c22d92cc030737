"""Sessions and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own.

    Its shared folder is removed when the process ends.
    """
    shared = tempfile.mkdtemp(prefix="scholarweave-")
    atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("scholarweave")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall
    back to a temporary folder. Anywhere else the setting is required, because
    a machine-local path would not outlive the executor that wrote it. What is
    written there belongs to one run and may be expired afterwards.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="scholarweave-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one table of one run."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage of iterative jobs and pins rows whose content depends
    on how they were partitioned. The files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
