"""Session helpers shared by queries, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where none is set and the master is local."""
    sc = spark.sparkContext
    found = sc._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = os.path.join(tempfile.gettempdir(), f"recordloom-{sc.applicationId}")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint, which survives the loss of an executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def local_session(cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("recordloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
