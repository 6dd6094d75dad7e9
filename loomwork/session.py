"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(cpus: int | str = "*", shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loomwork")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster that is an
    error, as a folder of one machine would lose data.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext.getCheckpointDir()
    if not path and not current and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not path:
        path = current or tempfile.mkdtemp(prefix="loomwork-")
        if not current:
            atexit.register(shutil.rmtree, path, ignore_errors=True)
    if not current:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage with a reliable checkpoint, which outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip(os.sep)}/{table}.parquet")
