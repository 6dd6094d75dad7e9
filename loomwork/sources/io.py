"""Readers and writers with explicit schemas; any Hadoop file system by its URI, credentials by configuration only."""

from __future__ import annotations

import json
import logging
import os
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions import cleaning as C

RAW_LISTS = ["sourceNames", "brands", "houseNumber", "streets", "cities", "postalCode", "rawCategories", "insertedCategories", "preemptiveCategories"]
RAW = T.StructType([T.StructField(c, T.StringType()) for c in ["placeId", "clusterId", "locality", "officialName", "supplier", *RAW_LISTS, "latitude", "longitude", "phoneNumbers", "internet", "email"]])
#: Both ways: quotes doubled, blanks kept; an empty cell is a null, so an empty text comes back as one.
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV).option("multiLine", True).csv(path)


def read_raw_places(spark: SparkSession, path: str, multilingual: bool = False) -> DataFrame:
    """The raw table, with list cells parsed into arrays."""
    scripts = ["script_names", "script_streets", "script_city"] if multilingual else []
    df = read_csv(spark, path, T.StructType([*RAW.fields, *[T.StructField(c, T.StringType()) for c in scripts]]))
    df = df.withColumns({c: C.parse_list(df[c]) for c in [*RAW_LISTS, *scripts]})
    return df.withColumns({"latitude": C.parse_doubles(df["latitude"]), "longitude": C.parse_doubles(df["longitude"]), "phoneNumbers": C.process_phone(df["phoneNumbers"])})


def read_parquet(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def rows_per_file(rows: Column, most: int = 2_000_000) -> Column:
    """Rows of each file of a table: a quarter while that is under ``most``, else as few parts of 8, 12, 16, ... as bring it under."""
    parts = F.greatest(F.lit(8), 4 * F.ceil((F.floor(rows / most) + 1) / 4))
    return F.when(F.floor(rows / 4) < most, F.floor(rows / 4)).otherwise(F.floor(rows / parts)).cast("long")


def write_parquet(df: DataFrame, path: str, rows: int = 4_000_000) -> None:
    df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_vectors(df: DataFrame, path: str, id_col: str = "Id", vec_col: str = "vector") -> None:
    """Stored embeddings: an id and an array of floats a row."""
    write_parquet(df.select(F.col(id_col).cast("long").alias("Id"), F.col(vec_col).cast("array<float>").alias("vector")), path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("Id long, vector array<float>").parquet(path)


def read_excel(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """A hand-labelled sheet; small by nature, read by the driver where a reader library is installed."""
    import pandas as pd

    return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet))


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def make_path(spark: SparkSession, path: str) -> str:
    """The folder, made with its parents."""
    fs, p = _path(spark, path)
    fs.mkdirs(p)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder on its own file system; ValueError if there is none."""
    fs, p = _path(spark, path)
    if not fs.delete(p, True):
        raise ValueError(f"{path} is no file or folder")


def copy_path(spark: SparkSession, source: str, target: str) -> str:
    """Copies one object or folder between any two file systems: download, upload, backup."""
    (from_fs, from_path), (to_fs, to_path) = _path(spark, source), _path(spark, target)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, from_path, to_fs, to_path, False, conf):
        raise OSError(f"{source} was not copied to {target}")
    return target


def archive(spark: SparkSession, source: str, folder: str, day: date | None = None) -> str:
    """A dated copy of a source, kept before a new version is written to a new path."""
    stem, dot, ending = os.path.basename(source.rstrip("/")).rpartition(".")
    return copy_path(spark, source, f"{make_path(spark, folder)}/{stem}_{(day or date.today()):%d_%m_%Y}{dot}{ending}")


def list_models(spark: SparkSession, folder: str, families: tuple[str, ...]) -> dict[str, list[dict]]:
    """Tree ensembles by family: every ``<family>*.json`` of a folder in the order of names, read by the driver (models are small)."""
    out = {}
    for family in families:
        files = spark.read.text(f"{folder.rstrip('/')}/{family}*.json", wholetext=True).select("value", F.input_file_name().alias("name"))
        out[family] = [json.loads(r["value"]) for r in files.orderBy("name").collect()]
    return out


def log_helper(name: str, country: str, folder: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """The driver's log of one step and country; with ``folder`` also a dated file ``folder/country/country_<date>/name_<date>.log``."""
    log = logging.getLogger(f"loomwork.{country}.{name}")
    log.setLevel(level)
    if folder:
        day = f"{date.today():%d_%m_%Y}"
        where = os.path.join(folder, country, f"{country}_{day}")
        os.makedirs(where, exist_ok=True)
        file = os.path.join(where, f"{name}_{day}.log")
        if not any(getattr(h, "baseFilename", None) == os.path.abspath(file) for h in log.handlers):
            handler = logging.FileHandler(file)
            handler.setFormatter(logging.Formatter("%(asctime)s - %(name)s - %(levelname)s - %(message)s"))
            log.addHandler(handler)
        log.propagate = False
    return log


@contextmanager
def timer(title: str, log: logging.Logger) -> Iterator[dict[str, float]]:
    """Logs how long a step took and by how much the driver's memory grew; the executors' figures are in Spark's event log."""
    import resource

    took: dict[str, float] = {}
    began, memory = time.perf_counter(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    try:
        yield took
    finally:
        took |= {"seconds": time.perf_counter() - began, "megabytes": (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - memory) / 1024}
        log.info("%s: %.3f s, %+.1f MB", title, took["seconds"], took["megabytes"])
