"""The newest partition of a stored snapshot, found in the file listing.

A full-snapshot dimension has one folder a day.  Only the names of those
folders are listed (one for each day of the calendar), newest first until one
holds data; only its files are listed and read then.
"""

from __future__ import annotations

import datetime as _dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_NULL = "__HIVE_DEFAULT_PARTITION__"


def partition_values(spark: SparkSession, path: str, part_col: str) -> list[tuple[str, str]]:
    """(value, folder) of the partitions directly below ``path``, newest first: dates and numbers
    by their order, other text by code points; the null partition is none."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{part_col}="):
            value = unquote(name[len(part_col) + 1:])
            if value != _NULL:
                found.append((value, status.getPath().toString()))
    return sorted(found, key=lambda f: _order(f[0]), reverse=True)


def _order(value: str) -> tuple:
    try:
        return 2, _dt.date.fromisoformat(value).toordinal(), value
    except ValueError:
        return (1, int(value), value) if value.lstrip("-").isdigit() else (0, 0, value)


def _has_data(spark: SparkSession, folder: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(not s.getPath().getName().startswith(("_", ".")) for s in files.listStatus(path))


def newest_partition(spark: SparkSession, path: str, part_col: str = "dt") -> str | None:
    """Folder of the newest partition that holds data; folders of writes that never ended are passed over."""
    return next((folder for _, folder in partition_values(spark, path, part_col) if _has_data(spark, folder)), None)


def read_latest(spark: SparkSession, path: str, part_col: str = "dt", schema: StructType | None = None) -> DataFrame:
    """The rows of the newest partition, its value as a column; no other folder is opened."""
    folder = newest_partition(spark, path, part_col)
    if folder is None:
        raise ValueError(f"{path} has no partition of {part_col} with data")
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema is not None else reader).parquet(folder)
