"""Parquet table access.

Every read names its columns, so the scan's ``ReadSchema`` holds only what a
role needs, and filters written on raw columns reach ``PushedFilters``.
"""

from __future__ import annotations

import os
import threading
import weakref

from pyspark.sql import DataFrame, SparkSession

# Footers read by this process, by session: entries go with the session's object.
_CACHE: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_CACHE_LOCK = threading.Lock()


def _stamp(path: str):
    """(mtime, size) of a local file or directory; None elsewhere (remote
    file systems are not cached)."""
    try:
        st = os.stat(path)
    except OSError:
        return None
    return st.st_mtime_ns, st.st_size

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


class TableSource:
    """Reads ``<root>/<name>.parquet`` (a file or a directory of parts)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def _load(self, name: str) -> DataFrame:
        # Schema inference reads the footer on the driver (~0.2 s per table);
        # a table unchanged since the last read of this session reuses it.
        path = self.path(name)
        stamp = _stamp(path)
        if stamp is None:
            return self.spark.read.parquet(path)
        key = (os.path.abspath(path), stamp)
        with _CACHE_LOCK:
            schema = _CACHE.setdefault(self.spark, {}).get(key)
        if schema is None:
            schema = self.spark.read.parquet(path).schema
            with _CACHE_LOCK:
                _CACHE[self.spark][key] = schema
        return self.spark.read.schema(schema).parquet(path)

    def read(self, name: str, columns: list[str] | None = None) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        df = self._frames[name]
        return df.select(*columns) if columns else df
