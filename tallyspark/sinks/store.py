"""A stored table whose keys (days, or jobs and days) are replaced as wholes.

``data/run=<id>/`` holds what each run wrote, ``commits/`` one small file a
commit: which keys the run holds and with how many rows.  A run's data is
written first; the commit file, moved into place as its last step, makes all of
its keys current at once.  Readers take, for each key, the rows of the last run
that committed it: they see a key before or after a commit, never parts of it.
A write that dies leaves a run without a commit, which nobody reads; writing
again makes another run.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import path_exists, remove_path


class IncompleteStore(RuntimeError):
    """A committed key no longer has the rows that its commit counted."""


class KeyedStore:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("as_of",)):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.data, self.log = f"{self.path}/data", f"{self.path}/commits"

    def exists(self) -> bool:
        return path_exists(self.spark, self.log)

    # ---- writing
    def write(self, df: DataFrame) -> str:
        """Write ``df`` as a run that nobody reads yet; its id."""
        run = uuid.uuid4().hex
        df.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(self.data)
        return run

    def commit(self, run: str, announced: DataFrame | None = None) -> None:
        """Make the run's keys current; ``announced`` keys without a row in it become empty."""
        counts = self._rows_of(run).groupBy(*self.keys).agg(F.count(F.lit(1)).alias("rows"))
        if announced is not None:
            asked = announced.select(*self.keys).distinct().withColumn("rows", F.lit(0).cast("bigint"))
            counts = counts.union(asked).groupBy(*self.keys).agg(F.max("rows").alias("rows"))
        last = self.commits().agg(F.max("seq")).first()[0] if self.exists() else None  # one number
        (counts.withColumn("run", F.lit(run)).withColumn("seq", F.lit((last or 0) + 1).cast("bigint"))
         .coalesce(1).write.mode("append").parquet(self.log))  # one row a key

    def replace(self, df: DataFrame, announced: DataFrame | None = None) -> str:
        run = self.write(df)
        self.commit(run, announced)
        return run

    # ---- reading
    def _rows_of(self, run: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.data}/run={run}"):  # a run without rows has no folder
            return self.spark.read.schema(self.spark.read.parquet(self.data).schema).parquet(self.data).where("false")
        return self.spark.read.parquet(self.data).where(F.col("run") == run)

    def commits(self) -> DataFrame:
        return self.spark.read.parquet(self.log)

    def current(self) -> DataFrame:
        """(keys, run, rows): the last commit of each key; of commits side by side the one with the larger run id."""
        last = F.max_by(F.struct("run", "rows"), F.struct("seq", "run")).alias("c")
        return self.commits().groupBy(*self.keys).agg(last).select(*self.keys, "c.run", "c.rows")

    def read(self) -> DataFrame:
        """The current rows of every key.  The runs that hold none are pruned as partitions."""
        now = self.current().select(*self.keys, "run")
        every = self.spark.read.parquet(self.data)
        return every.join(now, [*self.keys, "run"]).select(*[c for c in every.columns if c != "run"])

    def check(self) -> DataFrame:
        """(keys, rows, found) of the keys whose rows aren't those that were committed."""
        found = self.read().groupBy(*self.keys).agg(F.count(F.lit(1)).alias("found"))
        j = self.current().select(*self.keys, "rows").join(found, self.keys, "left")
        return j.select(*self.keys, "rows", F.coalesce("found", F.lit(0)).alias("found")).where("rows <> found")

    def verified(self) -> DataFrame:
        """``read``, or an error where committed rows are lost."""
        lost = self.check().limit(5).collect()
        if lost:
            raise IncompleteStore(f"{self.path}: {[r.asDict() for r in lost]}")
        return self.read()

    def vacuum(self) -> int:
        """Delete the data of runs that hold no current key.  Not while a run is being written."""
        have = self.spark.read.parquet(self.data).select("run").distinct()
        dead = [r[0] for r in have.join(self.current().select("run"), "run", "left_anti").collect()]  # run ids
        for run in dead:
            remove_path(self.spark, f"{self.data}/run={run}")
        return len(dead)
