"""Panel operators over long metric frames ``(job, metric, value)``."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

LONG_SCHEMA = StructType([StructField("job", StringType()), StructField("metric", StringType()),
                          StructField("value", DoubleType())])


def to_long(wide: DataFrame, job: str, metrics: Sequence[str] | None = None) -> DataFrame:
    """One-row (or few-row) wide metric frame -> long rows via UNPIVOT."""
    metrics = list(metrics or wide.columns)
    w = wide.select(*[F.col(m).cast("double").alias(m) for m in metrics])
    return (w.unpivot([], metrics, "metric", "value")
             .select(F.lit(job).alias("job"), "metric", "value"))


def metric_table(rows: DataFrame) -> DataFrame:
    """(as_of, job, metric, value) from the jobs' long rows (as_of, job, metric,
    value, job_ordinal): when two jobs emit the same metric for a day the later
    job wins — the dict-merge rule of the original panel.  Names are
    case-sensitive.  Aggregation, not a window: ``max_by`` on the job ordinal."""
    win = F.max_by(F.struct("job", "value"), "job_ordinal").alias("_w")
    return (rows.groupBy("as_of", "metric").agg(win)
            .select("as_of", F.col("_w.job").alias("job"), "metric", F.col("_w.value").alias("value")))


def targets_frame(spark: SparkSession, targets: dict) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in targets.items()], "target_key string, target double")


def target_attainment(metrics: DataFrame, targets: DataFrame, mapping: DataFrame,
                      default: float = 1.0) -> DataFrame:
    """Attainment rows: for each mapping row (att_metric, base_metric,
    target_key) whose base metric is in ``metrics``, value / target.  A target
    missing from the configuration divides by ``default`` (1).  ``targets``
    and ``mapping`` are configuration (tens of rows, a fixed bound), so they
    are broadcast; the metric side is the ~100-row panel."""
    m = metrics.withColumnRenamed("metric", "base_metric")
    j = (m.join(F.broadcast(mapping), "base_metric", "inner")
          .join(F.broadcast(targets), "target_key", "left"))
    keep = [c for c in metrics.columns if c not in ("metric", "value")]
    return j.select(*keep, F.col("att_metric").alias("metric"), "base_metric", "target",
                    F.try_divide(F.col("value"), F.coalesce(F.col("target"), F.lit(default))).alias("value"))


def day_over_day_change(df: DataFrame, keys: Sequence[str], day_col: str, value_col: str | None = None,
                        name: str = "dod", prev_value_col: str | None = None,
                        changes: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """value(d) - value(d-1) per key; NULL when day d-1 has no row.

    One change: ``value_col`` -> ``name`` (reading ``prev_value_col`` on the
    previous day, default ``value_col``).  Several: ``changes`` maps
    name -> (value column, previous-day column), all from one join.
    ``df`` is a daily frame (one row per key and day).  Each row is dealt to its
    own day and, with the values that the next day is compared with, to the day
    after; one aggregate by (keys, day) brings the two together.  So ``df`` is
    computed once, and no step needs all days of a key — or, without keys, the
    whole frame — in one task.  A null key or day is compared with nothing.
    """
    changes = dict(changes or {name: (value_col, prev_value_col or value_col)})
    old = list(dict.fromkeys(prev for _, prev in changes.values()))
    keep = [c for c in df.columns if c not in keys and c != day_col]
    kind = {f.name: f.dataType for f in df.schema.fields}

    def dealt(day, own: bool) -> list:
        none = [F.lit(None).cast(kind[c]).alias(c) for c in keep]
        return [day.alias(day_col), *([F.col(c).alias(c) for c in keep] if own else none),
                *[(F.lit(None).cast(kind[c]) if own else F.col(c)).alias(f"_old_{c}") for c in old], F.lit(own).alias("_own")]

    known = F.col(day_col).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    own, after = F.struct(*dealt(F.col(day_col), True)), F.struct(*dealt(F.date_add(F.col(day_col), 1), False))
    both = F.when(known, F.array(own, after)).otherwise(F.array(own))
    rows = df.select(*keys, F.explode(both).alias("_r")).select(*keys, "_r.*")
    one = rows.groupBy(*keys, day_col).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in [*keep, *[f"_old_{c}" for c in old]]], F.max("_own").alias("_own"))
    one = one.where("_own").withColumns({n: F.col(v) - F.col(f"_old_{prev}") for n, (v, prev) in changes.items()})
    return one.select(*df.columns, *changes)


def metric_completeness(metrics: DataFrame, expected: Sequence[tuple[str, str]]) -> DataFrame:
    """(as_of, job, metric, value, status): every expected (job, metric) of the
    catalogue for every day of ``metrics`` (as_of, metric, value): ok, null, or
    missing where the day has no such row.  The catalogue is configuration and is
    dealt to the days as a literal; days are joined with their own metrics."""
    kind = "array<struct<job:string,metric:string>>"
    every = F.from_json(F.lit(json.dumps([{"job": j, "metric": m} for j, m in expected])), kind)
    asked = metrics.select("as_of").distinct().select("as_of", F.explode(every).alias("e")).select("as_of", "e.*")
    m = metrics.select("as_of", "metric", "value", F.lit(True).alias("_present"))
    j = asked.join(m, ["as_of", "metric"], "left")
    status = (F.when(F.col("_present").isNull(), "missing")
               .when(F.col("value").isNull() | F.isnan(F.col("value")), "null")
               .otherwise("ok"))
    return j.select("as_of", "job", "metric", "value", status.alias("status"))
