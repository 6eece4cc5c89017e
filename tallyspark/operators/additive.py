"""Additive daily partials and their merge into the figures of many reporting days.

A partial row says: on ``day``, in segment ``seg``, job ``job`` measured
``value`` of ``measure``.  Values are sums and counts, exact decimals, so any
period's figure is a sum of partials.  What a figure sums is a *term*: a measure
of a job, a segment condition and a window relative to the reporting day.

``merge`` joins the partials with the terms, deals each to the reporting days
whose window holds its day, and sums by (reporting day, term).  Partials are few
(days by segments by measures); nothing here reads source rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VALUE = "decimal(38,4)"
SCHEMA = f"job string, day date, seg map<string,string>, measure string, value {VALUE}"


def partials(job: str, daily: DataFrame, day: str, segments: Iterable[str], measures: Mapping[str, Column | str],
             span: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """The partial rows of a daily frame (any number of rows a day and segment); null measures are no rows.
    ``span``: only these days, both included."""
    segments, measures = list(segments), dict(measures)
    if span is not None:
        daily = daily.where(F.col(day).between(F.lit(span[0]), F.lit(span[1])))
    seg = (F.create_map(*[x for s in segments for x in (F.lit(s), F.coalesce(F.col(s).cast("string"), F.lit("")))])
           if segments else F.create_map().cast("map<string,string>"))
    cells = F.array(*[F.struct(F.lit(name).alias("measure"), (F.col(c) if isinstance(c, str) else c).cast(VALUE).alias("value"))
                      for name, c in measures.items()])
    return (daily.select(F.lit(job).alias("job"), F.col(day).alias("day"), seg.alias("seg"), F.explode(cells).alias("c"))
            .select("job", "day", "seg", F.col("c.measure").alias("measure"), F.col("c.value").alias("value"))
            .where("value is not null and day is not null"))


class Terms:
    """The terms that formulas use.  Calling it registers a term and gives the column of its sum
    (null where no partial falls into it).

    ``at``: a number of days before the reporting day, ``"mtd"`` (from the month's
    first day to the reporting day) or ``"open"`` (from the month's first day on)."""

    def __init__(self):
        self.rows: dict[str, tuple] = {}

    def __call__(self, job: str, measure: str, at: int | str = 0, **seg: str) -> Column:
        key = f"{job}/{measure}/{at}/" + ",".join(f"{k}={v}" for k, v in sorted(seg.items()))
        back = at if isinstance(at, int) else None
        self.rows[key] = (key, job, measure, at if isinstance(at, str) else "back", back, {k: str(v) for k, v in seg.items()})
        return F.col("t").getItem(key)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows.values()),
                                     "term string, job string, measure string, window string, back int, want map<string,string>")

    def reach(self, job: str, day: _dt.date, as_ofs: Iterable[_dt.date]) -> set[_dt.date]:
        """The reporting days that a partial of ``day`` counts in."""
        out, as_ofs = set(), list(as_ofs)
        for window, back in {(w, b) for _, of, _, w, b, _ in self.rows.values() if of == job}:
            for a in as_ofs:
                if (window == "back" and a - day == _dt.timedelta(days=back)) \
                        or (window == "mtd" and a.replace(day=1) <= day <= a) or (window == "open" and a.replace(day=1) <= day):
                    out.add(a)
        return out


def merge(parts: DataFrame, terms: Terms, as_ofs: Iterable[_dt.date]) -> DataFrame:
    """(as_of, t): for each reporting day the map from terms to their sums.  Days without any partial have an empty map."""
    spark, as_ofs = parts.sparkSession, sorted(set(as_ofs))
    days = F.array(*[F.lit(a) for a in as_ofs])
    # the terms are configuration, as many as the formulas use: broadcast
    j = parts.join(F.broadcast(terms.frame(spark)), ["job", "measure"])
    j = j.where(F.forall(F.map_entries("want"), lambda e: F.col("seg")[e["key"]] == e["value"]))

    def holds(a: Column) -> Column:
        start = F.trunc(a, "MM")
        return (F.when(F.col("window") == "back", F.date_add(F.col("day"), F.col("back")) == a)
                .when(F.col("window") == "mtd", (F.col("day") >= start) & (F.col("day") <= a))
                .otherwise(F.col("day") >= start))

    dealt = j.select("term", "value", F.explode(F.filter(days, holds)).alias("as_of"))
    sums = dealt.groupBy("as_of", "term").agg(F.sum("value").alias("value"))
    # one entry a term: bounded by the formulas
    maps = sums.groupBy("as_of").agg(F.map_from_entries(F.collect_list(F.struct("term", F.col("value").cast(VALUE).alias("value")))).alias("m"))
    asked = spark.createDataFrame([(a,) for a in as_ofs], "as_of date")
    return asked.join(maps, "as_of", "left").select("as_of", F.coalesce("m", F.create_map().cast(f"map<string,{VALUE}>")).alias("t"))
