"""Per-key ordering: first event per key, and a full per-key sequence number.

Neither puts one key's rows into a single task:

* ``first_event_per_key`` is an aggregate (``min`` of a struct ordered by
  time then id), combined map-side before the shuffle (a struct buffer
  plans as a partial + final SortAggregate, which spills).
* ``event_sequence`` numbers rows per key without a window over all rows of a
  key.  A key's rows are cut into time buckets; rows are numbered within
  (key, bucket), and a table of row counts by (key, bucket), small beside the
  rows, gives each bucket the number of rows of its key in earlier ones.
  Both sides are computed from the input: nothing is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_event_per_key(df: DataFrame, key: str | Sequence[str], order: str, tie: str,
                        cols: Sequence[str] = ()) -> DataFrame:
    """One row per key: the earliest by (order, tie) — ROW_NUMBER() = 1 with a
    deterministic tie-break, computed as an aggregate."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = [order, tie] + [c for c in cols if c not in (order, tie)]
    best = F.min(F.struct(*[F.col(c) for c in payload])).alias("_first")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_first")[c].alias(c) for c in payload])


#: Time buckets: how many a day.
BUCKETS = {"day": 1, "hour": 24, "minute": 1440}


def time_bucket(order: str, unit: str) -> Column:
    """The bucket of a date or timestamp as a number that grows with it; nulls come first, as in an ascending sort."""
    minute = F.hour(F.col(order).cast("timestamp_ntz")) * 60 + F.minute(F.col(order).cast("timestamp_ntz"))
    of_day = F.floor(minute * BUCKETS[unit] / 1440) if unit != "day" else F.lit(0)
    bucket = F.unix_date(F.to_date(F.col(order))).cast("bigint") * BUCKETS[unit] + of_day
    return F.coalesce(bucket, F.lit(-(1 << 62)))


def event_sequence(df: DataFrame, key: str, order: str, tie: str, name: str = "seq", bucket: str | Column = "day") -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY key ORDER BY order, tie) for every row.

    ``order`` is a date or a timestamp.  ``bucket`` (day, hour or minute; for an
    ``order`` of another type a number that never falls as it rises) bounds what
    one task sorts: the rows of one key in one bucket.  The counts have one
    row for each key and bucket with rows; their running sum is the only window
    over a key.  A null key is a key of its own, as in a window."""
    rows = df.withColumn("_b", time_bucket(order, bucket) if isinstance(bucket, str) else bucket)
    counts = rows.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col(key).alias("_k"), F.col("_b").alias("_kb"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(key, "_b").orderBy(order, tie))
    rows = rows.withColumn("_within", within)
    out = rows.join(counts, rows[key].eqNullSafe(counts["_k"]) & rows["_b"].eqNullSafe(counts["_kb"]))
    return out.select(*df.columns, (F.col("_before") + F.col("_within")).cast("int").alias(name))
