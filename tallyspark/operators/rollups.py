"""Aggregation operators.  All are ``groupBy().agg()`` compositions, so Spark
runs them as partial (map-side) + final aggregates: a key holding a third of
the rows is combined inside every map task before the shuffle."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import col, flag, safe_div


def daily_rollup(df: DataFrame, keys: Sequence[str], measures: dict[str, str | Column],
                 exact: bool = True) -> DataFrame:
    """SUM of each measure by ``keys``.  Integer sums stay bigint, decimal sums
    stay exact (decimal) until a ratio needs a double."""
    return df.groupBy(*keys).agg(*[F.sum(col(src)).alias(name) for name, src in measures.items()])


def funnel_ratio(df: DataFrame, ratios: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Add ``name = num / den`` columns (NULL on a zero or NULL denominator)."""
    return df.withColumns({name: safe_div(num, den) for name, num, den in ratios})


def flag_rate(df: DataFrame, keys: Sequence[str], flag_col, name: str = "rate") -> DataFrame:
    """AVG of a 0/1 flag by keys (NULL flags are ignored, like SQL AVG)."""
    return df.groupBy(*keys).agg(F.avg(col(flag_col)).alias(name))


def conditional_rate(df: DataFrame, keys: Sequence[str], flag_col, where: Column,
                     name: str = "rate") -> DataFrame:
    """AVG(CASE WHEN where THEN flag ELSE NULL END) by keys."""
    return df.groupBy(*keys).agg(F.avg(F.when(where, col(flag_col))).alias(name))


def conditional_count(df: DataFrame, keys: Sequence[str], conds: dict[str, Column]) -> DataFrame:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) per named condition."""
    return df.groupBy(*keys).agg(*[F.sum(flag(c)).cast("bigint").alias(n) for n, c in conds.items()])


def weighted_ratio(df: DataFrame, keys: Sequence[str], value, weight, name: str = "wratio",
                   scale: float | None = None) -> DataFrame:
    """Sum(value * weight) / Sum(weight), sums exact in decimal; optional unit
    scale (e.g. periods -> days)."""
    num = F.sum(col(value) * col(weight))
    den = F.sum(col(weight))
    r = safe_div(num, den)
    if scale is not None:
        r = r * F.lit(float(scale))
    return df.groupBy(*keys).agg(r.alias(name), den.cast("double").alias(f"{name}_weight"))


def amount_to_count_ratio(df: DataFrame, keys: Sequence[str], flag_col, weight,
                          name: str = "amt_to_cnt") -> DataFrame:
    """(amount-weighted rate) / (plain rate) of a 0/1 flag."""
    f, w = col(flag_col), col(weight)
    amt = safe_div(F.coalesce(F.sum(F.when(f == 1, w)), F.lit(0)), F.sum(w))
    cnt = F.avg(f.cast("double"))
    return df.groupBy(*keys).agg(amt.alias(f"{name}_amount_rate"), cnt.alias(f"{name}_count_rate"),
                                 F.try_divide(amt, cnt).alias(name))


def mtd_cumulative(df: DataFrame, date_col: str, keys: Sequence[str],
                   measures: dict[str, str]) -> DataFrame:
    """Month-to-date running totals of a daily frame: SUM over
    (partition by keys, month order by day).  ``df`` is already aggregated to
    one row per day and key, so each window partition holds at most 31 rows."""
    w = (Window.partitionBy(*keys, F.trunc(F.col(date_col), "month"))
         .orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({name: F.sum(col(src)).over(w) for name, src in measures.items()})
