"""Period operators: day filters, latest snapshot, slices of a daily frame."""

from __future__ import annotations

import datetime as _dt
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tallyspark.functions import col


def _is_ts(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType))


def day_between(df: DataFrame, c: str, lo: _dt.date | None, hi: _dt.date | None) -> Column:
    """Inclusive day range on column ``c`` (a date or a timestamp).  On a
    timestamp it is written as a half-open range on the raw column, so the
    parquet reader gets it as a pushed filter and row groups are skipped.
    Bounds are DATE literals (cast to the column's timestamp type by Spark):
    no Python datetime, so the cut does not depend on the session or the
    client time zone."""
    x = F.col(c)
    conds = []
    if _is_ts(df, c):
        if lo is not None:
            conds.append(x >= F.lit(lo))
        if hi is not None:
            conds.append(x < F.lit(hi + _dt.timedelta(days=1)))
    else:
        if lo is not None:
            conds.append(x >= F.lit(lo))
        if hi is not None:
            conds.append(x <= F.lit(hi))
    out = F.lit(True)
    for cond in conds:
        out = out & cond
    return out


def day_in(df: DataFrame, c: str, days: Iterable[_dt.date]) -> Column:
    """Rows whose day is one of ``days``.  Written as an OR of per-day
    conditions rather than ``IN``: Catalyst unwraps ``to_date(ts) = d`` (and a
    raw range) into a pushed parquet filter, but not ``to_date(ts) IN (...)``."""
    out = None
    for d in sorted(set(days)):
        cond = day_between(df, c, d, d) if _is_ts(df, c) else (F.col(c) == F.lit(d))
        out = cond if out is None else out | cond
    return out if out is not None else F.lit(False)


def period_filter(df: DataFrame, date_col: str, as_of: _dt.date, kind: str = "mtd",
                  n: int | None = None, days: Iterable[_dt.date] | None = None,
                  part: str | None = None, until: _dt.date | None = None) -> DataFrame:
    """Keep rows of a reporting period relative to ``as_of``.

    ``part`` names a partition column that holds the day of ``date_col`` (the
    role's contract): the same days are cut on it too, so that only their
    partitions are read.  With ``until`` the period is that of all reporting days
    from ``as_of`` to ``until``, as one range.

    kind: ``mtd`` month start .. as_of; ``open_mtd`` month start .. (no end);
    ``trailing`` as_of-n .. as_of; ``two_day`` as_of-1, as_of;
    ``days`` an explicit list; ``since`` as_of-n .. (no end).
    """
    days = list(days) if days is not None else None
    until = None if until == as_of else until
    cond = _period(df, date_col, as_of, kind, n, days, until)
    if part is not None:
        cond = cond & _period(df, part, as_of, kind, n, days, until)
    return df.filter(cond)


def _period(df: DataFrame, date_col: str, as_of: _dt.date, kind: str, n: int | None, days: list | None,
            until: _dt.date | None) -> Column:
    ms, last = as_of.replace(day=1), until or as_of
    if kind == "mtd":
        return day_between(df, date_col, ms, last)
    if kind == "open_mtd":
        return day_between(df, date_col, ms, None)
    if kind == "trailing":
        return day_between(df, date_col, as_of - _dt.timedelta(days=n), last)
    if kind == "since":
        return day_between(df, date_col, as_of - _dt.timedelta(days=n), None)
    if kind == "two_day":
        days = [as_of, as_of - _dt.timedelta(days=1)]
    elif kind != "days":
        raise ValueError(kind)
    if until is not None:  # each day of the list moves along with the reporting day
        return day_between(df, date_col, min(days), max(days) + (last - as_of))
    return day_in(df, date_col, days)


# ---------------------------------------------------------------- slices
def _value(v, cond: Column) -> Column:
    return F.when(cond, col(v))


def slice_sum(v, cond: Column) -> Column:
    """Sum over the rows of a slice; none, or only NULLs -> 0."""
    return F.coalesce(F.sum(_value(v, cond)), F.lit(0))


def slice_max(v, cond: Column) -> Column:
    """Largest value of a slice; none -> NULL."""
    return F.max(_value(v, cond))


def slice_mean(v, cond: Column) -> Column:
    """Mean of a slice; none -> NULL."""
    return F.avg(_value(v, cond))


def slice_pick(v, cond: Column, empty) -> Column:
    """Value of a slice's single row; ``empty`` where there is no row or its value is NULL."""
    one = F.max(_value(v, cond))
    return one if empty is None else F.coalesce(one, F.lit(empty))


REDUCERS = {"sum": slice_sum, "max": slice_max, "mean": slice_mean, "pick": slice_pick}


def latest_snapshot(df: DataFrame, part_col: str = "dt") -> DataFrame:
    """Rows of the latest snapshot partition: ``part = (select max(part))``, a
    scan of the partition column over every snapshot.  For frames whose
    partitions can't be listed; ``Roles.latest`` takes the newest partition of a
    stored role from the file listing instead."""
    latest = df.select(F.max(part_col)).scalar()
    return df.filter(F.col(part_col) == latest)


def slice_at(df: DataFrame, day_col: str, at: _dt.date, specs: dict[str, tuple],
             where: Column | None = None) -> DataFrame:
    """One-row frame of reductions over slices of a daily frame: the rows of day
    ``at``, or ``back`` days before it, and of ``where``.

    ``specs`` maps an output name to ``(column, reducer)``, ``(column, reducer,
    empty)`` or ``(column, reducer, empty, back)``; reducers are those of
    ``REDUCERS`` (``empty`` is for ``pick``).  The days that the reductions read
    are a filter below the aggregate.  As the day of a daily frame is a grouping
    key, Catalyst takes that filter through the frame's own aggregate down to the
    scan: a slice of one day reads one day."""
    back = {name: (spec[3] if len(spec) > 3 else 0) for name, spec in specs.items()}
    days = {name: at - _dt.timedelta(days=b) for name, b in back.items()}
    cut = df.filter(day_in(df, day_col, days.values()))
    aggs = []
    for name, spec in specs.items():
        sel = F.col(day_col) == F.lit(days[name])
        if where is not None:
            sel = sel & where
        empty = (spec[2] if len(spec) > 2 else None,) if spec[1] == "pick" else ()
        aggs.append(REDUCERS[spec[1]](spec[0], sel, *empty).cast("double").alias(name))
    return cut.agg(*aggs)
