"""Refresh of the stored panel when source rows arrive, late ones included.

Two keyed stores stand behind it (``sinks.store``): the additive partials by
(job, day) and the panel by reporting day.  A changed source day is expanded
twice: by ``partials.DEPENDS`` to the partial days of each job that read it, and
by the formulas' own windows (month to date, 1, 2, 3, 6 and 7 days back) to the
reporting days that use those partials.  Only these are computed again; each is
replaced as a whole.

``daily_refresh`` runs it as a stream: the source folder is a file source whose
checkpoint remembers the files that were taken, and each trigger refreshes what
the new files' days touch.  A repeated trigger computes the same keys again and
replaces them by equal rows.  The driver sees days, jobs and run ids only.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable, Iterable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.params import Params
from tallyspark.plans.formulas import panel_of_days, touched
from tallyspark.plans.jobs import JOBS
from tallyspark.plans.panel import sink_panel
from tallyspark.plans.partials import END, OPEN_JOB, daily_partials, stale_partials
from tallyspark.session import ensure_checkpoint_dir
from tallyspark.sinks.store import KeyedStore

DAY = _dt.timedelta(days=1)
JOB_NAMES = [name for name, _, _ in JOBS]


def _days(first: _dt.date, last: _dt.date) -> list[_dt.date]:
    return [first + i * DAY for i in range((last - first).days + 1)]


class PanelStores:
    """The stored partials and the stored panel below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.partials = KeyedStore(spark, f"{path}/partials", ["job", "day"])
        self.panel_path = f"{path}/panel"
        self.panel = KeyedStore(spark, self.panel_path, ["as_of"])

    def span(self) -> tuple[_dt.date, _dt.date] | None:
        """The days that the partials cover (all jobs cover the same; the open one goes beyond)."""
        if not self.partials.exists():
            return None
        row = self.partials.current().where(F.col("job") != OPEN_JOB).agg(F.min("day"), F.max("day")).first()
        return (row[0], row[1]) if row[0] else None

    def as_ofs(self) -> set[_dt.date]:
        if not self.panel.exists():
            return set()
        return {r[0] for r in self.panel.current().select("as_of").collect()}  # one a day

    def replace_partials(self, R, p: Params, stale: Mapping[str, set[_dt.date]]) -> None:
        """Compute these partial days of these jobs again, in one plan, and make them current together."""
        frames, keys = [], []
        for job, days in stale.items():
            lo, hi = min(days), max(days)
            if job == OPEN_JOB:
                # its partials go on without an end: from the first stale day on all are new
                frames.append(daily_partials(R, p, (lo, END), [job]))
                keys += [(job, d) for d in _days(lo, hi)]
                continue
            made = daily_partials(R, p, (lo, hi), [job])
            frames.append(made if len(days) == (hi - lo).days + 1 else made.where(F.col("day").isin(sorted(days))))
            keys += [(job, d) for d in days]
        announced = self.spark.createDataFrame(keys, "job string, day date")
        if OPEN_JOB in stale and self.partials.exists():
            announced = announced.union(self.partials.current().where(
                (F.col("job") == OPEN_JOB) & (F.col("day") >= F.lit(min(stale[OPEN_JOB])))).select("job", "day"))
        self.partials.replace(reduce(DataFrame.unionByName, frames), announced)


def refresh(R, p: Params, stores: PanelStores, changed: Mapping[str, Iterable[_dt.date]],
            as_ofs: Iterable[_dt.date] = ()) -> set[_dt.date]:
    """Bring the stores up to date after ``changed`` (role -> days of its new or changed rows).

    ``as_ofs``: reporting days to add.  Returns the reporting days whose panel was
    replaced; all others stay as they are, as nothing they use has changed."""
    changed = {role: set(days) for role, days in changed.items() if days}
    known = stores.as_ofs()
    wanted = known | set(as_ofs)
    if not wanted:
        return set()
    need = (min(min(a.replace(day=1), a - 7 * DAY) for a in wanted), max(wanted))
    have = stores.span()
    stale: dict[str, set[_dt.date]] = {}
    if have is not None:
        for role, days in changed.items():
            for job, mine in stale_partials(role, days, have).items():
                stale.setdefault(job, set()).update(mine)
    # days that were not stored before: every job
    fresh = set(_days(*need)) - (set(_days(*have)) if have else set())
    if have and fresh:
        fresh |= set(_days(min(need[0], have[0]), max(need[1], have[1]))) - set(_days(*have))
    if fresh:
        for job in JOB_NAMES:
            stale.setdefault(job, set()).update(fresh)
    if stale:
        stores.replace_partials(R, replace(p, job_as_of={}), stale)
    todo = (set(as_ofs) - known) | touched(p, stale, wanted)
    if todo:
        sink_panel(R, p, stores.panel_path, panel_of_days(stores.partials.read(), p, todo))
    return todo


def batch_days(role: str, time_col: str) -> Callable[[DataFrame], dict[str, set[_dt.date]]]:
    """The changed days of a batch of one role's rows."""

    def days(batch: DataFrame) -> dict[str, set[_dt.date]]:
        return {role: {r[0] for r in batch.select(F.to_date(F.col(time_col))).distinct().collect() if r[0] is not None}}

    return days


def daily_refresh(spark: SparkSession, source_dir: str, time_col: str, make_roles: Callable, params: Params,
                  path: str | None = None, checkpoint: str | None = None, once: bool = True,
                  changed_by: Callable[[DataFrame], Mapping[str, Iterable[_dt.date]]] | None = None):
    """Start the refresh stream over ``source_dir`` (parquet files of the decision log).

    ``make_roles()`` returns the role views for a run.  ``changed_by`` tells the
    changed days of each role from a batch; by default the batch's days of
    ``time_col`` are those of ``decisions``.  Each day of a batch is a reporting
    day.  Returns the finished (``once``) or running streaming query.
    """
    base = ensure_checkpoint_dir(spark)
    path = path or os.path.join(base, "panel_stores")
    checkpoint = checkpoint or os.path.join(base, "streams", "daily_refresh")
    changed_by = changed_by or batch_days("decisions", time_col)
    stream = spark.readStream.schema(spark.read.parquet(source_dir).schema).parquet(source_dir)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        days = batch_days("days", time_col)(batch)["days"]
        if days:
            refresh(make_roles(), params, PanelStores(batch.sparkSession, path), changed_by(batch), days)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 hour")
    q = writer.start()
    if once:
        q.awaitTermination()
    return q
