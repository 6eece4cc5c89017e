"""The daily panel: twenty jobs -> one long metric table -> targets,
completeness and report lines, all keyed by the reporting day.

``panel_table`` unions the twenty lazy jobs of one day into a single plan.
``run_panel`` runs them side by side over shared role slices.  ``panel_days``
goes the other way round: the additive daily partials are computed once for the
span that all reporting days need, stored, and every day's panel is a merge of
them.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators import panel as PO
from tallyspark.operators.report import layout_rows, report_lines
from tallyspark.params import Params
from tallyspark.plans.catalogue import ATTAINMENT, LAYOUTS, REPORT_PARAMS, expected_catalogue
from tallyspark.plans.formulas import panel_of_days
from tallyspark.plans.jobs import JOBS
from tallyspark.plans.partials import panel_partials
from tallyspark.session import materialize
from tallyspark.sinks.store import KeyedStore

_LOG = logging.getLogger("tallyspark.panel")


def job_rows(R, p: Params) -> DataFrame:
    """(as_of, job, metric, value, job_ordinal) of all jobs, one plan."""
    out = None
    for i, (name, _, metrics) in enumerate(JOBS):
        pj = p.for_job(name)
        df = metrics(R, pj).withColumns({"as_of": F.lit(pj.as_of), "job_ordinal": F.lit(i)})
        out = df if out is None else out.unionByName(df)
    return out


def metric_table(R, p: Params) -> DataFrame:
    """(as_of, job, metric, value): job metrics, last job wins on a shared name."""
    return PO.metric_table(job_rows(R, p))


def panel_days(R, p: Params, as_ofs: Iterable[_dt.date]) -> DataFrame:
    """(as_of, job, metric, value) of several reporting days: the partials are
    written once under the shared folder, and all days are merged from them in one plan."""
    as_ofs = sorted(set(as_ofs))
    parts = materialize(panel_partials(R, p, as_ofs), f"partials-{uuid.uuid4().hex[:12]}")
    return panel_of_days(parts, p, as_ofs)


def attainment(R, p: Params, table: DataFrame | None = None) -> DataFrame:
    spark = R.spark
    table = table if table is not None else metric_table(R, p)
    mapping = spark.createDataFrame(ATTAINMENT, "att_metric string, base_metric string, target_key string")
    return PO.target_attainment(table, PO.targets_frame(spark, p.targets), mapping, p.default_target)


def panel_table(R, p: Params) -> DataFrame:
    """Every panel metric: job metrics plus attainment metrics."""
    t = metric_table(R, p)
    a = attainment(R, p, t).select("as_of", "job", "metric", "value")
    return t.unionByName(a)


def fused_panel_table(R, p: Params) -> DataFrame:
    """``panel_table`` over role slices cut once for the whole run (one pass
    per role; see ``plans.fused``), as one lazy plan."""
    from tallyspark.plans.fused import PanelRoles
    return panel_table(PanelRoles(R, p), p)


def run_panel(R, p: Params, workers: int = 12, log=None, strict: bool = True) -> DataFrame:
    """Production run of the panel.

    1. All twenty jobs start at once (Spark runs jobs submitted from several
       threads side by side).  A shared role slice (``plans.fused``) is
       written once, by the first job that needs it; jobs needing the same
       slice wait for that write, jobs on other roles go ahead.
    2. Each job's long metric rows are written by the executors under the
       run folder.  A failing job fails the run once the others have ended;
       with ``strict=False`` it is logged and left out, and its metrics show as
       ``missing`` in ``completeness``.
    3. The role slices are deleted; the metric table (last job wins on a
       shared name) and the attainment rows are computed from the written
       job outputs (~100 rows).
    Returns the panel table (as_of, job, metric, value) read from the run
    folder; nothing but that table's rows can ever reach the driver.
    """
    from concurrent.futures import ThreadPoolExecutor

    from tallyspark.plans.fused import PanelRoles

    S = PanelRoles(R, p)

    def one(i_job):
        i, (name, _, metrics) = i_job
        pj = p.for_job(name)
        try:
            df = metrics(S, pj).withColumn("as_of", F.lit(pj.as_of)).withColumn("job_ordinal", F.lit(i))
            return materialize(df, f"panel-{S.run_id}/jobs/{name}")
        except Exception as e:  # noqa: BLE001 — any failure of a job is reported or left out
            if strict:
                raise
            (log or _LOG.warning)(f"panel job {name} failed and is skipped: {e}")
            return None

    try:
        with ThreadPoolExecutor(max_workers=workers) as pool:
            outs = [o for o in pool.map(one, enumerate(JOBS)) if o is not None]
    finally:  # every job has ended: the role slices are no longer read
        S.cleanup()
    if not outs:  # every job failed: an empty panel (completeness shows all missing)
        return R.spark.createDataFrame([], "as_of date, job string, metric string, value double")
    u = outs[0]
    for o in outs[1:]:
        u = u.unionByName(o)
    t = PO.metric_table(u)
    a = attainment(R, p, t).select("as_of", "job", "metric", "value")
    return t.unionByName(a)


def metric_store(R, path: str) -> KeyedStore:
    """The stored panel, replaced day by day (see ``sinks.store``)."""
    return KeyedStore(R.spark, path, ["as_of"])


def sink_panel(R, p: Params, path: str, table: DataFrame | None = None) -> KeyedStore:
    """Metric sink: the days of ``table`` become current in the store, each as a
    whole.  Only days with every metric of the catalogue are taken: an incomplete
    one is an error, and what the store holds for its days stays."""
    table = table if table is not None else run_panel(R, p)
    store = metric_store(R, path)
    run = store.write(table)
    lost = completeness(R, p, store._rows_of(run)).where("status = 'missing'")
    named = [f"{r['metric']} ({r['as_of']})" for r in lost.orderBy("as_of", "metric").limit(20).collect()]
    if named:
        raise ValueError(f"the panel is incomplete and is not stored; missing: {', '.join(named)}")
    store.commit(run)
    return store


def completeness(R, p: Params, table: DataFrame | None = None) -> DataFrame:
    table = table if table is not None else panel_table(R, p)
    return PO.metric_completeness(table.drop("job"), expected_catalogue())


def report(R, p: Params, table: DataFrame | None = None, variant: str = "full", params: Mapping[str, str] | None = None) -> DataFrame:
    """(as_of, variant, section, line_no, text) of one layout for every day of the table."""
    table = table if table is not None else panel_table(R, p)
    return report_lines(table, layout_rows(variant, LAYOUTS[variant]), {**REPORT_PARAMS, **(params or {})})
