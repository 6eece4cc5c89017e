"""Production layout: one day-partitioned parquet dataset per role, read by
WarehouseRoles, gives the same job results as the derived test roles."""

import json
import os
import tempfile

import pytest

from tallyspark.params import TARGETS, load_targets
from tallyspark.plans import jobs
from tallyspark.sources.roles import WarehouseRoles


def _norm(df):
    return sorted(tuple((c, str(round(v, 10) if isinstance(v, float) else v))
                        for c, v in sorted(r.asDict().items())) for r in df.collect())


def test_warehouse_roles_match(spark, roles, params):
    root = tempfile.mkdtemp(prefix="wh-")
    for name in ("decisions", "limit_loan", "loans", "listings", "installments"):
        df = getattr(roles, name)
        w = df.write.mode("overwrite")
        (w.partitionBy("dt") if "dt" in df.columns else w).parquet(os.path.join(root, name))
    W = WarehouseRoles(spark, root)
    for name, daily in [("limit_to_withdraw_t0_t7", jobs.limit_to_withdraw_t0_t7),
                        ("first_payment_default", jobs.first_payment_default_daily),
                        ("bid_panel_rollup", jobs.bid_panel_rollup)]:
        p = params.for_job(name)
        assert _norm(daily(W, p)) == _norm(daily(roles, p)), name
    # a day cut on the partitioned log prunes partitions
    from tallyspark.operators.periods import period_filter
    plan = period_filter(W.decisions, "dt", params.as_of, "two_day")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dt" in plan.split("PartitionFilters: [")[1][:200]


DECISION_JOBS = ["bid_pass_rate_daily", "limit_application_panel", "ticket_size_and_term", "limit_to_withdraw_t0_t7",
                 "register_to_limit_t0_t7", "same_day_withdraw_dod", "revolving_withdraw_dod", "limit_to_bid_dod",
                 "register_to_limit_dod", "bid_panel_rollup"]


def _scans(df, column):
    """Partition filters of the scans that read ``column``."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
            for line in plan.splitlines() if "PartitionFilters: [" in line and f"{column}:" in line]


def test_decision_jobs_prune_partitions(spark, roles, params, tmp_path):
    from tallyspark.plans.fused import PanelRoles
    from tallyspark.sources.roles import ROLE_NAMES
    for name in ROLE_NAMES:
        df = getattr(roles, name)
        (df.write.partitionBy("dt") if "dt" in df.columns else df.write).parquet(str(tmp_path / name))
    W = WarehouseRoles(spark, str(tmp_path))
    assert W.decisions.filter("dt <> to_date(inserttime)").count() == 0
    daily = {n: d for n, d, _ in jobs.JOBS}
    for name in DECISION_JOBS:
        found = _scans(daily[name](W, params.for_job(name), restrict=True), "attrs")
        assert found and all("dt#" in f and "2024-01-" in f for f in found), (name, found)
    sliced = PanelRoles(W, params)._slice_decisions()
    found = _scans(sliced, "attrs")
    assert found and all("dt#" in f and "2024-01-01" in f for f in found), found


def test_load_targets(tmp_path):
    f = tmp_path / "targets.json"
    f.write_text(json.dumps({"static_cps": 12.0, "new_key": 3}))
    t = load_targets(str(f))
    assert t["static_cps"] == 12.0 and t["new_key"] == 3.0 and t["fx_rate"] == TARGETS["fx_rate"]
    f.write_text("__import__('os')")
    with pytest.raises(ValueError):
        load_targets(str(f))
