"""Invariants of the metric jobs on the real (small) test tables."""

from pyspark.sql import functions as F

from tallyspark.params import test_params as _params
from tallyspark.plans import jobs


def test_rates_in_unit_interval(roles, params):
    for name, daily, cols in [
        ("limit_to_withdraw_t0_t7", jobs.limit_to_withdraw_t0_t7, ["t0_rate", "t7_rate"]),
        ("same_day_withdraw_dod", jobs.same_day_withdraw_dod, ["withdraw_rate"]),
        ("limit_to_bid_dod", jobs.limit_to_bid_dod, ["bid_rate", "prime_bid_rate"]),
        ("register_to_limit_dod", jobs.register_to_limit_dod, ["reg_to_lim_rate"]),
        ("bid_panel_rollup", jobs.bid_panel_rollup, ["pass_rate", "n2o_pass_rate"]),
    ]:
        df = daily(roles, params.for_job(name))
        for c in cols:
            bad = df.filter((F.col(c) < 0) | (F.col(c) > 1)).count()
            assert bad == 0, (name, c)


def test_t0_not_above_t7(roles, params):
    df = jobs.limit_to_withdraw_t0_t7(roles, params)
    assert df.filter(F.col("t0_conv") > F.col("t7_conv")).count() == 0


def test_entity_grain_not_above_row_rows(roles):
    row = jobs.limit_to_withdraw_t0_t7(roles, _params(grain="row"))
    ent = jobs.limit_to_withdraw_t0_t7(roles, _params(grain="entity"))
    j = row.alias("r").join(ent.alias("e"), ["limit_day", "is_reloan"])
    assert j.filter(F.col("e.t0_rows") > F.col("r.t0_rows")).count() == 0


def test_segments_sum_to_total(roles, params):
    p = params.for_job("daily_loan_panel")
    g = jobs.daily_loan_panel(roles, p)
    total = roles.daily_deals.filter(F.col("product_type") != 32).count()
    assert g.agg(F.sum("deal_cnt")).first()[0] == total


def test_mtd_non_decreasing(roles, params):
    from pyspark.sql import Window
    g = jobs.daily_loan_panel(roles, params.for_job("daily_loan_panel"))
    w = Window.partitionBy("user_type", "refunded", F.trunc("biz_date", "month")).orderBy("biz_date")
    bad = g.withColumn("prev", F.lag("mtd_deal_cnt").over(w)).filter(F.col("mtd_deal_cnt") < F.col("prev"))
    assert bad.count() == 0


def test_panel_fused_equals_naive(spark, roles, params):
    from tallyspark.plans import panel
    from tallyspark.sources.roles import TestDataRoles

    def norm(rows):
        return sorted((r.metric, r.job, str(r.as_of), None if r.value is None else round(r.value, 12)) for r in rows)
    naive = norm(panel.panel_table(roles, params).collect())
    fused = norm(panel.run_panel(TestDataRoles(spark, "/root/testdata/sf0.001"), params).collect())
    assert naive == fused
    assert len(naive) == 101


def test_completeness_lists_every_metric(spark, params):
    from tallyspark.plans import panel
    from tallyspark.sources.roles import TestDataRoles
    R = TestDataRoles(spark, "/root/testdata/sf0.001")
    rows = panel.completeness(R, params, panel.run_panel(R, params)).collect()
    assert len(rows) == 101
    assert {r.status for r in rows} <= {"ok", "null", "missing"}
    assert not [r for r in rows if r.status == "missing"]


def test_failing_job_is_isolated(spark, params):
    from tallyspark.plans import panel
    from tallyspark.plans.jobs import JOBS
    from tallyspark.sources.roles import TestDataRoles

    idx = [n for n, _, _ in JOBS].index("static_cps")
    original = JOBS[idx]

    def broken(R, p):
        raise RuntimeError("source table unavailable")

    JOBS[idx] = (original[0], original[1], broken)
    messages = []
    try:
        R = TestDataRoles(spark, "/root/testdata/sf0.001")
        table = panel.run_panel(R, params, log=messages.append, strict=False)
        rows = panel.completeness(R, params, table).collect()
    finally:
        JOBS[idx] = original
    missing = {r.metric for r in rows if r.status == "missing"}
    assert missing == {"static_cps", "static_cps_att"}
    assert any("static_cps" in m for m in messages)
    assert len([r for r in rows if r.status != "missing"]) == 99


def test_incomplete_panel_leaves_the_sink_alone(spark, roles, params, tmp_path):
    import pytest

    from tallyspark.plans import panel
    from tallyspark.plans.jobs import JOBS

    def rows():
        return sorted((r.metric, r.value is None, r.value or 0.0) for r in panel.metric_store(roles, sink).verified().collect())

    sink = str(tmp_path / "sink")
    table = panel.run_panel(roles, params)
    panel.sink_panel(roles, params, sink, table)
    stored = rows()
    assert len(stored) == 101
    with pytest.raises(ValueError, match="static_cps"):
        panel.sink_panel(roles, params, sink, table.filter("metric <> 'static_cps'"))
    idx = [n for n, _, _ in JOBS].index("static_cps")
    original = JOBS[idx]

    def broken(R, p):
        raise RuntimeError("source table unavailable")

    JOBS[idx] = (original[0], original[1], broken)
    try:
        with pytest.raises(RuntimeError, match="unavailable"):
            panel.sink_panel(roles, params, sink)
    finally:
        JOBS[idx] = original
    assert rows() == stored
