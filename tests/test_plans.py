"""Plan checks: filters reach the scan, only used columns are read, the
cohort plan pre-aggregates, the sequence avoids a per-key window."""

from tallyspark.operators.periods import period_filter
from tallyspark.operators.sequence import event_sequence
from tallyspark.plans import jobs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_period_filter_pushed_to_parquet(roles, params):
    d = period_filter(roles.decisions, "inserttime", params.as_of, "two_day")
    plan = _plan(d.select("flow_id"))
    assert "PushedFilters" in plan and "ts" in plan


def test_mtd_range_pushed_on_raw_timestamp(roles, params):
    p = params.for_job("ticket_size_and_term")
    plan = _plan(period_filter(roles.listings, "withdraw_time", p.as_of, "mtd").select("listing_id"))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_column_pruning(roles):
    plan = _plan(roles.listings.select("listing_id"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_cohort_preaggregates_conversion_side(roles, params):
    plan = _plan(jobs.limit_to_withdraw_t0_t7(roles, params))
    # the conversion side is aggregated by (key, day) before the join
    assert plan.count("HashAggregate") >= 6
    assert "Window" not in plan


def test_event_sequence_is_not_written_and_windows_rows_by_bucket(roles):
    df = event_sequence(roles.listings.select("user_id", "listing_id", "withdraw_time"),
                        "user_id", "withdraw_time", "listing_id")
    plan = _plan(df)
    assert "sequence-" not in plan and "materialized" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # rows by (key, bucket); the counts alone by key
    assert len(windows) == 2
    rows, counts = sorted(windows, key=lambda line: "row_number" not in line)
    assert "row_number() windowspecdefinition(user_id#" in rows and "_b#" in rows.split("ASC")[0]
    assert "sum(_n#" in counts


def _role_scans(spark, roles, tmp_path, names):
    """Roles stored as datasets, so that a plan's scans can be told apart."""
    from tallyspark.sources.roles import WarehouseRoles
    for name in names:
        getattr(roles, name).write.parquet(str(tmp_path / name))
    return WarehouseRoles(spark, str(tmp_path))


def test_day_over_day_jobs_scan_each_role_once(spark, roles, params, tmp_path):
    roles_of = {"same_day_withdraw_dod": ["decisions", "limit_loan", "loans"], "revolving_withdraw_dod": ["decisions", "loans"],
                "limit_to_bid_dod": ["decisions", "limit_loan"], "register_to_limit_dod": ["decisions", "registrations"]}
    roles.registrations.where("dt = date'2024-01-31'").write.partitionBy("dt").parquet(str(tmp_path / "registrations"))
    W = _role_scans(spark, roles, tmp_path, ["decisions", "limit_loan", "loans"])
    daily = {n: d for n, d, _ in jobs.JOBS}
    for name, used in roles_of.items():
        plan = _plan(daily[name](W, params))
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        assert len(scans) == len(used), (name, scans)
        own = {"decisions": "attrs:", "limit_loan": "limit_flow_no:", "loans": "bid_stage:", "registrations": "register_time:"}
        for role in used:
            assert sum(own[role] in line for line in scans) == 1, (name, role)
    assert _plan(daily["revolving_withdraw_dod"](W, params)).count("Join") == 1


def test_slice_reads_only_its_days(spark, roles, params):
    from tallyspark.operators.periods import slice_at
    g = jobs.limit_application_panel(roles, params)  # with a window over the month, which the slice doesn't use
    df = slice_at(g, "limit_date", params.as_of, {"n": ("num", "sum"), "r": ("pass_rate", "max"), "before": ("pass_rate", "pick", None, 1)})
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = _plan(df)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line[line.find("PushedFilters"):] for line in plan.splitlines() if "PushedFilters" in line]
    assert len(pushed) == 1 and "Window" not in plan
    assert "GreaterThanOrEqual(ts,2024-01-10" in pushed[0] and "LessThan(ts,2024-01-11" in pushed[0]
    assert "GreaterThanOrEqual(ts,2024-01-09" in pushed[0]


def test_first_event_is_an_aggregate(roles):
    from tallyspark.operators.sequence import first_event_per_key
    plan = _plan(first_event_per_key(roles.loans, "user_id", "withdraw_time", "listing_id"))
    # partial + final aggregate (a struct buffer plans as SortAggregate)
    assert "Window" not in plan and ("HashAggregate" in plan or "SortAggregate" in plan)
    assert "partial_min" in plan


def test_day_list_cut_is_pushed_as_ranges(roles, params):
    from tallyspark.operators.periods import period_filter
    d = period_filter(roles.decisions, "inserttime", params.as_of, "two_day").select("flow_id")
    plan = _plan(d)
    i = plan.find("PushedFilters")
    assert "Or(And(GreaterThanOrEqual(ts" in plan[i:i + 400]


def test_period_cut_reaches_both_join_inputs(roles, params):
    # J6 joins daily cost with daily conversions; the as_of cut must reach
    # both scans, not only the driving side of the left join
    p = params.for_job("static_cps")
    plan = _plan(jobs.static_cps(roles, p, restrict=True))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2
    for s in scans:
        i = s.find("PushedFilters")
        assert "GreaterThanOrEqual(ts" in s[i:i + 400], s[i:i + 400]


def test_fused_slices_built_once_under_concurrency(spark, params):
    from concurrent.futures import ThreadPoolExecutor

    from tallyspark.plans.fused import PanelRoles
    from tallyspark.sources.roles import TestDataRoles

    calls = []

    class Counting(PanelRoles):
        def _build(self, name):
            calls.append(name)
            return super()._build(name)

    S = Counting(TestDataRoles(spark, "/root/testdata/sf0.001"), params)
    with ThreadPoolExecutor(8) as pool:
        frames = list(pool.map(lambda _: S.decisions, range(16)))
    assert calls.count("decisions") == 1
    assert all(f is frames[0] for f in frames)
