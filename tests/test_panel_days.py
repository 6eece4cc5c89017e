"""Many reporting days from one table of partials, the values that the checks compare, and a daily run."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.additive import Terms, merge, partials
from tallyspark.params import TARGETS, TEST_AS_OF, TEST_DAYS, Params
from tallyspark.params import test_params as _params
from tallyspark.plans import panel
from tallyspark.plans.catalogue import ATTAINMENT, LAYOUTS, expected_catalogue
from tallyspark.plans.daily_run import daily_run
from tallyspark.sources.roles import TestDataRoles

SMALL, CHECKED = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def _values(df):
    return {(r.as_of, r.metric): (r.job, None if r.value is None else round(r.value, 10)) for r in df.collect()}


@pytest.fixture(scope="module")
def month(spark):
    return _values(panel.panel_days(TestDataRoles(spark, SMALL), _params(), TEST_DAYS))


def test_days_in_one_plan_equal_single_runs(spark, month):
    """Days at the month's start, within and at its end, each run alone over the row-level jobs."""
    assert len(month) == 30 * 101
    R = TestDataRoles(spark, SMALL)
    for d in (TEST_DAYS[0], TEST_DAYS[1], TEST_AS_OF, TEST_DAYS[-1]):
        one = _values(panel.panel_table(R, replace(_params(), as_of=d)))
        assert one == {k: v for k, v in month.items() if k[0] == d}, d


def test_a_day_alone_equals_the_day_among_others(spark, month):
    alone = _values(panel.panel_days(TestDataRoles(spark, SMALL), _params(), [TEST_DAYS[15]]))
    assert alone == {k: v for k, v in month.items() if k[0] == TEST_DAYS[15]}


def test_every_metric_is_checked_by_a_value(spark):
    """On the tables of the correctness check each metric has, on some of its days, a value that isn't NULL, 0 or 1."""
    got = _values(panel.panel_days(TestDataRoles(spark, CHECKED), _params(), TEST_DAYS))
    told = {m for (_, m), (_, v) in got.items() if v not in (None, 0.0, 1.0)}
    assert told == {m for _, m in expected_catalogue()}
    assert not [m for (d, m), (_, v) in got.items() if d == TEST_AS_OF and v is None]
    assert any(v for (_, m), (_, v) in got.items() if m == "register_deal_rate")


def test_the_oracle_s_fixed_values_are_the_panel_s():
    from tallyspark.checks import pinned
    assert dict(pinned.TARGETS) == TARGETS and pinned.ATTAINMENT == ATTAINMENT
    assert sorted((j, m) for j, names in pinned.OWNERS.items() for m in names.split()) == expected_catalogue()
    for variant, rows in (("full", pinned.FULL), ("compact", pinned.COMPACT)):
        assert rows == [(s, i, t) for s, lines in LAYOUTS[variant] for i, t in enumerate(lines, 1)]


def test_defaults_are_the_production_values():
    p = Params(as_of=dt.date(2026, 3, 1))
    assert (p.bnpl_product, p.excluded_channels) == ("bnpl_chuanyin", ("cy_bnpl", "daraz"))
    assert p.revolving_since == dt.datetime(2026, 2, 3, 18, 26)


def test_merge_windows_segments_and_empty_days(spark):
    d = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    daily = spark.createDataFrame([(d[0], "a", 1.5), (d[1], "a", 2.0), (d[1], None, 4.0), (d[2], "b", 8.0), (d[3], "a", 16.0), (None, "a", 99.0),
                                   (d[3], "b", None)], "day date, s string, v double")
    parts = partials("j", daily, "day", ["s"], {"v": "v"})
    T = Terms()
    cols = {"now": T("j", "v"), "a": T("j", "v", s="a"), "before": T("j", "v", 1), "mtd": T("j", "v", "mtd"), "open": T("j", "v", "open"),
            "none": T("j", "w"), "null_seg": T("j", "v", s="")}
    asked = [*d, dt.date(2023, 12, 1)]
    got = {r.as_of: r for r in merge(parts, T, asked).select("as_of", *[c.cast("double").alias(n) for n, c in cols.items()]).collect()}
    assert set(got) == set(asked)
    pick = lambda day: tuple(got[day][n] for n in cols)
    assert pick(d[1]) == (6.0, 2.0, 1.5, 7.5, 31.5, None, 4.0)
    assert pick(d[2]) == (8.0, None, 6.0, 8.0, 24.0, None, None)
    assert pick(asked[-1]) == (None, None, None, None, 31.5, None, None)


def test_partials_are_computed_once_for_all_days(spark):
    """The plan over thirty days scans the partial table once for the metrics, whatever the number of days."""
    table = panel.panel_days(TestDataRoles(spark, SMALL), _params(), TEST_DAYS)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("Relation ") <= 2  # once more for attainment
    assert "events.parquet" not in plan


def test_daily_run_from_targets_to_report(spark, tmp_path):
    R, p = TestDataRoles(spark, SMALL), _params()
    targets = tmp_path / "targets.json"
    targets.write_text(json.dumps({"static_cps": 2.0}))
    store = str(tmp_path / "store")
    full = daily_run(R, p, store).collect()
    text = {(r.section, r.line_no): r.text for r in full}
    assert text[("0 header", 2)] == "Date: 2024-01-10  Unit: USD" and len(full) == 38
    again = {(r.section, r.line_no): r.text for r in daily_run(R, p, store, str(targets), params={"unit": "EUR"}).collect()}
    assert again[("0 header", 2)].endswith("EUR")
    changed = {k for k in text if text[k] != again[k]}
    assert changed == {("0 header", 2), ("3 acquisition", 2)}
    compact = daily_run(R, p, store, variant="compact").collect()
    assert len(compact) == 35 and {r.variant for r in compact} == {"compact"}
    stored = panel.metric_store(R, f"{store}/panel").verified()
    assert stored.where(F.col("as_of") == F.lit(TEST_AS_OF)).count() == 101
