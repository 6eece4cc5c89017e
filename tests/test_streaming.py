"""The refresh stream: new days are added, late rows correct every stored metric they touch, nothing else is replaced."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyspark.params import test_params as _params
from tallyspark.plans import panel
from tallyspark.plans.formulas import touched
from tallyspark.plans.partials import DEPENDS, stale_partials
from tallyspark.sources.roles import ROLE_NAMES, TestDataRoles
from tallyspark.streaming.daily_refresh import PanelStores, daily_refresh, refresh

SRC = "/root/testdata/sf0.001"


def _day(n: int) -> dt.date:
    return dt.date(2024, 1, n)


def _rows(df):
    return {(r.as_of, r.metric): None if r.value is None else round(r.value, 10) for r in df.collect()}


@pytest.fixture()
def data(spark, tmp_path):
    for t in ("orders", "lineitem", "customer"):
        spark.read.parquet(f"{SRC}/{t}.parquet").write.parquet(f"{tmp_path}/data/{t}.parquet")
    return str(tmp_path / "data")


def _all_changed(batch):
    """Events feed every role of the test mapping, some with days of their own: all January counts as changed for those."""
    days = {r[0] for r in batch.select(F.to_date("ts")).distinct().collect()}
    every = {_day(1) + dt.timedelta(days=i) for i in range(-10, 60)}
    moved = {"installments", "registrations", "register_channel", "limit_loan", "limit_loan_b", "merchant_orders"}
    return {role: every if role in moved else days for role in ROLE_NAMES}


def test_new_and_late_files(spark, data, tmp_path):
    events = spark.read.parquet(f"{SRC}/events.parquet")
    folder, day = f"{data}/events.parquet", F.to_date("ts")
    late = (F.col("event_id") % 3 == 0) & (day == F.lit(_day(5)))
    events.where((day <= F.lit(_day(9))) & ~late).coalesce(1).write.parquet(folder)
    path, check = str(tmp_path / "stores"), str(tmp_path / "check")

    def run():
        daily_refresh(spark, folder, "ts", lambda: TestDataRoles(spark, data), _params(), path=path, checkpoint=check, changed_by=_all_changed)
        return PanelStores(spark, path)

    def fresh(last):
        return _rows(panel.panel_days(TestDataRoles(spark, data), _params(), [_day(i) for i in range(1, last + 1)]))

    first = run()
    before = _rows(first.panel.verified())
    assert before == fresh(9) and len(before) == 9 * 101
    # the held-back rows of the 5th and one new day
    events.where(late | (day == F.lit(_day(10)))).coalesce(1).write.mode("append").parquet(folder)
    second = run()
    after = _rows(second.panel.verified())
    assert after == fresh(10) and len(after) == 10 * 101
    assert any(after[k] != before[k] for k in before)
    assert second.panel.check().count() == 0 and second.partials.check().count() == 0


def test_a_late_decision_replaces_only_what_it_touches(spark, tmp_path):
    R, p = TestDataRoles(spark, SRC), _params()
    stores = PanelStores(spark, str(tmp_path))
    days = [_day(i) for i in range(1, 21)]
    assert refresh(R, p, stores, {}, days) == set(days)
    runs = {r.as_of: r.run for r in stores.panel.current().collect()}

    class Late(TestDataRoles):  # one more listing decision on the 12th
        def _role_decisions(self):
            d = super()._role_decisions()
            more = d.where("dt = date'2024-01-12' and attrs['biz_id'] in ('20050', '22050')").limit(1)
            return d.union(more.withColumn("flow_id", F.lit("-1")))

    late = Late(spark, SRC)
    # the role's days only: the revolving members aren't touched by a listing decision, but the table can't know
    done = refresh(late, p, stores, {"decisions": [_day(12)]})
    assert _day(12) in done
    got = _rows(stores.panel.read())
    assert got == _rows(panel.panel_days(late, p, days))
    now = {r.as_of: r.run for r in stores.panel.current().collect()}
    assert {d for d in days if now[d] != runs[d]} == done
    assert refresh(late, p, stores, {"daily_deals": [_day(20)]}) == {_day(20)}


def test_dependency_table_covers_every_role_and_window():
    p = _params()
    assert set(DEPENDS) == set(ROLE_NAMES)
    days = [_day(i) for i in range(1, 31)]
    span = (_day(1), _day(30))
    assert stale_partials("decisions", [_day(8)], span)["bid_panel_rollup"] == {_day(8)}
    assert stale_partials("loans", [_day(30)], span)["revolving_withdraw_dod"] == {_day(30)}
    assert len(stale_partials("decisions", [_day(8)], span)["ticket_size_and_term"]) == 30
    # month to date, the day after, three and seven days after
    assert touched(p, {"daily_loan_panel": [_day(8)]}, days) == set(days[7:])
    assert touched(p, {"same_day_withdraw_dod": [_day(8)]}, days) == {_day(8), _day(9)}
    assert touched(p, {"registration_cohort_funnel": [_day(8)]}, days) == {_day(8), _day(11)}
    assert touched(p, {"limit_to_withdraw_t0_t7": [_day(8)]}, days) == {_day(8), _day(15)}
    assert touched(p, {"bnpl_deal_panel": [_day(8)]}, days) == set(days)  # the open month counts later days too


def test_days_of_two_months(spark):
    """Month-to-date figures start anew with the month."""
    R, p = TestDataRoles(spark, SRC), _params()
    days = [_day(31), dt.date(2024, 2, 1)]
    many = _rows(panel.panel_days(R, p, days))
    for d in days:
        one = _rows(panel.panel_table(TestDataRoles(spark, SRC), replace(p, as_of=d)))
        assert one == {k: v for k, v in many.items() if k[0] == d}
