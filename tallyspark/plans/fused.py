"""Fused panel inputs: one pass per role.

The naive panel plans every job from the full role views, so a large role
(the decision log) is scanned and derived once per job that uses it.  Here
each role is cut once to the union of what the twenty jobs read at their
``as_of`` — time-partitioned roles by a day range, key-joined roles by the
keys the sliced roles reference — and written as parquet under the shared
checkpoint folder.  The jobs then run unchanged on these slices: their own
filters select from the slice, plans are shallow, and lineage is cut (a lost
executor recomputes from the written slice, not from the source).

Key cuts are LEFT joins to *distinct* key sets plus a flag filter, so a row
is kept at most once whatever the number of matching keys.

Only roles read by several jobs are written (``SHARED``); a role read by one
job stays a lazy, period-cut view — writing it would add a pass, not save one.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.periods import day_between, day_in
from tallyspark.params import Params
from tallyspark.session import checkpoint_path, materialize, remove_path
from tallyspark.sources.roles import Roles

D = _dt.timedelta

# roles read by more than one job of the panel
SHARED = ("decisions", "loans", "limit_loan", "listings", "installments",
          "registrations", "register_channel")


def _keep_if_keyed(df: DataFrame, cond: Column | None, keysets: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows where ``cond`` holds or whose ``col`` is in a key set."""
    keep = cond if cond is not None else F.lit(False)
    out = df
    for i, (col, keys, key_col) in enumerate(keysets):
        flag = f"_k{i}"
        k = keys.select(F.col(key_col).alias(col)).filter(F.col(col).isNotNull()).distinct() \
                .withColumn(flag, F.lit(True))
        out = out.join(k, col, "left")
        keep = keep | F.coalesce(F.col(flag), F.lit(False))
    return out.filter(keep).drop(*[f"_k{i}" for i in range(len(keysets))])


class PanelRoles(Roles):
    """Role slices for one panel run (see module docstring)."""

    def __init__(self, base: Roles, p: Params):
        super().__init__(base.spark)
        self.base, self.p = base, p
        self.run_id = uuid.uuid4().hex[:12]
        self._revolving = None

    def latest(self, name: str, part_col: str = "dt") -> DataFrame:
        return getattr(self, name)  # slices of a snapshot role hold its latest snapshot only

    def _a(self, job: str) -> _dt.date:
        return self.p.for_job(job).as_of

    def _save(self, name: str, df: DataFrame) -> DataFrame:
        return materialize(df, f"panel-{self.run_id}/slices/{name}")

    def cleanup(self) -> None:
        """Delete this run's role slices (call once every job has written its
        output; the outputs themselves are kept)."""
        remove_path(self.spark, checkpoint_path(self.spark, f"panel-{self.run_id}/slices"))

    def revolving_members(self) -> DataFrame:
        with self._lock("revolving_members"):
            return self._revolving_members()

    def _revolving_members(self) -> DataFrame:
        if self._revolving is None:
            from tallyspark.plans.jobs import revolving_users
            # read by one job: kept lazy (a distinct set over the decision log)
            self._revolving = revolving_users(self.base, self.p.for_job("ticket_size_and_term"))
        return self._revolving

    def _build(self, name: str) -> DataFrame:
        df = getattr(self, f"_slice_{name}")()
        return self._save(name, df) if name in SHARED else df

    # -- event log -------------------------------------------------------
    def _slice_decisions(self) -> DataFrame:
        jobs = ["bid_pass_rate_daily", "limit_application_panel", "limit_to_withdraw_t0_t7",
                "register_to_limit_t0_t7", "same_day_withdraw_dod", "revolving_withdraw_dod",
                "limit_to_bid_dod", "register_to_limit_dod", "bid_panel_rollup"]
        lo = min(min(self._a(j).replace(day=1), self._a(j) - D(days=8)) for j in jobs)
        d = self.base.decisions
        return d.filter(day_between(d, "inserttime", lo, None) & day_between(d, "dt", lo, None))

    def _slice_loans(self) -> DataFrame:
        lo = min(self._a("bnpl_deal_panel").replace(day=1), self._a("revolving_withdraw_dod") - D(days=1))
        d = self.base.loans
        return d.filter(day_between(d, "withdraw_time", lo, None))

    def _slice_limit_loan(self) -> DataFrame:
        return _keep_if_keyed(self.base.limit_loan, None,
                              [("limit_flow_no", self.decisions, "flow_id"),
                               ("listing_id", self.loans, "listing_id")])

    def _slice_merchant_orders(self) -> DataFrame:
        return _keep_if_keyed(self.base.merchant_orders, None,
                              [("loan_apply_no", self.limit_loan, "loan_apply_no")])

    def _slice_registrations(self) -> DataFrame:
        lo = min(self._a(j) - D(days=7) for j in
                 ("register_to_deal_same_day", "register_to_limit_t0_t7", "register_to_limit_dod"))
        r = self.base.latest("registrations")
        return r.filter(day_between(r, "register_time", lo, None))

    def _slice_register_channel(self) -> DataFrame:
        a = self._a("cohort_cps_t0_t3")
        r = self.base.register_channel
        return _keep_if_keyed(r, day_between(r, "register_time", a - D(days=2), a),
                              [("user_id", self.registrations, "user_id")])

    def _slice_limit_loan_b(self) -> DataFrame:
        return _keep_if_keyed(self.base.limit_loan_b, None, [("user_id", self.register_channel, "user_id")])

    def _slice_ad_cost(self) -> DataFrame:
        a6, a14 = self._a("static_cps"), self._a("cohort_cps_t0_t3")
        d = self.base.ad_cost
        return d.filter(day_between(d, "biz_date", min(a6.replace(day=1), a14 - D(days=2)), max(a6, a14)))

    def _range(self, role: str, col: str, job: str, back: int | None = None) -> DataFrame:
        a = self._a(job)
        d = getattr(self.base, role)
        lo = a - D(days=back) if back is not None else a.replace(day=1)
        return d.filter(day_between(d, col, lo, a))

    def _slice_daily_conversions(self) -> DataFrame:
        return self._range("daily_conversions", "biz_date", "static_cps")

    def _slice_register_funnel(self) -> DataFrame:
        return self._range("register_funnel", "register_date", "registration_cohort_funnel", back=3)

    def _slice_natural_day_funnel(self) -> DataFrame:
        return self._range("natural_day_funnel", "biz_date", "natural_day_funnel")

    def _slice_settle_funnel(self) -> DataFrame:
        return self._range("settle_funnel", "repay_date", "settlement_reloan_funnel")

    # -- order book ------------------------------------------------------
    def _slice_daily_deals(self) -> DataFrame:
        return self._range("daily_deals", "biz_date", "daily_loan_panel")

    def _slice_installments(self) -> DataFrame:
        a7, a8 = self._a("first_payment_default"), self._a("settled_loans")
        i = self.base.installments
        due = day_in(i, "due_date", [a7, a7 - D(days=6)])
        return i.filter(due | day_between(i, "repay_time", a8.replace(day=1), a8))

    def _slice_listings(self) -> DataFrame:
        a10, a12 = self._a("ticket_size_and_term"), self._a("register_to_deal_same_day")
        l = self.base.listings
        cond = (day_between(l, "withdraw_time", a10.replace(day=1), a10)
                | day_between(l, "withdraw_time", a12, a12))
        return _keep_if_keyed(l, cond, [("listing_id", self.installments, "listing_id")])
