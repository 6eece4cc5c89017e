"""The additive daily partials of the twenty jobs.

Each job's daily frame is computed once for a span of days, whatever the number
of reporting days that need it, and flattened to (job, day, seg, measure, value)
rows.  A partial of a day depends on source rows of other days only as
``DEPENDS`` says.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame

from tallyspark.operators.additive import partials
from tallyspark.params import Params
from tallyspark.plans import jobs as J

Span = tuple[_dt.date, _dt.date]

#: Days without a bound.
EVER = 1_000_000
#: Which partial days of a job a changed source day touches: role -> job -> (days before, days after) of the
#: changed day, or None for every day (the change meets the job's days through a key, not through time).
DEPENDS: dict[str, dict[str, tuple[int, int] | None]] = {
    "daily_deals": {"daily_loan_panel": (0, 0)},
    "decisions": {"bid_pass_rate_daily": (0, 0), "limit_application_panel": (0, 0), "limit_to_withdraw_t0_t7": (0, 0),
                  "register_to_limit_t0_t7": (EVER, 8), "same_day_withdraw_dod": (0, 0), "revolving_withdraw_dod": (0, 0),
                  "limit_to_bid_dod": (0, 0), "register_to_limit_dod": (0, 0), "bid_panel_rollup": (0, 0), "ticket_size_and_term": None},
    "register_funnel": {"registration_cohort_funnel": (0, 0)},
    "natural_day_funnel": {"natural_day_funnel": (0, 0)},
    "settle_funnel": {"settlement_reloan_funnel": (0, 0)},
    "ad_cost": {"static_cps": (0, 0), "cohort_cps_t0_t3": (0, 0)},
    "daily_conversions": {"static_cps": (0, 0)},
    "installments": {"first_payment_default": None, "settled_loans": (0, 0)},
    "listings": {"ticket_size_and_term": (0, 0), "register_to_deal_same_day": (0, 0), "first_payment_default": None, "settled_loans": None},
    "limit_loan": {"limit_to_withdraw_t0_t7": None, "same_day_withdraw_dod": None, "limit_to_bid_dod": None, "bnpl_deal_panel": None},
    "limit_loan_b": {"cohort_cps_t0_t3": None},
    "loans": {"bnpl_deal_panel": (0, 0), "revolving_withdraw_dod": (0, 1), "limit_to_withdraw_t0_t7": None, "same_day_withdraw_dod": None},
    "merchant_orders": {"bnpl_deal_panel": None},
    "registrations": {"register_to_deal_same_day": (0, 0), "register_to_limit_t0_t7": (0, 0), "register_to_limit_dod": (0, 0)},
    "register_channel": {"register_to_limit_t0_t7": None, "cohort_cps_t0_t3": (0, 0)},
}


def _loan_panel(R, p) -> DataFrame:
    return J.daily_loan_panel(R, p, restrict=True, exact=True)


def _plain(names: str) -> dict[str, str]:
    return {n: n for n in names.split()}


def _sources(R, p: Params) -> dict[str, tuple]:
    """job -> (daily frame, its day, its segments, its additive measures)."""
    kw = dict(restrict=True)
    return {
        "daily_loan_panel": (lambda: _loan_panel(R, p), "biz_date", ["user_type", "refunded"], _plain("deal_cnt deal_amount")),
        "bid_pass_rate_daily": (lambda: J.bid_pass_sums(R, p, **kw), "dt", [], _plain("pass_num flag_cnt listing_cnt")),
        "registration_cohort_funnel": (lambda: J.registration_cohort_funnel(R, p, **kw), "register_date", [], _plain(
            "register_user_cnt apply_limit_user_cnt fst_has_limit_user_cnt withdraw_succ_user_cnt")),
        "natural_day_funnel": (lambda: J.natural_day_funnel(R, p, **kw), "biz_date", [], _plain(
            "fst_apply_limit_user_cnt repay_user_cnt apply_limit_user_cnt_t0 fst_apply_has_limit_user_cnt")),
        "settlement_reloan_funnel": (lambda: J.settlement_reloan_funnel(R, p, **kw), "repay_date", [], _plain(
            "has_limit_user_cnt reloan_withdraw_user_cnt")),
        "static_cps": (lambda: J.static_cps(R, p, **kw), "biz_date", [], _plain("cost conversions")),
        "first_payment_default": (lambda: J.default_sums(R, p, **kw), "due_date", ["product_user_type", "asset_product"], _plain(
            "due_cnt principal_sum dpd1_principal dpd7_principal dpd1_cnt dpd7_cnt")),
        "settled_loans": (lambda: J.settled_loans_daily(R, p, **kw), "repay_date", ["user_type"], _plain("settled_cnt")),
        "limit_application_panel": (lambda: J.limit_application_sums(R, p, **kw), "limit_date", ["is_reloan", "biz_type"], _plain(
            "num is_pass flag_cnt limit_num n2o_pass n2o_cnt")),
        "ticket_size_and_term": (lambda: J.ticket_sums(R, p, **kw), "withdraw_date", ["is_reloan", "asset_product", "re_type"], _plain(
            "amount_sum period_multi_amount num")),
        "limit_to_withdraw_t0_t7": (lambda: J.limit_to_withdraw_t0_t7(R, p, **kw), "limit_day", ["is_reloan"], _plain(
            "t0_rows t0_conv t7_rows t7_conv")),
        "register_to_deal_same_day": (lambda: J.register_to_deal_same_day(R, p, **kw), "day", [], _plain("reg_cnt deal_cnt")),
        "register_to_limit_t0_t7": (lambda: J.register_to_limit_t0_t7(R, p, **kw), "reg_day", [], _plain("t0_rows t0_conv t7_rows t7_conv")),
        "cohort_cps_t0_t3": (lambda: J.cohort_cps_t0_t3(R, p, **kw), "reg_day", [], _plain("cost fst_withdraw_succ_cnt t3_withdraw_user_num")),
        "bnpl_deal_panel": (lambda: J.bnpl_deal_sums(R, p, **kw), "dt", [], _plain(
            "deal_cnt amount_sum period_sum period_cnt down_sum down_cnt")),
        "same_day_withdraw_dod": (lambda: J.same_day_withdraw_sums(R, p, **kw), "limit_day", ["loan_type"], _plain("row_cnt withdraw_cnt")),
        "revolving_withdraw_dod": (lambda: J.revolving_withdraw_sums(R, p, **kw), "limit_day", [], _plain(
            "has_limit_cnt first_withdraw_cnt any_withdraw_cnt")),
        "limit_to_bid_dod": (lambda: J.limit_to_bid_sums(R, p, **kw), "limit_day", [], _plain(
            "has_limit_cnt bid_cnt prime_has_limit_cnt prime_bid_cnt")),
        "register_to_limit_dod": (lambda: J.register_to_limit_sums(R, p, **kw), "reg_day", [], _plain("reg_cnt lim_cnt")),
        "bid_panel_rollup": (lambda: J.bid_parts(R, p, **kw), "dt", ["is_reloan", "is_new_to_old"], _plain("listing_num pass_num")),
    }


def daily_partials(R, p: Params, span: Span, jobs: Iterable[str] | None = None) -> DataFrame:
    """The partials of all days of ``span`` (of some jobs only)."""
    ranged = replace(p, as_of=span[0], until=span[1], job_as_of={})
    made = _sources(R, ranged)
    wanted = list(made) if jobs is None else [j for j in made if j in set(jobs)]
    frames = []
    for job in wanted:
        frame, day, segments, measures = made[job]
        frames.append(partials(job, frame(), day, segments, measures, span))
    return reduce(DataFrame.unionByName, frames)


def needed_span(as_ofs: Iterable[_dt.date]) -> Span:
    """The days whose partials the reporting days use: from the month's first day, or 7 days before, to the last
    day.  (The open period of BNPL deals goes beyond.)"""
    as_ofs = list(as_ofs)
    return min(min(a.replace(day=1), a - _dt.timedelta(days=7)) for a in as_ofs), max(as_ofs)


#: The job with a period without an end, and the last day there is.
OPEN_JOB, END = "bnpl_deal_panel", _dt.date(9999, 12, 31)


def panel_partials(R, p: Params, as_ofs: Iterable[_dt.date]) -> DataFrame:
    """All partials that the panels of ``as_ofs`` need."""
    lo, hi = needed_span(as_ofs)
    rest = [j for j in _sources(R, p) if j != OPEN_JOB]
    return daily_partials(R, p, (lo, hi), rest).unionByName(daily_partials(R, p, (lo, END), [OPEN_JOB]))


def stale_partials(role: str, days: Iterable[_dt.date], stored: Span) -> dict[str, set[_dt.date]]:
    """job -> the partial days, within the stored span, that changed days of ``role`` touch."""
    lo, hi = stored
    out: dict[str, set[_dt.date]] = {}
    for job, reach in DEPENDS[role].items():
        mine = out.setdefault(job, set())
        for d in days:
            before, after = reach or (EVER, EVER)
            first = max(lo, d - _dt.timedelta(days=min(before, d.toordinal() - 1)))
            last = hi if after >= EVER else min(hi, d + _dt.timedelta(days=after))
            mine.update(first + _dt.timedelta(days=i) for i in range((last - first).days + 1))
    return {j: d for j, d in out.items() if d}
