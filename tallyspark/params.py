"""Run parameters: the reporting day, business targets and code lists.

Dates are always parameters; nothing reads the clock.  ``as_of`` is the last
complete day ("yesterday" of the run); the run day is ``as_of + 1``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the panel's configuration for identical results.
# Business targets, in the order they are configured (the first entry is the
# local-currency per USD exchange rate used to convert money to USD).
# ---------------------------------------------------------------------------
TARGETS: dict[str, float] = {
    "fx_rate": 284,
    "month_loan_amount_usd": 4500000,
    "month_new_loan_cnt": 31000,
    "month_old_loan_cnt": 93000,
    "month_old_loan_amount_usd": 2300000,
    "register_apply_rate_t3": 0.45,
    "natural_day_register_limit_rate": 0.55,
    "new_withdraw_rate_t0": 0.70,
    "new_withdraw_rate_t7": 0.85,
    "old_withdraw_rate_t7": 0.85,
    "old_withdraw_rate_t0": 0.65,
    "new_limit_pass_rate": 0.15,
    "new_ticket_usd": 24,
    "old_ticket_usd": 48,
    "new_term_days": 35,
    "old_term_days": 50,
    "static_cps": 13.5,
    "register_deal_rate": 0.14,
    "register_limit_row_t0": 0.4,
    "register_limit_row_t7": 0.5,
    "cps_t0": 22.4,
    "cps_t3": 23,
    "reapply_rate_t0": 0.95,
    "n2o_same_day_withdraw": 0.56,
    "other_same_day_withdraw": 0.65,
    "revolving_withdraw_t0": 0.047,
    "new_bid_rate_t0": 0.75,
    "prime_bid_rate_t0": 0.78,
    "register_limit_user_t0": 0.41,
}

# FIXED VALUES — business codes carried by the decision log and loan tables.
BIZ_LIMIT_CASH = ("10000", "10001")        # cash-loan credit-limit applications
BIZ_LIMIT_ALL = ("10000", "10001", "11000")  # plus the BNPL limit application
BIZ_REVOLVING = "12001"                    # revolving (cyclic) credit decisions
BIZ_LISTING_REVOLVING = "22050"            # revolving-loan listing decisions
BIZ_LISTING = ("20050", "22050")           # all listing decisions
STAGE_MIN = "80"                           # bid stage code, compared as text
PRIME_GRADES = ("A", "B", "C")             # risk grades counted as prime
TERM_DAYS_CASH = 15                        # days per cash-loan period
TERM_DAYS_BNPL = 30                        # days per BNPL period


# FIXED VALUES — codes of the production tables.
BNPL_PRODUCT = "bnpl_chuanyin"
PAID_CHANNELS = ("tiktok", "google", "facebook")
EXCLUDED_CHANNELS = ("cy_bnpl", "daraz")
REVOLVING_SINCE = _dt.datetime(2026, 2, 3, 18, 26, 0)


@dataclass(frozen=True)
class Params:
    """Parameters of a run; the defaults are the production values."""

    as_of: _dt.date
    # the last of several reporting days, as_of being the first (None: one day)
    until: _dt.date | None = None
    # per-job override of as_of, for roles that are complete up to another day
    job_as_of: dict = field(default_factory=dict)
    targets: dict = field(default_factory=lambda: dict(TARGETS))
    cash_product: str = "cashloan"
    bnpl_product: str = BNPL_PRODUCT
    paid_channels: tuple = PAID_CHANNELS
    excluded_channels: tuple = EXCLUDED_CHANNELS
    revolving_since: _dt.datetime = REVOLVING_SINCE
    grain: str = "row"   # 'row' reproduces fan-out counting; 'entity' dedupes
    default_target: float = 1.0

    @property
    def fx(self) -> float:
        return float(self.targets["fx_rate"])

    def for_job(self, job: str) -> "Params":
        d = self.job_as_of.get(job)
        return replace(self, as_of=d) if d else self

    def days_before(self, n: int) -> _dt.date:
        return self.as_of - _dt.timedelta(days=n)


# The test tables: events cover January 2024; on the 10th every metric has a value at sf0.01.
TEST_AS_OF = _dt.date(2024, 1, 10)
TEST_DAYS = tuple(_dt.date(2024, 1, d) for d in range(1, 31))


def load_targets(path: str, base: dict | None = None) -> dict:
    """Targets from a JSON object file ``{"metric_or_key": number, ...}``
    (parsed as data — never evaluated), over the built-in ``TARGETS``."""
    import json
    with open(path, encoding="utf-8") as f:
        loaded = json.load(f)
    if not isinstance(loaded, dict) or not all(isinstance(v, (int, float)) for v in loaded.values()):
        raise ValueError("targets file must be a JSON object of numbers")
    out = dict(TARGETS if base is None else base)
    out.update({str(k): float(v) for k, v in loaded.items()})
    return out


def test_params(**kw) -> Params:
    """The codes that the test tables are mapped to."""
    values = dict(as_of=TEST_AS_OF, bnpl_product="bnpl", excluded_channels=("building",),
                  revolving_since=_dt.datetime(2024, 1, 10, 12, 0, 0))
    return Params(**{**values, **kw})
