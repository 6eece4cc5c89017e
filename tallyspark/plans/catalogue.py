"""Panel configuration: metric catalogue, attainment mapping, report layout.

FIXED VALUES — the panel's metric names per job (101 names), which metrics
are divided by which configured target, and the report lines.  These are
configuration rows, joined with the computed metric table.
"""

from __future__ import annotations

# job -> metrics the job emits (attainment metrics are listed under ATTAINMENT)
JOB_METRICS: dict[str, list[str]] = {
    "daily_loan_panel": [
        "loan_amount_usd", "loan_amount_vs_month_target", "loan_amount_mtd_vs_target",
        "new_loan_cnt", "old_loan_cnt", "new_loan_amount_usd", "old_loan_amount_usd",
        "new_loan_cnt_vs_target", "old_loan_cnt_vs_target",
        "new_loan_cnt_mtd_vs_target", "old_loan_cnt_mtd_vs_target"],
    "bid_pass_rate_daily": ["revolving_bid_pass_rate"],
    "registration_cohort_funnel": ["new_haslimit_withdraw_rate", "register_apply_rate_t3"],
    "natural_day_funnel": ["reapply_rate_t0", "first_apply_pass_rate"],
    "settlement_reloan_funnel": ["old_haslimit_withdraw_rate"],
    "static_cps": ["static_cps"],
    "first_payment_default": [
        "fpd1_cohort_date", "new_fpd1_amt", "old_fpd1_amt", "fpd7_cohort_date", "new_fpd7_amt",
        "new_fpd7_amt_to_cnt", "old_fpd7_amt", "old_fpd7_amt_to_cnt", "bnpl_fpd1_amt",
        "bnpl_fpd1_due_cnt", "bnpl_fpd7_amt", "bnpl_fpd7_due_cnt"],
    "settled_loans": ["new_settled_cnt", "old_settled_cnt"],
    "limit_application_panel": [
        "bnpl_apply_users", "bnpl_apply_mtd", "bnpl_apply_pass_rate", "new_limit_users",
        "new_limit_pass_rate", "old_limit_users", "old_limit_pass_rate", "new_to_old_limit_pass_rate"],
    "ticket_size_and_term": [
        "new_ticket_usd", "old_ticket_usd", "new_term_days", "old_term_days", "revolving_ticket_usd",
        "revolving_loan_cnt", "revolving_loan_amount_usd", "nonrevolving_ticket_usd", "bnpl_term_days"],
    "limit_to_withdraw_t0_t7": [
        "new_withdraw_rate_t0", "old_withdraw_rate_t0", "new_withdraw_rate_t7", "old_withdraw_rate_t7"],
    "register_to_deal_same_day": ["register_deal_rate"],
    "register_to_limit_t0_t7": ["register_limit_row_t0", "register_limit_row_t7"],
    "cohort_cps_t0_t3": ["cps_t0", "cps_t3"],
    "bnpl_deal_panel": ["bnpl_deal_cnt", "bnpl_deal_cnt_mtd", "bnpl_deal_amount_usd",
                        "bnpl_term_days", "bnpl_down_payment"],
    "same_day_withdraw_dod": ["n2o_same_day_withdraw", "n2o_same_day_withdraw_dod",
                              "other_same_day_withdraw", "other_same_day_withdraw_dod"],
    "revolving_withdraw_dod": ["revolving_withdraw_t0", "revolving_withdraw_t0_dod"],
    "limit_to_bid_dod": ["new_bid_rate_t0", "new_bid_rate_t0_dod", "prime_bid_rate_t0", "prime_bid_rate_t0_dod"],
    "register_to_limit_dod": ["register_limit_user_t0", "register_limit_user_t0_dod"],
    "bid_panel_rollup": ["new_bid_cnt", "old_bid_cnt", "new_bid_pass_rate", "old_bid_pass_rate",
                         "n2o_bid_pass_rate"],
}

# (attainment metric, base metric, target key)
ATTAINMENT: list[tuple[str, str, str]] = [
    ("register_apply_rate_t3_att", "register_apply_rate_t3", "register_apply_rate_t3"),
    ("reapply_rate_t0_att", "reapply_rate_t0", "reapply_rate_t0"),
    ("static_cps_att", "static_cps", "static_cps"),
    ("new_ticket_att", "new_ticket_usd", "new_ticket_usd"),
    ("old_ticket_att", "old_ticket_usd", "old_ticket_usd"),
    ("new_term_att", "new_term_days", "new_term_days"),
    ("old_term_att", "old_term_days", "old_term_days"),
    ("new_withdraw_rate_t0_att", "new_withdraw_rate_t0", "new_withdraw_rate_t0"),
    ("old_withdraw_rate_t0_att", "old_withdraw_rate_t0", "old_withdraw_rate_t0"),
    ("new_withdraw_rate_t7_att", "new_withdraw_rate_t7", "new_withdraw_rate_t7"),
    ("old_withdraw_rate_t7_att", "old_withdraw_rate_t7", "old_withdraw_rate_t7"),
    ("register_deal_rate_att", "register_deal_rate", "register_deal_rate"),
    ("register_limit_row_t0_att", "register_limit_row_t0", "register_limit_row_t0"),
    ("register_limit_row_t7_att", "register_limit_row_t7", "register_limit_row_t7"),
    ("cps_t0_att", "cps_t0", "cps_t0"),
    ("cps_t3_att", "cps_t3", "cps_t3"),
    ("n2o_same_day_withdraw_att", "n2o_same_day_withdraw", "n2o_same_day_withdraw"),
    ("other_same_day_withdraw_att", "other_same_day_withdraw", "other_same_day_withdraw"),
    ("revolving_withdraw_t0_att", "revolving_withdraw_t0", "revolving_withdraw_t0"),
    ("new_bid_rate_t0_att", "new_bid_rate_t0", "new_bid_rate_t0"),
    ("prime_bid_rate_t0_att", "prime_bid_rate_t0", "prime_bid_rate_t0"),
    ("register_limit_user_t0_att", "register_limit_user_t0", "register_limit_user_t0"),
]


def expected_catalogue() -> list[tuple[str, str]]:
    """(job, metric) for every metric the panel should hold; a name emitted
    by two jobs belongs to the later one."""
    owner: dict[str, str] = {}
    for job, names in JOB_METRICS.items():
        for n in names:
            owner[n] = job
    for att, base, _ in ATTAINMENT:
        owner[att] = owner[base]
    return sorted((j, m) for m, j in owner.items())


# Report layouts: (section, [line templates]); ``{metric:fmt}`` placeholders,
# fmt in pct / chg / f1 / f2 / int / raw; ``{$name}`` are text parameters.
HEADER: tuple[str, list[str]] = ("0 header", ["# Daily business report", "Date: {$as_of}  Unit: {$unit}"])

LAYOUT: list[tuple[str, list[str]]] = [
    HEADER,
    ("1 overall", [
        "Loan amount excl. cooling-off: {loan_amount_usd:f1}, of month target: {loan_amount_vs_month_target:pct}, "
        "month to date of month target: {loan_amount_mtd_vs_target:pct}",
        "New-customer limit applicants: {new_limit_users:int}",
        "New-customer loans: {new_loan_cnt:int}, of month target: {new_loan_cnt_vs_target:pct}, "
        "month to date of month target: {new_loan_cnt_mtd_vs_target:pct}",
        "Returning-customer loans: {old_loan_cnt:int}, of month target: {old_loan_cnt_vs_target:pct}, "
        "month to date of month target: {old_loan_cnt_mtd_vs_target:pct}",
        "New-customer loan amount: {new_loan_amount_usd:f1}",
        "New-customer settled loans: {new_settled_cnt:f1}",
        "Returning-customer limit applicants: {old_limit_users:int}",
        "Returning-customer loan amount: {old_loan_amount_usd:f1}",
        "Returning-customer settled loans: {old_settled_cnt:f1}",
        "Static register-to-deal rate: {register_deal_rate:pct}, of month target {register_deal_rate_att:pct}",
    ]),
    ("2 product", [
        "Register-to-limit rate T0: {register_limit_user_t0:pct}, of month target {register_limit_user_t0_att:pct}, "
        "day over day {register_limit_user_t0_dod:chg}",
        "New-customer limit-to-listing rate T0: {new_bid_rate_t0:pct}, of month target {new_bid_rate_t0_att:pct}, "
        "day over day {new_bid_rate_t0_dod:chg}",
        "Prime new-customer limit-to-listing rate T0: {prime_bid_rate_t0:pct}, of month target "
        "{prime_bid_rate_t0_att:pct}, day over day {prime_bid_rate_t0_dod:chg}",
        "New-to-returning same-day withdraw rate T0: {n2o_same_day_withdraw:pct}, of month target "
        "{n2o_same_day_withdraw_att:pct}, day over day {n2o_same_day_withdraw_dod:chg}",
        "Other returning same-day withdraw rate T0: {other_same_day_withdraw:pct}, of month target "
        "{other_same_day_withdraw_att:pct}, day over day {other_same_day_withdraw_dod:chg}",
        "Revolving returning-customer withdraw rate T0: {revolving_withdraw_t0:pct}, of month target "
        "{revolving_withdraw_t0_att:pct}, day over day {revolving_withdraw_t0_dod:chg}",
    ]),
    ("3 acquisition", [
        "First-apply limit rate: {first_apply_pass_rate:pct}",
        "New-customer static CPS excl. cooling-off: {static_cps:f2}, of month target {static_cps_att:pct}",
        "T0 CPS: {cps_t0:f2}",
        "T3 CPS: {cps_t3:f2}, of month target {cps_t3_att:pct}",
    ]),
    ("4 risk", [
        "Natural-day new-customer limit pass rate: {new_limit_pass_rate:pct}",
        "Natural-day new-customer listings: {new_bid_cnt:int}, pass rate: {new_bid_pass_rate:pct}",
        "Natural-day returning-customer limit pass rate: {old_limit_pass_rate:pct}, new-to-returning pass rate: "
        "{new_to_old_limit_pass_rate:pct}",
        "Natural-day returning-customer listings: {old_bid_cnt:int}, pass rate: {old_bid_pass_rate:pct}, "
        "new-to-returning pass rate: {n2o_bid_pass_rate:pct}",
        "Revolving listing pass rate: {revolving_bid_pass_rate:pct}, loans: {revolving_loan_cnt:int}, "
        "amount {revolving_loan_amount_usd:f1}",
        "New-customer average term: {new_term_days:f1}, of month target {new_term_att:pct}, returning-customer "
        "average term {old_term_days:f1}, of month target {old_term_att:pct}",
        "New-customer ticket size: {new_ticket_usd:f1}, of month target {new_ticket_att:pct}",
        "Returning-customer ticket size: {old_ticket_usd:f1}, of month target {old_ticket_att:pct}",
        "Revolving ticket size: {revolving_ticket_usd:f1}, non-revolving ticket size: {nonrevolving_ticket_usd:f1}",
        "New-customer $fpd1/fpd7: {new_fpd1_amt:pct}({new_fpd7_amt:pct})",
        "Returning-customer $fpd1/fpd7: {old_fpd1_amt:pct}({old_fpd7_amt:pct})",
    ]),
    ("5 bnpl", [
        "Applicants: {bnpl_apply_users:int}, pass rate: {bnpl_apply_pass_rate:pct}, month applications: "
        "{bnpl_apply_mtd:int}",
        "Deals: {bnpl_deal_cnt:int}, amount: {bnpl_deal_amount_usd:f1}, month deals: {bnpl_deal_cnt_mtd:int}",
        "Average term: {bnpl_term_days:f1}, average down payment: {bnpl_down_payment:pct}",
        "fpd1 due count: {bnpl_fpd1_due_cnt:int} $fpd1: {bnpl_fpd1_amt:pct}",
        "fpd7 due count: {bnpl_fpd7_due_cnt:int} $fpd7: {bnpl_fpd7_amt:pct}",
    ]),
]

_FULL = dict(LAYOUT)
_OVERALL, _RISK = _FULL["1 overall"], _FULL["4 risk"]

# The older, shorter report: no day-over-day lines, cohort rates in the product section.
COMPACT: list[tuple[str, list[str]]] = [
    HEADER,
    ("1 overall", [
        *_OVERALL[:3],
        _OVERALL[4], _OVERALL[5], _OVERALL[6],
        "Returning-customer loans: {old_loan_cnt:int}",
        _OVERALL[7], _OVERALL[8], _OVERALL[9],
    ]),
    ("2 product", [
        "T3 new-customer register-to-apply rate: {register_apply_rate_t3:pct}, of month target {register_apply_rate_t3_att:pct}",
        "Reloan apply rate T0: {reapply_rate_t0:pct}, of month target {reapply_rate_t0_att:pct}",
        "New-customer limit-to-withdraw rate t0: {new_withdraw_rate_t0:pct}, of month target {new_withdraw_rate_t0_att:pct}",
        "Returning-customer limit-to-withdraw rate t0: {old_withdraw_rate_t0:pct}, of month target {old_withdraw_rate_t0_att:pct}",
        "Register-to-limit rate t0: {register_limit_row_t0:pct}, of month target: {register_limit_row_t0_att:pct}",
    ]),
    ("3 acquisition", _FULL["3 acquisition"]),
    ("4 risk", [
        "Natural-day new-customer limit applicants: {new_limit_users:int}, pass rate: {new_limit_pass_rate:pct}",
        "Natural-day returning-customer limit applicants: {old_limit_users:int}, pass rate: {old_limit_pass_rate:pct}, "
        "new-to-returning pass rate: {new_to_old_limit_pass_rate:pct}",
        *_RISK[4:],
    ]),
    ("5 bnpl", _FULL["5 bnpl"]),
]

LAYOUTS = {"full": LAYOUT, "compact": COMPACT}
REPORT_PARAMS = {"unit": "USD"}
