"""Fixed values of the panel's oracle, apart from the engine's configuration:
targets, attainment, owners of the metrics and report layouts.

FIXED VALUES — they must equal the panel's; a change of the configuration has
to be made here too, or the checks fail.
"""

# (target, value)
TARGETS = [
    ("fx_rate", 284),
    ("month_loan_amount_usd", 4500000),
    ("month_new_loan_cnt", 31000),
    ("month_old_loan_cnt", 93000),
    ("month_old_loan_amount_usd", 2300000),
    ("register_apply_rate_t3", 0.45),
    ("natural_day_register_limit_rate", 0.55),
    ("new_withdraw_rate_t0", 0.7),
    ("new_withdraw_rate_t7", 0.85),
    ("old_withdraw_rate_t7", 0.85),
    ("old_withdraw_rate_t0", 0.65),
    ("new_limit_pass_rate", 0.15),
    ("new_ticket_usd", 24),
    ("old_ticket_usd", 48),
    ("new_term_days", 35),
    ("old_term_days", 50),
    ("static_cps", 13.5),
    ("register_deal_rate", 0.14),
    ("register_limit_row_t0", 0.4),
    ("register_limit_row_t7", 0.5),
    ("cps_t0", 22.4),
    ("cps_t3", 23),
    ("reapply_rate_t0", 0.95),
    ("n2o_same_day_withdraw", 0.56),
    ("other_same_day_withdraw", 0.65),
    ("revolving_withdraw_t0", 0.047),
    ("new_bid_rate_t0", 0.75),
    ("prime_bid_rate_t0", 0.78),
    ("register_limit_user_t0", 0.41),
]

# (attainment metric, base metric, target)
ATTAINMENT = [
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

# job: the metrics it owns, attainment included (a name of two jobs is the later one's)
OWNERS = {
    "daily_loan_panel": "loan_amount_mtd_vs_target loan_amount_usd loan_amount_vs_month_target new_loan_amount_usd "
        "new_loan_cnt new_loan_cnt_mtd_vs_target new_loan_cnt_vs_target old_loan_amount_usd old_loan_cnt "
        "old_loan_cnt_mtd_vs_target old_loan_cnt_vs_target",
    "bid_pass_rate_daily": "revolving_bid_pass_rate",
    "registration_cohort_funnel": "new_haslimit_withdraw_rate register_apply_rate_t3 register_apply_rate_t3_att",
    "natural_day_funnel": "first_apply_pass_rate reapply_rate_t0 reapply_rate_t0_att",
    "settlement_reloan_funnel": "old_haslimit_withdraw_rate",
    "static_cps": "static_cps static_cps_att",
    "first_payment_default": "bnpl_fpd1_amt bnpl_fpd1_due_cnt bnpl_fpd7_amt bnpl_fpd7_due_cnt fpd1_cohort_date "
        "fpd7_cohort_date new_fpd1_amt new_fpd7_amt new_fpd7_amt_to_cnt old_fpd1_amt old_fpd7_amt "
        "old_fpd7_amt_to_cnt",
    "settled_loans": "new_settled_cnt old_settled_cnt",
    "limit_application_panel": "bnpl_apply_mtd bnpl_apply_pass_rate bnpl_apply_users new_limit_pass_rate new_limit_users "
        "new_to_old_limit_pass_rate old_limit_pass_rate old_limit_users",
    "ticket_size_and_term": "new_term_att new_term_days new_ticket_att new_ticket_usd nonrevolving_ticket_usd old_term_att "
        "old_term_days old_ticket_att old_ticket_usd revolving_loan_amount_usd revolving_loan_cnt "
        "revolving_ticket_usd",
    "limit_to_withdraw_t0_t7": "new_withdraw_rate_t0 new_withdraw_rate_t0_att new_withdraw_rate_t7 new_withdraw_rate_t7_att "
        "old_withdraw_rate_t0 old_withdraw_rate_t0_att old_withdraw_rate_t7 old_withdraw_rate_t7_att",
    "register_to_deal_same_day": "register_deal_rate register_deal_rate_att",
    "register_to_limit_t0_t7": "register_limit_row_t0 register_limit_row_t0_att register_limit_row_t7 register_limit_row_t7_att",
    "cohort_cps_t0_t3": "cps_t0 cps_t0_att cps_t3 cps_t3_att",
    "bnpl_deal_panel": "bnpl_deal_amount_usd bnpl_deal_cnt bnpl_deal_cnt_mtd bnpl_down_payment bnpl_term_days",
    "same_day_withdraw_dod": "n2o_same_day_withdraw n2o_same_day_withdraw_att n2o_same_day_withdraw_dod "
        "other_same_day_withdraw other_same_day_withdraw_att other_same_day_withdraw_dod",
    "revolving_withdraw_dod": "revolving_withdraw_t0 revolving_withdraw_t0_att revolving_withdraw_t0_dod",
    "limit_to_bid_dod": "new_bid_rate_t0 new_bid_rate_t0_att new_bid_rate_t0_dod prime_bid_rate_t0 prime_bid_rate_t0_att "
        "prime_bid_rate_t0_dod",
    "register_to_limit_dod": "register_limit_user_t0 register_limit_user_t0_att register_limit_user_t0_dod",
    "bid_panel_rollup": "n2o_bid_pass_rate new_bid_cnt new_bid_pass_rate old_bid_cnt old_bid_pass_rate",
}

# (section, line, template) of the full layout
FULL = [
    ("0 header", 1, "# Daily business report"),
    ("0 header", 2, "Date: {$as_of}  Unit: {$unit}"),
    ("1 overall", 1, "Loan amount excl. cooling-off: {loan_amount_usd:f1}, of month target: {loan_amount_vs_month_target:pct}, month to date of month target: {loan_amount_mtd_vs_target:pct}"),
    ("1 overall", 2, "New-customer limit applicants: {new_limit_users:int}"),
    ("1 overall", 3, "New-customer loans: {new_loan_cnt:int}, of month target: {new_loan_cnt_vs_target:pct}, month to date of month target: {new_loan_cnt_mtd_vs_target:pct}"),
    ("1 overall", 4, "Returning-customer loans: {old_loan_cnt:int}, of month target: {old_loan_cnt_vs_target:pct}, month to date of month target: {old_loan_cnt_mtd_vs_target:pct}"),
    ("1 overall", 5, "New-customer loan amount: {new_loan_amount_usd:f1}"),
    ("1 overall", 6, "New-customer settled loans: {new_settled_cnt:f1}"),
    ("1 overall", 7, "Returning-customer limit applicants: {old_limit_users:int}"),
    ("1 overall", 8, "Returning-customer loan amount: {old_loan_amount_usd:f1}"),
    ("1 overall", 9, "Returning-customer settled loans: {old_settled_cnt:f1}"),
    ("1 overall", 10, "Static register-to-deal rate: {register_deal_rate:pct}, of month target {register_deal_rate_att:pct}"),
    ("2 product", 1, "Register-to-limit rate T0: {register_limit_user_t0:pct}, of month target {register_limit_user_t0_att:pct}, day over day {register_limit_user_t0_dod:chg}"),
    ("2 product", 2, "New-customer limit-to-listing rate T0: {new_bid_rate_t0:pct}, of month target {new_bid_rate_t0_att:pct}, day over day {new_bid_rate_t0_dod:chg}"),
    ("2 product", 3, "Prime new-customer limit-to-listing rate T0: {prime_bid_rate_t0:pct}, of month target {prime_bid_rate_t0_att:pct}, day over day {prime_bid_rate_t0_dod:chg}"),
    ("2 product", 4, "New-to-returning same-day withdraw rate T0: {n2o_same_day_withdraw:pct}, of month target {n2o_same_day_withdraw_att:pct}, day over day {n2o_same_day_withdraw_dod:chg}"),
    ("2 product", 5, "Other returning same-day withdraw rate T0: {other_same_day_withdraw:pct}, of month target {other_same_day_withdraw_att:pct}, day over day {other_same_day_withdraw_dod:chg}"),
    ("2 product", 6, "Revolving returning-customer withdraw rate T0: {revolving_withdraw_t0:pct}, of month target {revolving_withdraw_t0_att:pct}, day over day {revolving_withdraw_t0_dod:chg}"),
    ("3 acquisition", 1, "First-apply limit rate: {first_apply_pass_rate:pct}"),
    ("3 acquisition", 2, "New-customer static CPS excl. cooling-off: {static_cps:f2}, of month target {static_cps_att:pct}"),
    ("3 acquisition", 3, "T0 CPS: {cps_t0:f2}"),
    ("3 acquisition", 4, "T3 CPS: {cps_t3:f2}, of month target {cps_t3_att:pct}"),
    ("4 risk", 1, "Natural-day new-customer limit pass rate: {new_limit_pass_rate:pct}"),
    ("4 risk", 2, "Natural-day new-customer listings: {new_bid_cnt:int}, pass rate: {new_bid_pass_rate:pct}"),
    ("4 risk", 3, "Natural-day returning-customer limit pass rate: {old_limit_pass_rate:pct}, new-to-returning pass rate: {new_to_old_limit_pass_rate:pct}"),
    ("4 risk", 4, "Natural-day returning-customer listings: {old_bid_cnt:int}, pass rate: {old_bid_pass_rate:pct}, new-to-returning pass rate: {n2o_bid_pass_rate:pct}"),
    ("4 risk", 5, "Revolving listing pass rate: {revolving_bid_pass_rate:pct}, loans: {revolving_loan_cnt:int}, amount {revolving_loan_amount_usd:f1}"),
    ("4 risk", 6, "New-customer average term: {new_term_days:f1}, of month target {new_term_att:pct}, returning-customer average term {old_term_days:f1}, of month target {old_term_att:pct}"),
    ("4 risk", 7, "New-customer ticket size: {new_ticket_usd:f1}, of month target {new_ticket_att:pct}"),
    ("4 risk", 8, "Returning-customer ticket size: {old_ticket_usd:f1}, of month target {old_ticket_att:pct}"),
    ("4 risk", 9, "Revolving ticket size: {revolving_ticket_usd:f1}, non-revolving ticket size: {nonrevolving_ticket_usd:f1}"),
    ("4 risk", 10, "New-customer $fpd1/fpd7: {new_fpd1_amt:pct}({new_fpd7_amt:pct})"),
    ("4 risk", 11, "Returning-customer $fpd1/fpd7: {old_fpd1_amt:pct}({old_fpd7_amt:pct})"),
    ("5 bnpl", 1, "Applicants: {bnpl_apply_users:int}, pass rate: {bnpl_apply_pass_rate:pct}, month applications: {bnpl_apply_mtd:int}"),
    ("5 bnpl", 2, "Deals: {bnpl_deal_cnt:int}, amount: {bnpl_deal_amount_usd:f1}, month deals: {bnpl_deal_cnt_mtd:int}"),
    ("5 bnpl", 3, "Average term: {bnpl_term_days:f1}, average down payment: {bnpl_down_payment:pct}"),
    ("5 bnpl", 4, "fpd1 due count: {bnpl_fpd1_due_cnt:int} $fpd1: {bnpl_fpd1_amt:pct}"),
    ("5 bnpl", 5, "fpd7 due count: {bnpl_fpd7_due_cnt:int} $fpd7: {bnpl_fpd7_amt:pct}"),
]

# (section, line, template) of the compact layout
COMPACT = [
    ("0 header", 1, "# Daily business report"),
    ("0 header", 2, "Date: {$as_of}  Unit: {$unit}"),
    ("1 overall", 1, "Loan amount excl. cooling-off: {loan_amount_usd:f1}, of month target: {loan_amount_vs_month_target:pct}, month to date of month target: {loan_amount_mtd_vs_target:pct}"),
    ("1 overall", 2, "New-customer limit applicants: {new_limit_users:int}"),
    ("1 overall", 3, "New-customer loans: {new_loan_cnt:int}, of month target: {new_loan_cnt_vs_target:pct}, month to date of month target: {new_loan_cnt_mtd_vs_target:pct}"),
    ("1 overall", 4, "New-customer loan amount: {new_loan_amount_usd:f1}"),
    ("1 overall", 5, "New-customer settled loans: {new_settled_cnt:f1}"),
    ("1 overall", 6, "Returning-customer limit applicants: {old_limit_users:int}"),
    ("1 overall", 7, "Returning-customer loans: {old_loan_cnt:int}"),
    ("1 overall", 8, "Returning-customer loan amount: {old_loan_amount_usd:f1}"),
    ("1 overall", 9, "Returning-customer settled loans: {old_settled_cnt:f1}"),
    ("1 overall", 10, "Static register-to-deal rate: {register_deal_rate:pct}, of month target {register_deal_rate_att:pct}"),
    ("2 product", 1, "T3 new-customer register-to-apply rate: {register_apply_rate_t3:pct}, of month target {register_apply_rate_t3_att:pct}"),
    ("2 product", 2, "Reloan apply rate T0: {reapply_rate_t0:pct}, of month target {reapply_rate_t0_att:pct}"),
    ("2 product", 3, "New-customer limit-to-withdraw rate t0: {new_withdraw_rate_t0:pct}, of month target {new_withdraw_rate_t0_att:pct}"),
    ("2 product", 4, "Returning-customer limit-to-withdraw rate t0: {old_withdraw_rate_t0:pct}, of month target {old_withdraw_rate_t0_att:pct}"),
    ("2 product", 5, "Register-to-limit rate t0: {register_limit_row_t0:pct}, of month target: {register_limit_row_t0_att:pct}"),
    ("3 acquisition", 1, "First-apply limit rate: {first_apply_pass_rate:pct}"),
    ("3 acquisition", 2, "New-customer static CPS excl. cooling-off: {static_cps:f2}, of month target {static_cps_att:pct}"),
    ("3 acquisition", 3, "T0 CPS: {cps_t0:f2}"),
    ("3 acquisition", 4, "T3 CPS: {cps_t3:f2}, of month target {cps_t3_att:pct}"),
    ("4 risk", 1, "Natural-day new-customer limit applicants: {new_limit_users:int}, pass rate: {new_limit_pass_rate:pct}"),
    ("4 risk", 2, "Natural-day returning-customer limit applicants: {old_limit_users:int}, pass rate: {old_limit_pass_rate:pct}, new-to-returning pass rate: {new_to_old_limit_pass_rate:pct}"),
    ("4 risk", 3, "Revolving listing pass rate: {revolving_bid_pass_rate:pct}, loans: {revolving_loan_cnt:int}, amount {revolving_loan_amount_usd:f1}"),
    ("4 risk", 4, "New-customer average term: {new_term_days:f1}, of month target {new_term_att:pct}, returning-customer average term {old_term_days:f1}, of month target {old_term_att:pct}"),
    ("4 risk", 5, "New-customer ticket size: {new_ticket_usd:f1}, of month target {new_ticket_att:pct}"),
    ("4 risk", 6, "Returning-customer ticket size: {old_ticket_usd:f1}, of month target {old_ticket_att:pct}"),
    ("4 risk", 7, "Revolving ticket size: {revolving_ticket_usd:f1}, non-revolving ticket size: {nonrevolving_ticket_usd:f1}"),
    ("4 risk", 8, "New-customer $fpd1/fpd7: {new_fpd1_amt:pct}({new_fpd7_amt:pct})"),
    ("4 risk", 9, "Returning-customer $fpd1/fpd7: {old_fpd1_amt:pct}({old_fpd7_amt:pct})"),
    ("5 bnpl", 1, "Applicants: {bnpl_apply_users:int}, pass rate: {bnpl_apply_pass_rate:pct}, month applications: {bnpl_apply_mtd:int}"),
    ("5 bnpl", 2, "Deals: {bnpl_deal_cnt:int}, amount: {bnpl_deal_amount_usd:f1}, month deals: {bnpl_deal_cnt_mtd:int}"),
    ("5 bnpl", 3, "Average term: {bnpl_term_days:f1}, average down payment: {bnpl_down_payment:pct}"),
    ("5 bnpl", 4, "fpd1 due count: {bnpl_fpd1_due_cnt:int} $fpd1: {bnpl_fpd1_amt:pct}"),
    ("5 bnpl", 5, "fpd7 due count: {bnpl_fpd7_due_cnt:int} $fpd7: {bnpl_fpd7_amt:pct}"),
]
