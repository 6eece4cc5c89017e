"""The panel's metrics as formulas over additive terms.

``formulas`` gives, for each job in order, its metrics as columns over the merged
terms of ``operators.additive``.  A sum over nothing is 0 where it is itself the
metric (``total``); a rate over nothing is NULL, or 0 on the reporting day where
the panel says so (``or0``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark.functions import safe_div
from tallyspark.operators.additive import Terms, merge
from tallyspark.operators.panel import metric_table, target_attainment, targets_frame
from tallyspark.plans.catalogue import ATTAINMENT


def total(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("double")


def or0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _ymd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("double")


def formulas(T: Terms, p: P.Params) -> dict[str, dict[str, Column]]:
    t, fx = p.targets, F.lit(p.fx)
    cash, bnpl = p.cash_product, p.bnpl_product
    out: dict[str, dict[str, Column]] = {}

    def deals(measure, at=0, **seg):
        return total(T("daily_loan_panel", measure, at, refunded="no", **seg))

    usd = F.round(deals("deal_amount") / fx, 1)
    month_usd, month_new, month_old = (F.lit(float(t[k])) for k in ("month_loan_amount_usd", "month_new_loan_cnt", "month_old_loan_cnt"))
    out["daily_loan_panel"] = {
        "loan_amount_usd": usd,
        "loan_amount_vs_month_target": F.round(usd / month_usd, 4),
        "loan_amount_mtd_vs_target": F.round(deals("deal_amount", "mtd") / fx / month_usd, 4),
        "new_loan_cnt": deals("deal_cnt", user_type="new"),
        "old_loan_cnt": deals("deal_cnt", user_type="old"),
        "new_loan_amount_usd": F.round(deals("deal_amount", user_type="new") / fx, 1),
        "old_loan_amount_usd": F.round(deals("deal_amount", user_type="old") / fx, 1),
        "new_loan_cnt_vs_target": F.round(deals("deal_cnt", user_type="new") / month_new, 4),
        "old_loan_cnt_vs_target": F.round(deals("deal_cnt", user_type="old") / month_old, 4),
        "new_loan_cnt_mtd_vs_target": F.round(deals("deal_cnt", "mtd", user_type="new") / month_new, 4),
        "old_loan_cnt_mtd_vs_target": F.round(deals("deal_cnt", "mtd", user_type="old") / month_old, 4),
    }

    j2 = "bid_pass_rate_daily"
    out[j2] = {"revolving_bid_pass_rate": F.when(T(j2, "listing_cnt") > 0, or0(safe_div(T(j2, "pass_num"), T(j2, "flag_cnt"))))}

    j3 = "registration_cohort_funnel"
    out[j3] = {"new_haslimit_withdraw_rate": or0(safe_div(T(j3, "withdraw_succ_user_cnt"), T(j3, "fst_has_limit_user_cnt"))),
               "register_apply_rate_t3": or0(safe_div(T(j3, "apply_limit_user_cnt", 3), T(j3, "register_user_cnt", 3)))}

    j4 = "natural_day_funnel"
    out[j4] = {"reapply_rate_t0": or0(safe_div(T(j4, "apply_limit_user_cnt_t0"), T(j4, "repay_user_cnt"))),
               "first_apply_pass_rate": or0(safe_div(T(j4, "fst_apply_has_limit_user_cnt"), T(j4, "fst_apply_limit_user_cnt")))}

    j5 = "settlement_reloan_funnel"
    out[j5] = {"old_haslimit_withdraw_rate": or0(safe_div(T(j5, "reloan_withdraw_user_cnt"), T(j5, "has_limit_user_cnt")))}

    j6 = "static_cps"
    out[j6] = {"static_cps": or0(safe_div(T(j6, "cost"), T(j6, "conversions")))}

    j7 = "first_payment_default"

    def due(measure, age, **seg):  # age 1 is due on the reporting day, age 7 six days before
        return T(j7, measure, age - 1, **seg)

    def amt(age, **seg):
        return safe_div(due(f"dpd{age}_principal", age, **seg), due("principal_sum", age, **seg))

    def cnt(age, **seg):
        return safe_div(due(f"dpd{age}_cnt", age, **seg), due("due_cnt", age, **seg))

    def cohort(age, **seg):
        return F.when(due("due_cnt", age, **seg) > 0, _ymd(F.date_sub("as_of", 14 + age - 1)))

    n = dict(product_user_type="new", asset_product=cash)
    o = dict(product_user_type="old", asset_product=cash)
    b = dict(asset_product=bnpl)
    out[j7] = {
        "fpd1_cohort_date": cohort(1, **n), "new_fpd1_amt": amt(1, **n), "old_fpd1_amt": amt(1, **o),
        "fpd7_cohort_date": cohort(7, **n), "new_fpd7_amt": amt(7, **n),
        "new_fpd7_amt_to_cnt": F.try_divide(amt(7, **n), cnt(7, **n)),
        "old_fpd7_amt": amt(7, **o), "old_fpd7_amt_to_cnt": F.try_divide(amt(7, **o), cnt(7, **o)),
        "bnpl_fpd1_amt": amt(1, **b), "bnpl_fpd1_due_cnt": total(due("due_cnt", 1, **b)),
        "bnpl_fpd7_amt": amt(7, **b), "bnpl_fpd7_due_cnt": total(due("due_cnt", 7, **b)),
    }

    j8 = "settled_loans"
    out[j8] = {f"{u}_settled_cnt": total(T(j8, "settled_cnt", user_type=u)) for u in ("new", "old")}

    j9 = "limit_application_panel"

    def asked(measure, at=0, biz=cash, **seg):
        return T(j9, measure, at, biz_type=biz, **seg)

    out[j9] = {
        "bnpl_apply_users": total(asked("limit_num", biz=bnpl)),
        "bnpl_apply_mtd": total(asked("num", "mtd", biz=bnpl)),
        "bnpl_apply_pass_rate": safe_div(total(asked("is_pass", biz=bnpl)), total(asked("num", biz=bnpl))),
        "new_limit_users": total(asked("limit_num", is_reloan="0")),
        "new_limit_pass_rate": safe_div(asked("is_pass", is_reloan="0"), asked("flag_cnt", is_reloan="0")),
        "old_limit_users": total(asked("limit_num", is_reloan="1")),
        "old_limit_pass_rate": safe_div(asked("is_pass", is_reloan="1"), asked("flag_cnt", is_reloan="1")),
        "new_to_old_limit_pass_rate": safe_div(asked("n2o_pass", is_reloan="1"), asked("n2o_cnt", is_reloan="1")),
    }

    j10 = "ticket_size_and_term"

    def loans(measure, product=cash, **seg):
        return total(T(j10, measure, asset_product=product, **seg))

    def ticket(**seg):
        return F.try_divide(loans("amount_sum", **seg) / fx, loans("num", **seg))

    def term(days, product=cash, **seg):
        return safe_div(loans("period_multi_amount", product, **seg), loans("amount_sum", product, **seg)) * F.lit(float(days))

    re = dict(is_reloan="1", re_type="re")
    out[j10] = {
        "new_ticket_usd": ticket(is_reloan="0"), "old_ticket_usd": ticket(is_reloan="1"),
        "new_term_days": term(P.TERM_DAYS_CASH, is_reloan="0"), "old_term_days": term(P.TERM_DAYS_CASH, is_reloan="1"),
        "revolving_ticket_usd": ticket(**re), "revolving_loan_cnt": loans("num", **re),
        "revolving_loan_amount_usd": loans("amount_sum", **re) / fx,
        "nonrevolving_ticket_usd": ticket(is_reloan="1", re_type="notre"),
        "bnpl_term_days": term(P.TERM_DAYS_BNPL, bnpl),
    }

    j11 = "limit_to_withdraw_t0_t7"

    def taken(w, back, kind):
        return or0(safe_div(T(j11, f"{w}_conv", back, is_reloan=kind), T(j11, f"{w}_rows", back, is_reloan=kind)))

    out[j11] = {f"{u}_withdraw_rate_{w}": taken(w, back, kind)
                for w, back in (("t0", 0), ("t7", 7)) for u, kind in (("new", "0"), ("old", "1"))}

    j12 = "register_to_deal_same_day"
    out[j12] = {"register_deal_rate": safe_div(F.coalesce(T(j12, "deal_cnt"), F.lit(0)), T(j12, "reg_cnt"))}

    j13 = "register_to_limit_t0_t7"
    out[j13] = {f"register_limit_row_{w}": safe_div(T(j13, f"{w}_conv", back), T(j13, f"{w}_rows", back)) for w, back in (("t0", 0), ("t7", 7))}

    j14 = "cohort_cps_t0_t3"
    out[j14] = {"cps_t0": safe_div(T(j14, "cost"), T(j14, "fst_withdraw_succ_cnt")),
                "cps_t3": safe_div(T(j14, "cost", 2), T(j14, "t3_withdraw_user_num", 2))}

    j15 = "bnpl_deal_panel"
    out[j15] = {
        "bnpl_deal_cnt": total(T(j15, "deal_cnt")), "bnpl_deal_cnt_mtd": total(T(j15, "deal_cnt", "open")),
        "bnpl_deal_amount_usd": total(T(j15, "amount_sum")) / fx,
        "bnpl_term_days": safe_div(T(j15, "period_sum"), T(j15, "period_cnt")) * F.lit(float(P.TERM_DAYS_BNPL)),
        "bnpl_down_payment": safe_div(T(j15, "down_sum"), T(j15, "down_cnt")) / F.lit(100.0),
    }

    def change(name: str, job: str, num: str, den: str, before: str | None = None, **seg) -> dict[str, Column]:
        now = or0(safe_div(T(job, num, **seg), T(job, den, **seg)))
        return {name: now, f"{name}_dod": now - safe_div(T(job, before or num, 1, **seg), T(job, den, 1, **seg))}

    j16, j17, j18, j19 = "same_day_withdraw_dod", "revolving_withdraw_dod", "limit_to_bid_dod", "register_to_limit_dod"
    out[j16] = {**change("n2o_same_day_withdraw", j16, "withdraw_cnt", "row_cnt", loan_type="n2o"),
                **change("other_same_day_withdraw", j16, "withdraw_cnt", "row_cnt", loan_type="other")}
    out[j17] = change("revolving_withdraw_t0", j17, "first_withdraw_cnt", "has_limit_cnt", before="any_withdraw_cnt")
    out[j18] = {**change("new_bid_rate_t0", j18, "bid_cnt", "has_limit_cnt"),
                **change("prime_bid_rate_t0", j18, "prime_bid_cnt", "prime_has_limit_cnt")}
    out[j19] = change("register_limit_user_t0", j19, "lim_cnt", "reg_cnt")

    j20 = "bid_panel_rollup"

    def bids(measure, **seg):
        return total(T(j20, measure, **seg))

    o2 = dict(is_reloan="1", is_new_to_old="1")
    out[j20] = {
        "new_bid_cnt": bids("listing_num", is_reloan="0"), "old_bid_cnt": bids("listing_num", is_reloan="1"),
        "new_bid_pass_rate": safe_div(bids("pass_num", is_reloan="0"), bids("listing_num", is_reloan="0")),
        "old_bid_pass_rate": safe_div(bids("pass_num", is_reloan="1"), bids("listing_num", is_reloan="1")),
        "n2o_bid_pass_rate": safe_div(bids("pass_num", **o2), bids("listing_num", **o2)),
    }
    return out


def job_metrics(parts: DataFrame, p: P.Params, as_ofs: Iterable[_dt.date]) -> DataFrame:
    """(as_of, job, metric, value) of all jobs' metrics; the later job wins on a shared name."""
    T = Terms()
    every = formulas(T, p)
    cells = [F.struct(F.lit(i).alias("job_ordinal"), F.lit(job).alias("job"), F.lit(name).alias("metric"), c.cast("double").alias("value"))
             for i, (job, metrics) in enumerate(every.items()) for name, c in metrics.items()]
    rows = merge(parts, T, as_ofs).select("as_of", F.explode(F.array(*cells)).alias("r")).select("as_of", "r.*")
    return metric_table(rows)


def panel_of_days(parts: DataFrame, p: P.Params, as_ofs: Iterable[_dt.date]) -> DataFrame:
    """(as_of, job, metric, value): the whole panel, attainment included, of every reporting day."""
    spark = parts.sparkSession
    table = job_metrics(parts, p, as_ofs)
    mapping = spark.createDataFrame(ATTAINMENT, "att_metric string, base_metric string, target_key string")
    att = target_attainment(table, targets_frame(spark, p.targets), mapping, p.default_target)
    return table.unionByName(att.select("as_of", "job", "metric", "value"))


def touched(p: P.Params, partial_days: Mapping[str, Iterable[_dt.date]], as_ofs: Iterable[_dt.date]) -> set[_dt.date]:
    """The reporting days whose panel uses any of these partial days (job -> days)."""
    T, as_ofs = Terms(), set(as_ofs)
    formulas(T, p)
    return {a for job, days in partial_days.items() for day in days for a in T.reach(job, day, as_ofs)}
