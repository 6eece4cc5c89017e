"""The twenty metric jobs.

Each job has two entry points:

* ``daily(roles, params, restrict=False)`` — the job's measures for *every*
  day (and segment) of its input: the reference's as_of computation run for
  all as_of days at once.  With ``restrict=True`` the inputs are first cut to
  the period the as_of slice needs (month to date, two days, cohort days), and
  the cut is written on raw columns so it reaches the parquet scan.
* ``metrics(roles, params)`` — the named metrics at ``params.as_of`` as long
  rows ``(job, metric, value)``, computed as conditional aggregates over the
  restricted daily frame (no row-level data reaches the driver).

Date-valued metrics (cohort dates) are reported as yyyymmdd numbers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark.functions import attr, day, flag, safe_div
from tallyspark.operators.credit import first_payment_default, settled_loans
from tallyspark.operators.joins import (allow_list_join, chained_enrichment, cohort_conversion,
                                        cost_per_acquisition, first_in_window_conversion, membership_flag, same_day_conversion,
                                        with_versions)
from tallyspark.operators.panel import day_over_day_change, to_long
from tallyspark.operators.periods import period_filter, slice_max, slice_mean, slice_pick, slice_sum
from tallyspark.operators.rollups import daily_rollup, funnel_ratio, mtd_cumulative


# ---------------------------------------------------------------- slices
def cut(df: DataFrame, p: P.Params, date_col: str, kind: str, **kw) -> DataFrame:
    """The rows of the period that the reporting days of ``p`` need."""
    return period_filter(df, date_col, p.as_of, kind, until=p.until, **kw)


def _on(day_col: str, d: _dt.date, cond: Column | None = None) -> Column:
    c = F.col(day_col) == F.lit(d)
    return c if cond is None else c & cond


def dbl(c: Column) -> Column:
    return c.cast("double")


def ymd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("double")


def _biz(*ids: str) -> Column:
    return attr("biz_id").isin(*ids)


def _eq_int(key: str, v: int) -> Column:
    return attr(key, "int") == v


# ---------------------------------------------------------------- J1
def daily_loan_panel(R, p: P.Params, restrict: bool = False, exact: bool = False) -> DataFrame:
    d = R.daily_deals
    if restrict:
        d = cut(d, p, "biz_date", "mtd")
    d = (d.filter(F.col("product_type") != 32)
          .withColumn("refunded", F.when(F.col("is_calm_period_repay") == 1, "yes").otherwise("no")))
    g = d.groupBy("biz_date", "user_type", "refunded").agg(
        F.sum("deal_cnt").cast("bigint").alias("deal_cnt"),
        F.sum("deal_users").cast("bigint").alias("deal_users"),
        F.sum("deal_amount").alias("deal_amount"))
    g = mtd_cumulative(g, "biz_date", ["user_type", "refunded"],
                       {"mtd_deal_cnt": "deal_cnt", "mtd_deal_amount": "deal_amount"})
    if exact:  # decimal sums for slices that add several rows
        return g
    return g.select("biz_date", "user_type", "refunded", "deal_cnt", "deal_users",
                    dbl(F.col("deal_amount")).alias("deal_amount"),
                    F.col("mtd_deal_cnt").cast("bigint").alias("mtd_deal_cnt"),
                    dbl(F.col("mtd_deal_amount")).alias("mtd_deal_amount"),
                    F.round(dbl(F.col("deal_amount")) / F.lit(p.fx), 1).alias("amount_usd"))


def daily_loan_panel_metrics(R, p: P.Params) -> DataFrame:
    g = daily_loan_panel(R, p, restrict=True, exact=True)
    t, fx = p.targets, F.lit(p.fx)
    no = F.col("refunded") == "no"
    today = _on("biz_date", p.as_of, no)
    upto = (F.col("biz_date") <= F.lit(p.as_of)) & no
    new, old = F.col("user_type") == "new", F.col("user_type") == "old"
    amt_usd = F.round(dbl(slice_sum("deal_amount", today)) / fx, 1)
    w = g.agg(
        amt_usd.alias("loan_amount_usd"),
        F.round(amt_usd / F.lit(float(t["month_loan_amount_usd"])), 4).alias("loan_amount_vs_month_target"),
        F.round(dbl(slice_sum("deal_amount", no)) / fx / F.lit(float(t["month_loan_amount_usd"])), 4)
         .alias("loan_amount_mtd_vs_target"),
        slice_sum("deal_cnt", today & new).alias("new_loan_cnt"),
        slice_sum("deal_cnt", today & old).alias("old_loan_cnt"),
        F.round(dbl(slice_sum("deal_amount", today & new)) / fx, 1).alias("new_loan_amount_usd"),
        F.round(dbl(slice_sum("deal_amount", today & old)) / fx, 1).alias("old_loan_amount_usd"),
        F.round(dbl(slice_sum("deal_cnt", today & new)) / F.lit(float(t["month_new_loan_cnt"])), 4)
         .alias("new_loan_cnt_vs_target"),
        F.round(dbl(slice_sum("deal_cnt", today & old)) / F.lit(float(t["month_old_loan_cnt"])), 4)
         .alias("old_loan_cnt_vs_target"),
        F.round(dbl(slice_sum("deal_cnt", upto & new)) / F.lit(float(t["month_new_loan_cnt"])), 4)
         .alias("new_loan_cnt_mtd_vs_target"),
        F.round(dbl(slice_sum("deal_cnt", upto & old)) / F.lit(float(t["month_old_loan_cnt"])), 4)
         .alias("old_loan_cnt_mtd_vs_target"),
    )
    return to_long(w, "daily_loan_panel")


# ---------------------------------------------------------------- J2
def bid_pass_sums(R, p: P.Params, restrict: bool = False) -> DataFrame:
    d = R.decisions
    if restrict:
        d = cut(d, p, "inserttime", "mtd", part="dt")
    d = d.filter(_biz(P.BIZ_LISTING_REVOLVING) & _eq_int("is_reloan", 1))
    flag_ = attr("process_flag", "int")
    return d.groupBy(day("inserttime").alias("dt")).agg(
        F.sum(flag_).alias("pass_num"), F.count(flag_).alias("flag_cnt"), F.count(F.lit(1)).alias("listing_cnt"))


def bid_pass_rate_daily(R, p: P.Params, restrict: bool = False) -> DataFrame:
    g = bid_pass_sums(R, p, restrict)
    return g.select("dt", F.coalesce(safe_div("pass_num", "flag_cnt"), F.lit(0.0)).alias("pass_rate"), "listing_cnt")


def bid_pass_rate_daily_metrics(R, p: P.Params) -> DataFrame:
    g = bid_pass_rate_daily(R, p, restrict=True)
    w = g.agg(slice_max("pass_rate", _on("dt", p.as_of)).alias("revolving_bid_pass_rate"))
    return to_long(w, "bid_pass_rate_daily")


# ---------------------------------------------------------------- J3
def registration_cohort_funnel(R, p: P.Params, restrict: bool = False) -> DataFrame:
    f = R.register_funnel
    if restrict:
        f = cut(f, p, "register_date", "trailing", n=3)
    f = f.filter(F.col("asset_product") == p.cash_product)
    cols = ["register_user_cnt", "apply_limit_user_cnt", "fst_has_limit_user_cnt", "withdraw_succ_user_cnt"]
    g = daily_rollup(f, ["register_date"], {c: c for c in cols})
    g = g.select("register_date", *[F.col(c).cast("bigint").alias(c) for c in cols]).na.fill(0, cols)
    return funnel_ratio(g, [("register_apply_rate", "apply_limit_user_cnt", "register_user_cnt"),
                            ("haslimit_withdraw_rate", "withdraw_succ_user_cnt", "fst_has_limit_user_cnt")])


def registration_cohort_funnel_metrics(R, p: P.Params) -> DataFrame:
    g = registration_cohort_funnel(R, p, restrict=True)
    w = g.agg(slice_sum("haslimit_withdraw_rate", _on("register_date", p.as_of)).alias("new_haslimit_withdraw_rate"),
              slice_sum("register_apply_rate", _on("register_date", p.days_before(3))).alias("register_apply_rate_t3"))
    return to_long(w, "registration_cohort_funnel")


# ---------------------------------------------------------------- J4
def natural_day_funnel(R, p: P.Params, restrict: bool = False) -> DataFrame:
    f = R.natural_day_funnel
    if restrict:
        f = cut(f, p, "biz_date", "mtd")
    f = f.filter(F.col("asset_product") == p.cash_product)
    cols = ["register_user_cnt", "fst_apply_limit_user_cnt", "repay_user_cnt",
            "apply_limit_user_cnt_t0", "fst_apply_has_limit_user_cnt"]
    g = daily_rollup(f, ["biz_date"], {c: c for c in cols})
    g = g.select("biz_date", *[F.col(c).cast("bigint").alias(c) for c in cols])
    return funnel_ratio(g, [("reapply_rate_t0", "apply_limit_user_cnt_t0", "repay_user_cnt"),
                            ("first_apply_pass_rate", "fst_apply_has_limit_user_cnt", "fst_apply_limit_user_cnt")])


def natural_day_funnel_metrics(R, p: P.Params) -> DataFrame:
    g = natural_day_funnel(R, p, restrict=True)
    on = _on("biz_date", p.as_of)
    w = g.agg(slice_sum("reapply_rate_t0", on).alias("reapply_rate_t0"),
              slice_sum("first_apply_pass_rate", on).alias("first_apply_pass_rate"))
    return to_long(w, "natural_day_funnel")


# ---------------------------------------------------------------- J5
def settlement_reloan_funnel(R, p: P.Params, restrict: bool = False) -> DataFrame:
    f = R.settle_funnel
    if restrict:
        f = cut(f, p, "repay_date", "mtd")
    cols = ["has_limit_user_cnt", "reloan_withdraw_user_cnt"]
    g = daily_rollup(f, ["repay_date"], {c: c for c in cols})
    g = g.select("repay_date", *[F.col(c).cast("bigint").alias(c) for c in cols])
    return funnel_ratio(g, [("old_haslimit_withdraw_rate", "reloan_withdraw_user_cnt", "has_limit_user_cnt")])


def settlement_reloan_funnel_metrics(R, p: P.Params) -> DataFrame:
    g = settlement_reloan_funnel(R, p, restrict=True)
    w = g.agg(slice_sum("old_haslimit_withdraw_rate", _on("repay_date", p.as_of)).alias("old_haslimit_withdraw_rate"))
    return to_long(w, "settlement_reloan_funnel")


# ---------------------------------------------------------------- J6
def static_cps(R, p: P.Params, restrict: bool = False) -> DataFrame:
    cost = R.ad_cost.filter(F.col("fst_level_channel").isin(*p.paid_channels))
    conv = R.daily_conversions.filter(F.col("asset_product") == p.cash_product)
    if restrict:  # the cut is applied to both inputs of the join
        cost = cut(cost, p, "biz_date", "mtd")
        conv = cut(conv, p, "biz_date", "mtd")
    return cost_per_acquisition(cost, conv, "biz_date", "cost", "fst_withdraw_succ_cnt", "s_cps")


def static_cps_metrics(R, p: P.Params) -> DataFrame:
    g = static_cps(R, p, restrict=True)
    w = g.agg(slice_sum("s_cps", _on("biz_date", p.as_of)).alias("static_cps"))
    return to_long(w, "static_cps")


# ---------------------------------------------------------------- J7
def default_sums(R, p: P.Params, restrict: bool) -> DataFrame:
    inst = R.installments
    if restrict:
        inst = cut(inst, p, "due_date", "days",
                   days=[p.as_of, p.as_of - _dt.timedelta(days=6)])
    return first_payment_default(inst, R.listings, [p.cash_product, p.bnpl_product])


def first_payment_default_daily(R, p: P.Params, restrict: bool = False) -> DataFrame:
    g = default_sums(R, p, restrict)
    return g.select("due_date", "product_user_type", "asset_product", "due_cnt",
                    dbl(F.col("principal_sum")).alias("principal_sum"),
                    dbl(F.col("dpd1_principal")).alias("dpd1_principal"),
                    dbl(F.col("dpd7_principal")).alias("dpd7_principal"),
                    "dpd1_cnt", "dpd7_cnt", "fpd1_amt", "fpd7_amt", "fpd7_cnt", "fpd7_amt_to_cnt")


def first_payment_default_metrics(R, p: P.Params) -> DataFrame:
    g = default_sums(R, p, restrict=True)
    d1, d7 = p.as_of, p.as_of - _dt.timedelta(days=6)   # due ages 1 and 7 at run day as_of+1
    cash, bnpl = F.col("asset_product") == p.cash_product, F.col("asset_product") == p.bnpl_product
    new, old = F.col("product_user_type") == "new", F.col("product_user_type") == "old"

    def amt(k, cond):
        return safe_div(F.sum(F.when(cond, F.col(f"dpd{k}_principal"))), F.sum(F.when(cond, F.col("principal_sum"))))

    def cnt_rate(k, cond):
        return safe_div(F.sum(F.when(cond, F.col(f"dpd{k}_cnt"))), F.sum(F.when(cond, F.col("due_cnt"))))

    n1, o1 = _on("due_date", d1, new & cash), _on("due_date", d1, old & cash)
    n7, o7 = _on("due_date", d7, new & cash), _on("due_date", d7, old & cash)
    b1, b7 = _on("due_date", d1, bnpl), _on("due_date", d7, bnpl)
    w = g.agg(
        ymd(F.date_sub(slice_max("due_date", n1), 14)).alias("fpd1_cohort_date"),
        amt(1, n1).alias("new_fpd1_amt"),
        amt(1, o1).alias("old_fpd1_amt"),
        ymd(F.date_sub(slice_max("due_date", n7), 14)).alias("fpd7_cohort_date"),
        amt(7, n7).alias("new_fpd7_amt"),
        F.try_divide(amt(7, n7), cnt_rate(7, n7)).alias("new_fpd7_amt_to_cnt"),
        amt(7, o7).alias("old_fpd7_amt"),
        F.try_divide(amt(7, o7), cnt_rate(7, o7)).alias("old_fpd7_amt_to_cnt"),
        amt(1, b1).alias("bnpl_fpd1_amt"),
        slice_sum("due_cnt", b1).alias("bnpl_fpd1_due_cnt"),
        amt(7, b7).alias("bnpl_fpd7_amt"),
        slice_sum("due_cnt", b7).alias("bnpl_fpd7_due_cnt"),
    )
    return to_long(w, "first_payment_default")


# ---------------------------------------------------------------- J8
def settled_loans_daily(R, p: P.Params, restrict: bool = False) -> DataFrame:
    inst = R.installments
    if restrict:
        inst = cut(inst, p, "repay_time", "mtd")
    return settled_loans(R.listings, inst, p.cash_product)


def settled_loans_metrics(R, p: P.Params) -> DataFrame:
    g = settled_loans_daily(R, p, restrict=True)
    on = _on("repay_date", p.as_of)
    w = g.agg(slice_sum("settled_cnt", on & (F.col("user_type") == "new")).alias("new_settled_cnt"),
              slice_sum("settled_cnt", on & (F.col("user_type") == "old")).alias("old_settled_cnt"))
    return to_long(w, "settled_loans")


# ---------------------------------------------------------------- J9
def limit_application_sums(R, p: P.Params, restrict: bool = False) -> DataFrame:
    d = R.decisions
    if restrict:
        d = cut(d, p, "inserttime", "mtd", part="dt")
    wl = attr("is_white_list")
    d = d.filter(_biz(*P.BIZ_LIMIT_ALL) & ((wl.try_cast("int") == 0) | wl.isNull()))
    x = d.select("user_id", "flow_id", day("inserttime").alias("limit_date"),
                 attr("process_flag", "int").alias("flag"),
                 attr("is_reloan").alias("is_reloan"),
                 attr("paid_loans_cnt").alias("repay_cnt"),
                 F.when(_biz(*P.BIZ_LIMIT_CASH), p.cash_product).otherwise(p.bnpl_product).alias("biz_type"))
    old = F.when(F.col("repay_cnt") == "1", F.col("flag"))
    return x.groupBy("limit_date", "is_reloan", "biz_type").agg(
        F.count("flow_id").alias("num"),
        F.sum("flag").cast("bigint").alias("is_pass"),
        F.count("flag").alias("flag_cnt"),
        F.count_distinct("user_id").alias("limit_num"),
        F.sum(old).alias("n2o_pass"),
        F.count(old).alias("n2o_cnt"))


def limit_application_panel(R, p: P.Params, restrict: bool = False) -> DataFrame:
    g = limit_application_sums(R, p, restrict).select(
        "limit_date", "is_reloan", "biz_type", "num", "is_pass", safe_div("is_pass", "flag_cnt").alias("pass_rate"), "limit_num",
        safe_div("n2o_pass", "n2o_cnt").alias("pass_rate_newtoold"))
    return mtd_cumulative(g, "limit_date", ["is_reloan", "biz_type"], {"mtd_num": "num"})


def limit_application_panel_metrics(R, p: P.Params) -> DataFrame:
    g = limit_application_panel(R, p, restrict=True)
    bnpl = F.col("biz_type") == p.bnpl_product
    cash = F.col("biz_type") == p.cash_product
    on = F.col("limit_date") == F.lit(p.as_of)
    new, old = F.col("is_reloan") == "0", F.col("is_reloan") == "1"
    w = g.agg(
        slice_sum("limit_num", on & bnpl).alias("bnpl_apply_users"),
        slice_sum("num", bnpl).alias("bnpl_apply_mtd"),
        safe_div(slice_sum("is_pass", on & bnpl), slice_sum("num", on & bnpl)).alias("bnpl_apply_pass_rate"),
        slice_sum("limit_num", on & cash & new).alias("new_limit_users"),
        slice_mean("pass_rate", on & cash & new).alias("new_limit_pass_rate"),
        slice_sum("limit_num", on & cash & old).alias("old_limit_users"),
        slice_mean("pass_rate", on & cash & old).alias("old_limit_pass_rate"),
        slice_mean("pass_rate_newtoold", on & cash & old).alias("new_to_old_limit_pass_rate"),
    )
    return to_long(w, "limit_application_panel")


# ---------------------------------------------------------------- J10
def revolving_users(R, p: P.Params) -> DataFrame:
    """Users with a cyclic-credit decision since ``revolving_since`` (distinct).
    A fused panel run supplies it precomputed from the full decision log."""
    if hasattr(R, "revolving_members"):
        return R.revolving_members()
    since = F.lit(p.revolving_since.isoformat(sep=" "))   # text: cast to the column's type
    d = R.decisions.filter(_biz(P.BIZ_REVOLVING) & (F.col("inserttime") >= since)
                           & (F.col("dt") >= F.lit(p.revolving_since.date()))
                           & (attr("is_cyclic") == "true"))
    return d.select("user_id").distinct()


def ticket_sums(R, p: P.Params, restrict: bool) -> DataFrame:
    l = R.listings
    if restrict:
        l = cut(l, p, "withdraw_time", "mtd")
    l = l.filter((F.col("is_deal") == 1) & F.col("asset_product").isin(p.cash_product, p.bnpl_product)
                 & (F.col("bid_stage") >= F.lit(P.STAGE_MIN)))
    loan = l.select(day("withdraw_time").alias("withdraw_date"), "listing_id", "user_id",
                    F.when(F.col("product_user_type") == "old", 1).otherwise(0).alias("is_reloan"),
                    F.col("period_no").try_cast("int").alias("period"), "real_amount", "asset_product")
    x = membership_flag(loan, revolving_users(R, p), "user_id", "is_revolving")
    x = x.withColumn("re_type", F.when(F.col("is_revolving"), "re").otherwise("notre"))
    return x.groupBy("withdraw_date", "is_reloan", "asset_product", "re_type").agg(
        F.sum("real_amount").alias("amount_sum"),
        F.sum(F.col("real_amount") * F.col("period")).alias("period_multi_amount"),
        F.count("listing_id").alias("num"))


def ticket_size_and_term(R, p: P.Params, restrict: bool = False) -> DataFrame:
    g = ticket_sums(R, p, restrict)
    unit = F.when(F.col("asset_product") == p.bnpl_product, P.TERM_DAYS_BNPL).otherwise(P.TERM_DAYS_CASH)
    return g.select("withdraw_date", "is_reloan", "asset_product", "re_type",
                    dbl(F.col("amount_sum")).alias("amount_sum"),
                    dbl(F.col("period_multi_amount")).alias("period_multi_amount"), "num",
                    F.try_divide(dbl(F.col("amount_sum")) / F.lit(p.fx), dbl(F.col("num"))).alias("ticket_usd"),
                    (safe_div("period_multi_amount", "amount_sum") * unit).alias("term_days"))


def ticket_size_and_term_metrics(R, p: P.Params) -> DataFrame:
    g = ticket_sums(R, p, restrict=True)
    fx = F.lit(p.fx)
    on = F.col("withdraw_date") == F.lit(p.as_of)
    cash = on & (F.col("asset_product") == p.cash_product)
    new, old = F.col("is_reloan") == 0, F.col("is_reloan") == 1
    re, notre = F.col("re_type") == "re", F.col("re_type") == "notre"

    def ticket(cond):
        return F.try_divide(dbl(slice_sum("amount_sum", cond)) / fx, dbl(slice_sum("num", cond)))

    def term(cond, unit):
        return safe_div(slice_sum("period_multi_amount", cond), slice_sum("amount_sum", cond)) * F.lit(float(unit))

    w = g.agg(
        ticket(cash & new).alias("new_ticket_usd"),
        ticket(cash & old).alias("old_ticket_usd"),
        term(cash & new, P.TERM_DAYS_CASH).alias("new_term_days"),
        term(cash & old, P.TERM_DAYS_CASH).alias("old_term_days"),
        ticket(cash & old & re).alias("revolving_ticket_usd"),
        dbl(slice_sum("num", cash & old & re)).alias("revolving_loan_cnt"),
        (dbl(slice_sum("amount_sum", cash & old & re)) / fx).alias("revolving_loan_amount_usd"),
        ticket(cash & old & notre).alias("nonrevolving_ticket_usd"),
        term(on & (F.col("asset_product") == p.bnpl_product), P.TERM_DAYS_BNPL).alias("bnpl_term_days"),
    )
    return to_long(w, "ticket_size_and_term")


# ---------------------------------------------------------------- J11
def limit_to_withdraw_t0_t7(R, p: P.Params, restrict: bool = False) -> DataFrame:
    d = R.decisions
    if restrict:
        d = cut(d, p, "inserttime", "days", days=[p.as_of, p.days_before(7)], part="dt")
    lim = d.filter(_biz(*P.BIZ_LIMIT_CASH) & _eq_int("is_white_list", 0) & (attr("process_flag") == "1"))
    entry = lim.select("flow_id", day("inserttime").alias("limit_day"), attr("is_reloan").alias("is_reloan"))
    mid = (R.limit_loan.filter(F.col("asset_product") == p.cash_product)
           .select(F.col("limit_flow_no").alias("flow_id"), "listing_id", day("withdraw_time").alias("withdraw_day")))
    versions = R.loans.filter((F.col("isactive") == 1) & F.col("asset_product").isNotNull()
                              & (F.col("bid_stage") >= F.lit(P.STAGE_MIN)))
    mid = with_versions(mid, versions, "listing_id", "versions")
    return cohort_conversion(entry, mid, "flow_id", "limit_day", "withdraw_day", ["is_reloan"],
                             {"t0": (None, 0), "t7": (None, 7)}, grain=p.grain, weight="versions")


def limit_to_withdraw_t0_t7_metrics(R, p: P.Params) -> DataFrame:
    g = limit_to_withdraw_t0_t7(R, p, restrict=True)
    t0, t7 = p.as_of, p.days_before(7)
    new, old = F.col("is_reloan") == "0", F.col("is_reloan") == "1"
    w = g.agg(slice_pick("t0_rate", _on("limit_day", t0, new), 0).alias("new_withdraw_rate_t0"),
              slice_pick("t0_rate", _on("limit_day", t0, old), 0).alias("old_withdraw_rate_t0"),
              slice_pick("t7_rate", _on("limit_day", t7, new), 0).alias("new_withdraw_rate_t7"),
              slice_pick("t7_rate", _on("limit_day", t7, old), 0).alias("old_withdraw_rate_t7"))
    return to_long(w, "limit_to_withdraw_t0_t7")


# ---------------------------------------------------------------- J12
def register_to_deal_same_day(R, p: P.Params, restrict: bool = False) -> DataFrame:
    reg = R.latest("registrations")
    l = R.listings
    if restrict:
        reg = cut(reg, p, "register_time", "days", days=[p.as_of])
        l = cut(l, p, "withdraw_time", "days", days=[p.as_of])
    r = reg.groupBy(day("register_time").alias("day")).agg(F.count_distinct("user_id").alias("reg_cnt"))
    deals = l.filter(F.col("asset_subject").isNotNull() & (F.col("asset_product") == p.cash_product)
                     & (F.col("is_deal") == 1) & (F.col("product_user_type") == "new"))
    d = deals.groupBy(day("withdraw_time").alias("day")).agg(F.count_distinct("listing_id").alias("deal_cnt"))
    j = r.join(d, "day", "full").na.fill(0, ["reg_cnt", "deal_cnt"])
    return j.withColumn("register_deal_rate", safe_div("deal_cnt", "reg_cnt"))


def register_to_deal_same_day_metrics(R, p: P.Params) -> DataFrame:
    g = register_to_deal_same_day(R, p, restrict=True)
    w = g.agg(slice_pick("register_deal_rate", _on("day", p.as_of), None).alias("register_deal_rate"))
    return to_long(w, "register_to_deal_same_day")


# ---------------------------------------------------------------- J13
def register_to_limit_t0_t7(R, p: P.Params, restrict: bool = False) -> DataFrame:
    reg = R.latest("registrations")
    dec = R.decisions
    if restrict:
        reg = cut(reg, p, "register_time", "days", days=[p.as_of, p.days_before(7)])
        dec = cut(dec, p, "inserttime", "since", n=8, part="dt")
    cus = reg.select("user_id", day("register_time").alias("reg_day"))
    source = R.register_channel.filter(~F.col("fst_level_channel").isin(*p.excluded_channels))
    entry = allow_list_join(cus, source, "user_id")
    lim = (dec.filter(_biz(*P.BIZ_LIMIT_CASH) & _eq_int("is_white_list", 0) & _eq_int("is_reloan", 0))
              .select("user_id", day("inserttime").alias("limit_day")))
    # scope: the reference joins only limit rows since as_of-8, i.e. since
    # reg_day-8 for the t0 cohort and reg_day-1 for the t7 cohort
    return cohort_conversion(entry, lim, "user_id", "reg_day", "limit_day", [],
                             {"t0": (None, 0, -8), "t7": (None, 7, -1)}, grain=p.grain)


def register_to_limit_t0_t7_metrics(R, p: P.Params) -> DataFrame:
    g = register_to_limit_t0_t7(R, p, restrict=True)
    w = g.agg(slice_pick("t0_rate", _on("reg_day", p.as_of), None).alias("register_limit_row_t0"),
              slice_pick("t7_rate", _on("reg_day", p.days_before(7)), None).alias("register_limit_row_t7"))
    return to_long(w, "register_to_limit_t0_t7")


# ---------------------------------------------------------------- J14
def cohort_cps_t0_t3(R, p: P.Params, restrict: bool = False) -> DataFrame:
    b = R.register_channel
    cost = R.ad_cost.filter(F.col("fst_level_channel").isin(*p.paid_channels))
    if restrict:
        days = [p.as_of, p.days_before(2)]
        b = cut(b, p, "register_time", "days", days=days)
        cost = cut(cost, p, "biz_date", "days", days=days)
    b = b.select("user_id", day("register_time").alias("reg_day"))
    ok = (F.col("is_deal") == 1) & (F.col("is_calm_period_repay") == 0)
    # pre-aggregate the loan side to (user, withdraw day) before the join
    a = (R.limit_loan_b.filter(F.col("asset_product") == p.cash_product)
         .groupBy("user_id", day("withdraw_time").alias("wday"))
         .agg(F.sum(flag(ok)).alias("n_ok")))
    j = b.join(a, "user_id", "inner")
    per_user = j.groupBy("user_id", "reg_day").agg(
        F.sum(F.when(F.col("wday") == F.col("reg_day"), F.col("n_ok")).otherwise(0)).alias("t0_rows"),
        F.max(F.when((F.datediff("wday", "reg_day") <= 3) & (F.col("n_ok") > 0), 1).otherwise(0)).alias("t3_hit"))
    # per_user is one row per (user, reg_day): counts of its rows are the
    # reference's distinct-user counts
    g = per_user.groupBy("reg_day").agg(
        F.count(F.lit(1)).alias("register_cnt"),
        F.sum("t0_rows").cast("bigint").alias("fst_withdraw_succ_cnt"),
        F.sum("t3_hit").cast("bigint").alias("t3_withdraw_user_num"))
    c = cost.groupBy(F.col("biz_date").alias("reg_day")).agg(dbl(F.sum("cost")).alias("cost"))
    out = g.join(c, "reg_day", "left")
    return out.withColumns({"cps_t0": safe_div("cost", "fst_withdraw_succ_cnt"),
                            "cps_t3": safe_div("cost", "t3_withdraw_user_num")})


def cohort_cps_t0_t3_metrics(R, p: P.Params) -> DataFrame:
    g = cohort_cps_t0_t3(R, p, restrict=True)
    w = g.agg(slice_max("cps_t0", _on("reg_day", p.as_of)).alias("cps_t0"),
              slice_max("cps_t3", _on("reg_day", p.days_before(2))).alias("cps_t3"))
    return to_long(w, "cohort_cps_t0_t3")


# ---------------------------------------------------------------- J15
def _bnpl_deals(R, p: P.Params, restrict: bool) -> DataFrame:
    loans = R.loans
    if restrict:  # open-ended: every deal since the month start
        loans = cut(loans, p, "withdraw_time", "open_mtd")
    asset = (loans.filter((F.col("isactive") == 1) & (F.col("asset_product") == p.bnpl_product)
                          & (F.col("bid_stage") >= F.lit(P.STAGE_MIN)))
                  .select("listing_id", "real_amount", "period_no", day("withdraw_time").alias("dt")))
    mid = (R.limit_loan.filter(F.col("asset_product") == p.bnpl_product)
           .select("listing_id", "loan_apply_no"))
    down = R.merchant_orders.select("loan_apply_no", "down_payment_ratio")
    return chained_enrichment(asset, [(mid, "listing_id"), (down, "loan_apply_no")])


def bnpl_deal_sums(R, p: P.Params, restrict: bool = False) -> DataFrame:
    periods, down = F.col("period_no").try_cast("double"), dbl(F.col("down_payment_ratio"))
    return _bnpl_deals(R, p, restrict).groupBy("dt").agg(
        F.count(F.lit(1)).alias("deal_cnt"), F.sum("real_amount").alias("amount_sum"),
        F.sum(periods).alias("period_sum"), F.count(periods).alias("period_cnt"),
        F.sum(down).alias("down_sum"), F.count(down).alias("down_cnt"))


def bnpl_deal_panel(R, p: P.Params, restrict: bool = False) -> DataFrame:
    g = mtd_cumulative(bnpl_deal_sums(R, p, restrict), "dt", [], {"mtd_deal_cnt": "deal_cnt"})
    return g.select("dt", "deal_cnt", F.col("mtd_deal_cnt").cast("bigint").alias("mtd_deal_cnt"),
                    dbl(F.col("amount_sum")).alias("amount_sum"), safe_div("period_sum", "period_cnt").alias("avg_period"),
                    safe_div("down_sum", "down_cnt").alias("avg_down_payment"))


def bnpl_deal_panel_metrics(R, p: P.Params) -> DataFrame:
    res = _bnpl_deals(R, p, restrict=True)
    on = F.col("dt") == F.lit(p.as_of)
    w = res.agg(
        F.count(F.when(on, 1)).alias("bnpl_deal_cnt"),
        F.count(F.lit(1)).alias("bnpl_deal_cnt_mtd"),
        (dbl(slice_sum("real_amount", on)) / F.lit(p.fx)).alias("bnpl_deal_amount_usd"),
        (slice_mean(F.col("period_no").try_cast("double"), on) * F.lit(float(P.TERM_DAYS_BNPL))).alias("bnpl_term_days"),
        (slice_mean(dbl(F.col("down_payment_ratio")), on) / F.lit(100.0)).alias("bnpl_down_payment"),
    )
    return to_long(w, "bnpl_deal_panel")


# ---------------------------------------------------------------- J16
def same_day_withdraw_sums(R, p: P.Params, restrict: bool = False) -> DataFrame:
    d = R.decisions
    if restrict:
        d = cut(d, p, "inserttime", "two_day", part="dt")
    lim = d.filter(_biz(*P.BIZ_LIMIT_CASH) & _eq_int("is_white_list", 0) & (attr("process_flag") == "1")
                   & _eq_int("is_reloan", 1))
    entry = lim.select("flow_id", day("inserttime").alias("limit_day"),
                       F.when(_eq_int("paid_loans_cnt", 1), "n2o").otherwise("other").alias("loan_type"))
    m = (R.limit_loan.filter(F.col("asset_product") == p.cash_product)
         .select(F.col("limit_flow_no").alias("flow_id"), "listing_id",
                 F.when(F.col("listing_id").isNotNull(), day("withdraw_time")).alias("withdraw_day")))
    m = with_versions(m, R.loans.filter(F.col("bid_stage") >= F.lit(P.STAGE_MIN)), "listing_id", "versions")
    c = cohort_conversion(entry, m, "flow_id", "limit_day", "withdraw_day", ["loan_type"],
                          {"wd": (0, 0)}, grain=p.grain, weight="versions")
    return c.select("limit_day", "loan_type", F.col("wd_rows").alias("row_cnt"),
                    F.col("wd_conv").alias("withdraw_cnt"), F.col("wd_rate").alias("withdraw_rate"))


def same_day_withdraw_dod(R, p: P.Params, restrict: bool = False) -> DataFrame:
    c = same_day_withdraw_sums(R, p, restrict)
    return day_over_day_change(c, ["loan_type"], "limit_day", "withdraw_rate", "withdraw_rate_dod")


def _dod_metrics(g: DataFrame, day_col: str, p: P.Params, specs) -> DataFrame:
    """specs: (metric, value col, prev col, extra condition)."""
    aggs = []
    for name, col_, prev_col, cond in specs:
        y = slice_pick(col_, _on(day_col, p.as_of, cond), 0)
        b = slice_pick(prev_col, _on(day_col, p.days_before(1), cond), None)
        aggs += [y.alias(name), (y - b).alias(f"{name}_dod")]
    return g.agg(*aggs)


def same_day_withdraw_dod_metrics(R, p: P.Params) -> DataFrame:
    g = same_day_withdraw_dod(R, p, restrict=True)
    w = _dod_metrics(g, "limit_day", p, [
        ("n2o_same_day_withdraw", "withdraw_rate", "withdraw_rate", F.col("loan_type") == "n2o"),
        ("other_same_day_withdraw", "withdraw_rate", "withdraw_rate", F.col("loan_type") == "other")])
    return to_long(w, "same_day_withdraw_dod")


# ---------------------------------------------------------------- J17
def revolving_withdraw_sums(R, p: P.Params, restrict: bool = False) -> DataFrame:
    d, loans = R.decisions, R.loans
    if restrict:
        # of the day before any withdrawal counts: its own day before isn't looked at
        d = cut(d, p, "inserttime", "two_day", part="dt")
        loans = cut(loans, p, "withdraw_time", "two_day")
    lim = (d.filter(_biz(P.BIZ_REVOLVING) & _eq_int("is_reloan", 1) & (attr("is_cyclic") == "true"))
            .select("user_id", day("inserttime").alias("limit_day"),
                    F.coalesce(attr("credit_limit", "float") > 0, F.lit(False)).alias("has_limit")))
    withdrawn = (loans.filter((F.col("asset_product") == p.cash_product) & (F.col("bid_stage") >= F.lit(P.STAGE_MIN)))
                 .select("user_id", day("withdraw_time").alias("withdraw_day")))
    # run day d ranks withdrawals over {d-1, d}: the first is on d only when there was none on d-1;
    # as the day before of run d+1, day d matches any withdrawal on d
    return first_in_window_conversion(lim, withdrawn, "user_id", "limit_day", "withdraw_day", F.col("has_limit")).select(
        "limit_day", F.col("entries").alias("has_limit_cnt"), F.col("first").alias("first_withdraw_cnt"),
        F.col("any").alias("any_withdraw_cnt"))


def revolving_withdraw_dod(R, p: P.Params, restrict: bool = False) -> DataFrame:
    g = revolving_withdraw_sums(R, p, restrict)
    g = g.withColumns({"withdraw_rate": safe_div("first_withdraw_cnt", "has_limit_cnt"),
                       "prev_day_rate": safe_div("any_withdraw_cnt", "has_limit_cnt")})
    return day_over_day_change(g, [], "limit_day", "withdraw_rate", "withdraw_rate_dod",
                               prev_value_col="prev_day_rate")


def revolving_withdraw_dod_metrics(R, p: P.Params) -> DataFrame:
    g = revolving_withdraw_dod(R, p, restrict=True)
    w = _dod_metrics(g, "limit_day", p, [("revolving_withdraw_t0", "withdraw_rate", "prev_day_rate", None)])
    return to_long(w, "revolving_withdraw_dod")


# ---------------------------------------------------------------- J18
def limit_to_bid_sums(R, p: P.Params, restrict: bool = False) -> DataFrame:
    d = R.decisions
    if restrict:
        d = cut(d, p, "inserttime", "two_day", part="dt")
    lim = d.filter(_biz(*P.BIZ_LIMIT_CASH) & _eq_int("is_white_list", 0) & (attr("process_flag") == "1")
                   & _eq_int("is_reloan", 0))
    entry = lim.select("flow_id", day("inserttime").alias("limit_day"),
                       F.coalesce(attr("credit_limit", "float") > 0, F.lit(False)).alias("has_limit"),
                       F.coalesce(attr("risk_grade").isin(*P.PRIME_GRADES), F.lit(False)).alias("prime"))
    ld = (R.limit_loan.filter(F.col("asset_product") == p.cash_product)
          .select(F.col("limit_flow_no").alias("flow_id"), day("loan_apply_time").alias("loan_day")))
    c = cohort_conversion(entry, ld, "flow_id", "limit_day", "loan_day", ["has_limit", "prime"],
                          {"bid": (0, 0)}, grain=p.grain)
    hl, pr = F.col("has_limit"), F.col("has_limit") & F.col("prime")
    return c.groupBy("limit_day").agg(
        slice_sum("bid_rows", hl).cast("bigint").alias("has_limit_cnt"),
        slice_sum("bid_conv", hl).cast("bigint").alias("bid_cnt"),
        slice_sum("bid_rows", pr).cast("bigint").alias("prime_has_limit_cnt"),
        slice_sum("bid_conv", pr).cast("bigint").alias("prime_bid_cnt"))


def limit_to_bid_dod(R, p: P.Params, restrict: bool = False) -> DataFrame:
    g = limit_to_bid_sums(R, p, restrict)
    g = g.withColumns({"bid_rate": safe_div("bid_cnt", "has_limit_cnt"),
                       "prime_bid_rate": safe_div("prime_bid_cnt", "prime_has_limit_cnt")})
    return day_over_day_change(g, [], "limit_day", changes={
        "bid_rate_dod": ("bid_rate", "bid_rate"), "prime_bid_rate_dod": ("prime_bid_rate", "prime_bid_rate")})


def limit_to_bid_dod_metrics(R, p: P.Params) -> DataFrame:
    g = limit_to_bid_dod(R, p, restrict=True)
    w = _dod_metrics(g, "limit_day", p, [("new_bid_rate_t0", "bid_rate", "bid_rate", None),
                                        ("prime_bid_rate_t0", "prime_bid_rate", "prime_bid_rate", None)])
    return to_long(w, "limit_to_bid_dod")


# ---------------------------------------------------------------- J19
def register_to_limit_sums(R, p: P.Params, restrict: bool = False) -> DataFrame:
    reg = R.latest("registrations")
    d = R.decisions
    if restrict:
        reg = cut(reg, p, "register_time", "two_day")
        d = cut(d, p, "inserttime", "two_day", part="dt")
    r = reg.select("user_id", day("register_time").alias("reg_day"))
    lim = (d.filter(_biz(*P.BIZ_LIMIT_CASH) & _eq_int("is_white_list", 0))
            .select("user_id", day("inserttime").alias("lim_day")))
    c = same_day_conversion(r, lim, "user_id", "reg_day", "lim_day")
    return c.select("reg_day", F.col("entry_users").alias("reg_cnt"), F.col("conv_users").alias("lim_cnt"),
                    F.col("rate").alias("reg_to_lim_rate"))


def register_to_limit_dod(R, p: P.Params, restrict: bool = False) -> DataFrame:
    c = register_to_limit_sums(R, p, restrict)
    return day_over_day_change(c, [], "reg_day", "reg_to_lim_rate", "reg_to_lim_rate_dod")


def register_to_limit_dod_metrics(R, p: P.Params) -> DataFrame:
    g = register_to_limit_dod(R, p, restrict=True)
    w = _dod_metrics(g, "reg_day", p, [("register_limit_user_t0", "reg_to_lim_rate", "reg_to_lim_rate", None)])
    return to_long(w, "register_to_limit_dod")


# ---------------------------------------------------------------- J20
def bid_parts(R, p: P.Params, restrict: bool) -> DataFrame:
    d = R.decisions
    if restrict:  # one partition day
        d = cut(d, p, "dt", "days", days=[p.as_of])
    l = d.filter(_biz(*P.BIZ_LISTING))
    x = l.select("dt", attr("process_flag", "int").alias("flag"), attr("is_reloan", "int").alias("is_reloan"),
                 F.when(_eq_int("paid_loans_cnt", 1), 1).otherwise(0).alias("is_new_to_old"))
    return x.groupBy("dt", "is_reloan", "is_new_to_old").agg(
        F.count("flag").alias("listing_num"), F.sum("flag").cast("bigint").alias("pass_num"))


def bid_panel_rollup(R, p: P.Params, restrict: bool = False) -> DataFrame:
    part = bid_parts(R, p, restrict)
    n2o = F.col("is_new_to_old") == 1
    g = part.groupBy("dt", "is_reloan").agg(
        F.sum("listing_num").cast("bigint").alias("listing_num"),
        F.coalesce(F.sum("pass_num"), F.lit(0)).cast("bigint").alias("pass_num"),
        slice_sum("listing_num", n2o).cast("bigint").alias("n2o_listing_num"),
        slice_sum("pass_num", n2o).cast("bigint").alias("n2o_pass_num"))
    return g.withColumns({"pass_rate": safe_div("pass_num", "listing_num"),
                          "n2o_pass_rate": safe_div("n2o_pass_num", "n2o_listing_num")})


def bid_panel_rollup_metrics(R, p: P.Params) -> DataFrame:
    part = bid_parts(R, p, restrict=True)
    on = F.col("dt") == F.lit(p.as_of)
    new, old = on & (F.col("is_reloan") == 0), on & (F.col("is_reloan") == 1)
    o2 = old & (F.col("is_new_to_old") == 1)
    w = part.agg(
        slice_sum("listing_num", new).alias("new_bid_cnt"),
        slice_sum("listing_num", old).alias("old_bid_cnt"),
        safe_div(slice_sum("pass_num", new), slice_sum("listing_num", new)).alias("new_bid_pass_rate"),
        safe_div(slice_sum("pass_num", old), slice_sum("listing_num", old)).alias("old_bid_pass_rate"),
        safe_div(slice_sum("pass_num", o2), slice_sum("listing_num", o2)).alias("n2o_bid_pass_rate"))
    return to_long(w, "bid_panel_rollup")


# ---------------------------------------------------------------- registry
JOBS = [
    ("daily_loan_panel", daily_loan_panel, daily_loan_panel_metrics),
    ("bid_pass_rate_daily", bid_pass_rate_daily, bid_pass_rate_daily_metrics),
    ("registration_cohort_funnel", registration_cohort_funnel, registration_cohort_funnel_metrics),
    ("natural_day_funnel", natural_day_funnel, natural_day_funnel_metrics),
    ("settlement_reloan_funnel", settlement_reloan_funnel, settlement_reloan_funnel_metrics),
    ("static_cps", static_cps, static_cps_metrics),
    ("first_payment_default", first_payment_default_daily, first_payment_default_metrics),
    ("settled_loans", settled_loans_daily, settled_loans_metrics),
    ("limit_application_panel", limit_application_panel, limit_application_panel_metrics),
    ("ticket_size_and_term", ticket_size_and_term, ticket_size_and_term_metrics),
    ("limit_to_withdraw_t0_t7", limit_to_withdraw_t0_t7, limit_to_withdraw_t0_t7_metrics),
    ("register_to_deal_same_day", register_to_deal_same_day, register_to_deal_same_day_metrics),
    ("register_to_limit_t0_t7", register_to_limit_t0_t7, register_to_limit_t0_t7_metrics),
    ("cohort_cps_t0_t3", cohort_cps_t0_t3, cohort_cps_t0_t3_metrics),
    ("bnpl_deal_panel", bnpl_deal_panel, bnpl_deal_panel_metrics),
    ("same_day_withdraw_dod", same_day_withdraw_dod, same_day_withdraw_dod_metrics),
    ("revolving_withdraw_dod", revolving_withdraw_dod, revolving_withdraw_dod_metrics),
    ("limit_to_bid_dod", limit_to_bid_dod, limit_to_bid_dod_metrics),
    ("register_to_limit_dod", register_to_limit_dod, register_to_limit_dod_metrics),
    ("bid_panel_rollup", bid_panel_rollup, bid_panel_rollup_metrics),
]
