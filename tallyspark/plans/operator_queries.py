"""One query per reusable operator, each applied to roles derived
from the whole test tables.  Panel operators (metric table, attainment,
completeness, report) run on the full panel in ``plans.panel``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark.functions import attr, day, flag
from tallyspark.operators import joins as J
from tallyspark.operators import periods as T
from tallyspark.operators import rollups as G
from tallyspark.operators.panel import day_over_day_change
from tallyspark.operators.sequence import event_sequence, first_event_per_key
from tallyspark.plans import jobs
from tallyspark.session import checkpoint_path, materialize
from tallyspark.sources.decision_log import ATTRIBUTES, MAPS, decisions, rejected_attributes
from tallyspark.sources.roles import SNAPSHOT_LATEST, SNAPSHOT_OLD, TestDataRoles, WarehouseRoles


def _ctx(spark: SparkSession, sf_dir: str, job: str | None = None):
    p = P.test_params()
    return TestDataRoles(spark, sf_dir), (p.for_job(job) if job else p)


def loan_sequence(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    l = R.listings.select("user_id", "listing_id", "withdraw_time")
    return event_sequence(l, "user_id", "withdraw_time", "listing_id", "loan_n")


def partition_pruned_scan(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    d = R.decisions.filter(F.col("dt") >= F.lit(SNAPSHOT_OLD))
    return d.select("flow_id", "user_id", "dt")


def latest_snapshot(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    return T.latest_snapshot(R.registrations, "dt").select("user_id", "register_time", "dt")


def month_to_date_filter(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir, "daily_loan_panel")
    l = T.period_filter(R.listings, "withdraw_time", p.as_of, "mtd")
    return l.select("listing_id", "user_id", "withdraw_time", F.col("real_amount").cast("double").alias("real_amount"))


def distinct_members(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    return jobs.revolving_users(R, p)


def in_list_filter(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    d = R.decisions.filter(attr("biz_id").isin(*P.BIZ_LIMIT_ALL))
    return d.groupBy("dt", attr("biz_id").alias("biz_id")).agg(F.count(F.lit(1)).alias("n"))


def two_day_filter(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    d = T.period_filter(R.decisions, "inserttime", p.as_of, "two_day")
    return d.select("flow_id", "user_id", "dt")


def not_in_filter(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    r = R.register_channel.filter(~F.col("fst_level_channel").isin(*p.excluded_channels))
    return r.select("user_id", "fst_level_channel")


def null_tolerant_filter(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    wl = attr("is_white_list")
    d = R.decisions.filter(attr("biz_id").isin(*P.BIZ_LIMIT_ALL))
    return d.groupBy("dt").agg(
        F.sum(flag(wl.try_cast("int") == 0)).cast("bigint").alias("n_strict"),
        F.sum(flag((wl.try_cast("int") == 0) | wl.isNull())).cast("bigint").alias("n_tolerant"))


def slice_at_date(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir, "limit_application_panel")
    g = jobs.limit_application_panel(R, p)
    cash = F.col("biz_type") == p.cash_product
    n2o = F.when(F.col("is_reloan") == "1", F.col("pass_rate_newtoold"))
    return T.slice_at(g, "limit_date", p.as_of, {
        "users_sum": ("limit_num", "sum"), "num_sum": ("num", "sum"),
        "pass_rate_max": ("pass_rate", "max"), "pass_rate_mean": ("pass_rate", "mean"),
        "n2o_max": (n2o, "max"), "pass_rate_pick": ("pass_rate", "pick", 0),
    }, where=cash)


def join_on_predicate(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    lim = (R.decisions.filter(attr("biz_id").isin(*P.BIZ_LIMIT_CASH))
           .select("flow_id", "dt"))
    j = J.join_on_predicate(lim, R.limit_loan, [("flow_id", "limit_flow_no")],
                            F.col("asset_product") == p.cash_product)
    return j.groupBy("dt").agg(F.count(F.lit(1)).alias("row_cnt"),
                               F.count("limit_flow_no").alias("matched_cnt"))


def first_event_per_key_q(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    f = first_event_per_key(R.loans, "user_id", "withdraw_time", "listing_id", ["real_amount"])
    return f.withColumn("real_amount", F.col("real_amount").cast("double"))


def membership_flag(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    l = R.listings.select("listing_id", "user_id")
    return J.membership_flag(l, jobs.revolving_users(R, p), "user_id", "is_member")


def chained_enrichment(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    base = R.loans.select("listing_id", "asset_product")
    mid = R.limit_loan.select("listing_id", "loan_apply_no")
    down = R.merchant_orders
    return J.chained_enrichment(base, [(mid, "listing_id"), (down, "loan_apply_no")])


def allow_list_join(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    reg = T.latest_snapshot(R.registrations, "dt").select("user_id", day("register_time").alias("reg_day"))
    allowed = R.register_channel.filter(~F.col("fst_level_channel").isin(*p.excluded_channels))
    return J.allow_list_join(reg, allowed, "user_id")


def daily_rollup_sum(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    g = G.daily_rollup(R.daily_deals, ["biz_date", "user_type"],
                       {"deal_cnt": "deal_cnt", "deal_amount": "deal_amount"})
    return g.select("biz_date", "user_type", F.col("deal_cnt").cast("bigint").alias("deal_cnt"),
                    F.col("deal_amount").cast("double").alias("deal_amount"))


def weighted_ratio(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    l = R.listings.select(day("withdraw_time").alias("withdraw_date"), "asset_product", "real_amount",
                          F.col("period_no").try_cast("int").alias("period"))
    return G.weighted_ratio(l, ["withdraw_date", "asset_product"], "period", "real_amount", "avg_term")


def flag_rate(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    d = R.decisions.select("dt", attr("biz_id").alias("biz_id"), attr("process_flag", "int").alias("flag"))
    return G.flag_rate(d, ["dt", "biz_id"], "flag", "pass_rate")


def conditional_rate(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    d = (R.decisions.filter(attr("biz_id").isin(*P.BIZ_LIMIT_CASH))
         .select("dt", attr("process_flag", "int").alias("flag"), attr("paid_loans_cnt").alias("repay_cnt")))
    return G.conditional_rate(d, ["dt"], "flag", F.col("repay_cnt") == "1", "pass_rate_newtoold")


def conditional_count(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    d = R.decisions.filter(attr("biz_id").isin(*P.BIZ_LIMIT_CASH))
    has = attr("credit_limit", "float") > 0
    return G.conditional_count(d, ["dt"], {"has_limit_cnt": has,
                                           "prime_has_limit_cnt": has & attr("risk_grade").isin(*P.PRIME_GRADES)})


def distinct_users_daily(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    return R.decisions.groupBy("dt", attr("biz_id").alias("biz_id")).agg(
        F.count_distinct("user_id").alias("users"))


def conditional_distinct(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    ok = (F.col("is_deal") == 1) & (F.col("is_calm_period_repay") == 0)
    return R.limit_loan_b.groupBy(day("withdraw_time").alias("wday")).agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct(F.when(ok, F.col("user_id"))).alias("ok_users"))


def group_by_case(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    l = R.listings.select("user_id", "asset_product", "real_amount")
    x = J.membership_flag(l, jobs.revolving_users(R, p), "user_id", "m")
    re_type = F.when(F.col("m"), "re").otherwise("notre")
    return x.groupBy(re_type.alias("re_type"), "asset_product").agg(
        F.count(F.lit(1)).alias("num"), F.sum("real_amount").cast("double").alias("amount_sum"))


def funnel_ratio(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    cols = ["register_user_cnt", "apply_limit_user_cnt", "fst_has_limit_user_cnt", "withdraw_succ_user_cnt"]
    g = G.daily_rollup(R.register_funnel, ["register_date", "asset_product"], {c: c for c in cols})
    g = g.select("register_date", "asset_product", *[F.col(c).cast("bigint").alias(c) for c in cols])
    return G.funnel_ratio(g, [("apply_rate", "apply_limit_user_cnt", "register_user_cnt"),
                              ("withdraw_rate", "withdraw_succ_user_cnt", "fst_has_limit_user_cnt")])


def amount_to_count_ratio(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    i = R.installments.filter(F.col("period_seq") == 1).select(
        F.trunc("due_date", "month").alias("due_month"), "asset_product", "principal",
        F.when(F.col("debt_status") == 2, 0).otherwise(1).alias("unpaid"))
    return G.amount_to_count_ratio(i, ["due_month", "asset_product"], "unpaid", "principal", "unpaid_amt_to_cnt")


def mtd_cumulative(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    g = R.daily_deals.groupBy("biz_date", "user_type").agg(
        F.sum("deal_cnt").cast("bigint").alias("deal_cnt"), F.sum("deal_amount").alias("deal_amount"))
    g = G.mtd_cumulative(g, "biz_date", ["user_type"], {"mtd_cnt": "deal_cnt", "mtd_amount": "deal_amount"})
    return g.select("biz_date", "user_type", "deal_cnt", F.col("mtd_cnt").cast("bigint").alias("mtd_cnt"),
                    F.col("deal_amount").cast("double").alias("deal_amount"),
                    F.col("mtd_amount").cast("double").alias("mtd_amount"))


def day_over_day(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    g = jobs.limit_application_panel(R, p).filter(F.col("biz_type") == p.cash_product)
    return day_over_day_change(g.select("limit_date", "is_reloan", "pass_rate"), ["is_reloan"],
                               "limit_date", "pass_rate", "pass_rate_dod")


def map_attribute(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    return R.decisions.select("flow_id", attr("biz_id").alias("biz_id"),
                              attr("process_flag", "int").alias("process_flag"),
                              attr("is_white_list", "int").alias("is_white_list"),
                              attr("credit_limit", "double").alias("credit_limit"),
                              attr("risk_grade").alias("risk_grade"),
                              attr("no_such_key").alias("missing_key"))


def fill_nulls(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    cal = R.decisions.select("dt").distinct()
    rev = (R.decisions.filter((attr("biz_id") == P.BIZ_REVOLVING) & (attr("is_reloan", "int") == 1)
                              & (attr("risk_grade") == "A"))
           .groupBy("dt").agg(F.avg(attr("process_flag", "int")).alias("pass_rate"),
                              F.count(F.lit(1)).alias("n")))
    return cal.join(rev, "dt", "left").na.fill(0, ["pass_rate", "n"])


def currency_convert(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    return R.listings.groupBy(day("withdraw_time").alias("withdraw_date")).agg(
        (F.sum("real_amount").cast("double") / F.lit(p.fx)).alias("amount_usd"))


def cohort_conversion(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    return jobs.limit_to_withdraw_t0_t7(R, P.test_params(grain="entity"))


def same_day_conversion(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    e = (R.decisions.filter(attr("biz_id").isin(*P.BIZ_LIMIT_CASH))
         .select("user_id", F.col("dt").alias("entry_day")))
    c = R.loans.select("user_id", day("withdraw_time").alias("conv_day"))
    return J.same_day_conversion(e, c, "user_id", "entry_day", "conv_day")


def cost_per_acquisition(spark, sf_dir) -> DataFrame:
    R, _ = _ctx(spark, sf_dir)
    return J.cost_per_acquisition(R.ad_cost, R.daily_conversions, "biz_date", "cost",
                                  "fst_withdraw_succ_cnt", "cps")


OPERATOR_QUERIES = {
    "loan_sequence": loan_sequence,
    "partition_pruned_scan": partition_pruned_scan,
    "latest_snapshot": latest_snapshot,
    "month_to_date_filter": month_to_date_filter,
    "distinct_members": distinct_members,
    "in_list_filter": in_list_filter,
    "two_day_filter": two_day_filter,
    "not_in_filter": not_in_filter,
    "null_tolerant_filter": null_tolerant_filter,
    "slice_at_date": slice_at_date,
    "join_on_predicate": join_on_predicate,
    "first_event_per_key": first_event_per_key_q,
    "membership_flag": membership_flag,
    "chained_enrichment": chained_enrichment,
    "allow_list_join": allow_list_join,
    "daily_rollup_sum": daily_rollup_sum,
    "weighted_ratio": weighted_ratio,
    "flag_rate": flag_rate,
    "conditional_rate": conditional_rate,
    "conditional_count": conditional_count,
    "distinct_users_daily": distinct_users_daily,
    "conditional_distinct": conditional_distinct,
    "group_by_case": group_by_case,
    "funnel_ratio": funnel_ratio,
    "amount_to_count_ratio": amount_to_count_ratio,
    "mtd_cumulative": mtd_cumulative,
    "day_over_day_change": day_over_day,
    "map_attribute": map_attribute,
    "fill_nulls": fill_nulls,
    "currency_convert": currency_convert,
    "cohort_conversion": cohort_conversion,
    "same_day_conversion": same_day_conversion,
    "cost_per_acquisition": cost_per_acquisition,
}


# -- stored roles -----------------------------------------------------------
def _scratch(spark, name: str) -> str:
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def latest_snapshot_partition(spark, sf_dir) -> DataFrame:
    """The registrations as a stored dimension with one full snapshot a day (every user registered by then); the
    newest one is found in the file listing."""
    R, _ = _ctx(spark, sf_dir)
    first = R.registrations.where(F.col("dt") == F.lit(SNAPSHOT_LATEST)).select("user_id", "register_time")
    days = F.sequence(F.to_date("register_time"), F.lit(SNAPSHOT_LATEST))
    root = _scratch(spark, "snapshots")
    (first.withColumn("dt", F.explode(days)).repartition("dt").write.partitionBy("dt").parquet(f"{root}/registrations"))
    return WarehouseRoles(spark, root).latest("registrations").select("user_id", "register_time", "dt")


def _stored_log(spark, sf_dir) -> DataFrame:
    """The decisions as the log stores them: six maps, text times; some values are dirty (as in the SQL)."""
    R, _ = _ctx(spark, sf_dir)
    n = F.col("flow_id").cast("bigint")
    put = {"process_flag": F.when(n % 97 == 0, "yes"), "is_reloan": F.when(n % 89 == 0, " 1 "), "is_white_list": F.when(n % 83 == 0, ""),
           "credit_limit": F.when(n % 79 == 0, "1,000"), "is_cyclic": F.when(n % 73 == 0, "cyclic")}
    d = R.decisions
    maps = {}
    for name, (column, key, _) in ATTRIBUTES.items():
        text = F.coalesce(put[name], attr(name)) if name in put else attr(name)
        maps.setdefault(column, []).extend([F.lit(key), text])
    time = F.when(n % 101 == 0, "not a time").otherwise(F.date_format("inserttime", "yyyy-MM-dd HH:mm:ss"))
    return d.select("user_id", "flow_id", "listing_id", time.alias("inserttime"), F.date_format("dt", "yyyy-MM-dd").alias("dt"),
                    *[F.create_map(*maps[c]).alias(c) for c in MAPS])


def stored_decision_log(spark, sf_dir) -> DataFrame:
    d = decisions(_stored_log(spark, sf_dir))
    return d.select("user_id", "flow_id", "listing_id", "inserttime", "dt", *[attr(a).alias(a) for a in ATTRIBUTES])


def rejected_values(spark, sf_dir) -> DataFrame:
    return rejected_attributes(_stored_log(spark, sf_dir))


def first_in_window_conversion(spark, sf_dir) -> DataFrame:
    R, p = _ctx(spark, sf_dir)
    entry = R.decisions.select("user_id", F.col("dt").alias("entry_day"), attr("biz_id").isin(*P.BIZ_LIMIT_CASH).alias("limit"))
    events = R.loans.select("user_id", day("withdraw_time").alias("event_day"))
    return J.first_in_window_conversion(entry, events, "user_id", "entry_day", "event_day", F.col("limit"))


OPERATOR_QUERIES.update({
    "latest_snapshot_partition": latest_snapshot_partition,
    "stored_decision_log": stored_decision_log,
    "rejected_values": rejected_values,
    "first_in_window_conversion": first_in_window_conversion,
})


# -- panel operators (full panel) -------------------------------------------
def _panel_ctx(spark, sf_dir):
    from tallyspark.plans import panel
    R, p = _ctx(spark, sf_dir)
    return panel, R, p


def metric_table_q(spark, sf_dir) -> DataFrame:
    panel, R, p = _panel_ctx(spark, sf_dir)
    return panel.run_panel(R, p)


def metric_table_days(spark, sf_dir) -> DataFrame:
    """The panels of all days of the event log, merged from one table of partials."""
    panel, R, p = _panel_ctx(spark, sf_dir)
    return panel.panel_days(R, p, P.TEST_DAYS)


def metric_sink(spark, sf_dir) -> DataFrame:
    """All days stored with every value off by one, then the later half again as it is, read back."""
    panel, R, p = _panel_ctx(spark, sf_dir)
    table = materialize(panel.panel_days(R, p, P.TEST_DAYS), f"panel-{uuid.uuid4().hex[:12]}")
    path = _scratch(spark, "metric-sink")
    panel.sink_panel(R, p, path, table.withColumn("value", F.col("value") + 1))
    store = panel.sink_panel(R, p, path, table.where(F.col("as_of") >= F.lit(SNAPSHOT_OLD)))
    return store.verified()


def target_attainment_q(spark, sf_dir) -> DataFrame:
    panel, R, p = _panel_ctx(spark, sf_dir)
    t = panel.run_panel(R, p).filter(~F.col("metric").endswith("_att"))
    return panel.attainment(R, p, t).select("as_of", "job", "metric", "base_metric", "target", "value")


def metric_completeness_q(spark, sf_dir) -> DataFrame:
    panel, R, p = _panel_ctx(spark, sf_dir)
    return panel.completeness(R, p, panel.panel_days(R, p, P.TEST_DAYS))


def report_lines_q(spark, sf_dir) -> DataFrame:
    panel, R, p = _panel_ctx(spark, sf_dir)
    return panel.report(R, p, panel.run_panel(R, p))


def report_lines_compact(spark, sf_dir) -> DataFrame:
    """The older layout, for every day of the event log."""
    panel, R, p = _panel_ctx(spark, sf_dir)
    return panel.report(R, p, panel.panel_days(R, p, P.TEST_DAYS), variant="compact")


OPERATOR_QUERIES.update({
    "metric_table": metric_table_q,
    "metric_table_days": metric_table_days,
    "metric_sink": metric_sink,
    "target_attainment": target_attainment_q,
    "metric_completeness": metric_completeness_q,
    "report_lines": report_lines_q,
    "report_lines_compact": report_lines_compact,
})
