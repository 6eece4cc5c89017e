"""Credit-risk operators: first-payment default and settled loans."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import safe_div


def first_payment_default(installments: DataFrame, listings: DataFrame,
                          products: Sequence[str], ages: Sequence[int] = (1, 7)) -> DataFrame:
    """First-installment default by due date, user type and product.

    For due date D and age k the loan is observed at run day D+k: overdue days
    are ``repay_day - D`` when repaid (repay time set and status 2), else k;
    ``dpd_k = overdue >= k``.  Per (due_date, user type, product):
    due count, principal, Σ(dpd_k·principal)/Σprincipal (``fpd{k}_amt``),
    the plain rate ``fpd{k}_cnt`` and their ratio ``fpd{k}_amt_to_cnt``.
    The listing supplies user type and product (LEFT JOIN: installments
    without a listing keep NULL attributes).  Principal sums are decimals.
    """
    term1 = (installments
             .filter(F.col("asset_product").isin(*products)
                     & (F.col("is_calm_period_repay") == 0) & (F.col("is_deal") == 1)
                     & (F.col("isactive") == 1) & (F.col("period_seq") == 1))
             .select("listing_id", "principal", "due_date", "repay_time", "debt_status"))
    lst = (listings.filter(F.col("asset_subject").isNotNull() & F.col("asset_product").isin(*products))
                   .select("listing_id", "product_user_type", "asset_product"))
    j = term1.join(lst, "listing_id", "left")
    repaid = F.col("repay_time").isNotNull() & (F.col("debt_status") == 2)
    paid_after = F.datediff(F.to_date("repay_time"), F.col("due_date"))
    aggs = [F.count(F.lit(1)).alias("due_cnt"), F.sum("principal").alias("principal_sum")]
    for k in ages:
        dpd = F.when(F.when(repaid, paid_after).otherwise(F.lit(k)) >= k, 1).otherwise(0)
        aggs.append(F.coalesce(F.sum(F.when(dpd == 1, F.col("principal"))), F.lit(0)).alias(f"dpd{k}_principal"))
        aggs.append(F.sum(dpd).cast("bigint").alias(f"dpd{k}_cnt"))
    g = j.groupBy("due_date", "product_user_type", "asset_product").agg(*aggs)
    cols = {}
    for k in ages:
        cols[f"fpd{k}_amt"] = safe_div(f"dpd{k}_principal", "principal_sum")
        cols[f"fpd{k}_cnt"] = safe_div(f"dpd{k}_cnt", "due_cnt")
    g = g.withColumns(cols)
    # principal sums stay exact decimals, so callers can add groups exactly
    return g.withColumns({f"fpd{k}_amt_to_cnt": F.try_divide(F.col(f"fpd{k}_amt"), F.col(f"fpd{k}_cnt"))
                          for k in ages})


def settled_loans(listings: DataFrame, installments: DataFrame, product: str) -> DataFrame:
    """Loans whose last installment (period_no = period_seq) was repaid, by
    repay day and new/old (the listing's loan counter = 1 means new).
    LEFT JOIN + WHERE on the repay day is an inner join; written as one."""
    w = (listings.filter((F.col("asset_product") == product) & F.col("withdraw_time").isNotNull())
                 .select("listing_id",
                         F.when(F.col("total_bid_num")["deal_non_calm_repay_asc"] == 1, "new")
                          .otherwise("old").alias("user_type")))
    t = (installments.filter((F.col("asset_product") == product) & (F.col("period_no") == F.col("period_seq")))
                     .select("listing_id", F.to_date("repay_time").alias("repay_date"))
                     .filter(F.col("repay_date").isNotNull()))
    j = w.join(t, "listing_id", "inner")
    return j.groupBy("repay_date", "user_type").agg(F.count(F.lit(1)).alias("settled_cnt"))
