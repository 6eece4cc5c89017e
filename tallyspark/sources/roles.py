"""Role views.

The metric jobs read *roles* (the decision log, loans, installments, funnels,
...), never physical tables.  A role is a DataFrame with a fixed schema; how
it is produced depends on the deployment:

* ``WarehouseRoles`` reads one parquet dataset per role (the production
  layout: ``<root>/<role>/`` partitioned by day).
* ``TestDataRoles`` derives every role from the driver's TPC-H-like test
  tables (``orders``, ``lineitem``, ``events``, ``customer``).  Everything
  derived from events lies in January 2024; event attributes come from
  ``props`` -> ``k`` (0..99).  The loan book (listings, installments, daily
  deals) holds the orders of 1995-2001 as its history and the purchases of
  the event log as its latest month, so all jobs share one calendar.

The columns and types that every job may rely on are declared in
``sources/schemas.py``.  Beyond them:

decisions   dt is the partition day and equals to_date(inserttime) in the session's time zone;
            attrs has the keys of ``decision_log.ATTRIBUTES``
loans       a listing can have several versions
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.periods import latest_snapshot
from tallyspark.sources.schemas import SCHEMAS, typed
from tallyspark.sources.snapshots import read_latest
from tallyspark.sources.tables import TableSource

MONEY = "decimal(18,2)"

ROLE_NAMES = tuple(SCHEMAS)

# Snapshot partitions of the registration dimension in the test mapping: the
# latest snapshot holds every user, an older one a stale copy of early users.
SNAPSHOT_LATEST = _dt.date(2024, 1, 31)
SNAPSHOT_OLD = _dt.date(2024, 1, 15)
# Listings made from purchases are numbered above every order key.
PURCHASE_LISTING = 10_000_000_000


class Roles:
    """Base: memoises role DataFrames (plans only; nothing is cached)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._memo: dict[str, DataFrame] = {}
        self._guard = threading.Lock()
        self._locks: dict[str, threading.Lock] = {}

    def _lock(self, name: str) -> threading.Lock:
        with self._guard:
            return self._locks.setdefault(name, threading.Lock())

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in ROLE_NAMES:
            raise AttributeError(name)
        # built once even when several threads ask for it at the same time
        with self._lock(name):
            if name not in self._memo:
                self._memo[name] = self._build(name)
        return self._memo[name]

    def _build(self, name: str) -> DataFrame:  # pragma: no cover
        raise NotImplementedError

    def latest(self, name: str, part_col: str = "dt") -> DataFrame:
        """The latest snapshot of a snapshot role."""
        return latest_snapshot(getattr(self, name), part_col)


class WarehouseRoles(Roles):
    """One parquet dataset per role under ``root`` (day-partitioned where the
    role has a ``dt`` column, so day filters prune partitions), read with the
    role's declared types: a dataset that stores others is an error.

    ``layouts`` makes a role of a dataset stored otherwise: a function from the
    stored frame to the role (``decision_log.decisions``, or ``conform`` with the
    stored names)."""

    def __init__(self, spark: SparkSession, root: str, layouts: dict[str, Callable[[DataFrame], DataFrame]] | None = None):
        super().__init__(spark)
        self.root = root.rstrip("/")
        self.layouts = layouts or {}

    def _as_role(self, name: str, df: DataFrame) -> DataFrame:
        return typed(self.layouts[name](df) if name in self.layouts else df, name)

    def _build(self, name: str) -> DataFrame:
        return self._as_role(name, self.spark.read.parquet(f"{self.root}/{name}"))

    def latest(self, name: str, part_col: str = "dt") -> DataFrame:
        return self._as_role(name, read_latest(self.spark, f"{self.root}/{name}", part_col))


def _days(ts: Column, n: Column) -> Column:
    """timestamp + n whole days"""
    return F.timestamp_add("DAY", n, ts)


class TestDataRoles(Roles):
    """Roles derived from the driver's test tables (see module docstring)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark)
        self.src = TableSource(spark, sf_dir)

    # -- event log -------------------------------------------------------
    def _events(self, types: tuple[str, ...]) -> DataFrame:
        e = self.src.read("events", ["event_id", "ts", "user_id", "event_type",
                                      "value", "props"])
        e = e.filter(F.col("event_type").isin(*types))
        k = F.get_json_object("props", "$.k").try_cast("int")
        return e.withColumn("k", k).drop("props")

    def _build(self, name: str) -> DataFrame:
        return getattr(self, f"_role_{name}")()

    def _role_decisions(self) -> DataFrame:
        e = self._events(("click", "error", "view"))
        k, et = F.col("k"), F.col("event_type")
        biz = (F.when(et == "click", F.when(k % 2 == 0, "10000").otherwise("10001"))
                .when(et == "error", F.when(k < 50, "11000").otherwise("12001"))
                .otherwise(F.when(k < 50, "22050").otherwise("20050")))
        attrs = F.create_map(
            F.lit("biz_id"), biz,
            F.lit("process_flag"), F.when(k % 10 < 6, "1").otherwise("0"),
            F.lit("is_reloan"), F.when(k % 3 == 0, "0").otherwise("1"),
            F.lit("is_white_list"), (F.when(k % 10 == 9, "1")
                                      .when(k % 10 == 8, F.lit(None).cast("string"))
                                      .otherwise("0")),
            F.lit("is_cyclic"), F.when(et == "error", "true").otherwise("false"),
            F.lit("paid_loans_cnt"), (k % 5).cast("string"),
            F.lit("credit_limit"), F.when(k % 4 == 0, "0").otherwise(F.col("value").cast("string")),
            F.lit("risk_grade"), F.element_at(F.array(*[F.lit(g) for g in "ABCDE"]), (k % 5 + 1).cast("int")),
        )
        return e.select(
            "user_id",
            F.col("event_id").cast("string").alias("flow_id"),
            F.when(et == "view", F.col("event_id").cast("string")).alias("listing_id"),
            F.col("ts").alias("inserttime"),
            F.to_date("ts").alias("dt"),
            attrs.alias("attrs"),
        )

    def _first_signup(self) -> DataFrame:
        # one registration per user: the first signup event (partial aggregate,
        # so a user with a huge number of signups never lands in one task)
        return (self._events(("signup",))
                .groupBy("user_id").agg(F.min("ts").alias("register_time")))

    def _role_registrations(self) -> DataFrame:
        # every user is in the latest snapshot; users registered before the
        # old snapshot day also have a (stale) row there — one aggregate,
        # exploded into its snapshot partitions
        first = self._first_signup()
        parts = F.when(F.col("register_time") < F.lit(SNAPSHOT_OLD),
                       F.array(F.lit(SNAPSHOT_LATEST), F.lit(SNAPSHOT_OLD))).otherwise(F.array(F.lit(SNAPSHOT_LATEST)))
        return first.select("user_id", "register_time", F.explode(parts).alias("dt"))

    def _role_register_channel(self) -> DataFrame:
        cust = self.src.read("customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
        return (self._first_signup()
                .join(cust, F.col("user_id") == F.col("c_custkey"), "inner")
                .select("user_id",
                        F.lower("c_mktsegment").alias("fst_level_channel"),
                        F.concat(F.lit("cmp_"), F.col("c_nationkey").cast("string")).alias("campaign_name"),
                        "register_time"))

    @staticmethod
    def _product(k: Column) -> Column:
        return F.when(k < 20, "bnpl").otherwise("cashloan")

    def _role_limit_loan(self) -> DataFrame:
        e = self._events(("purchase",))
        k, eid = F.col("k"), F.col("event_id")
        return e.select(
            (eid - eid % 5).cast("string").alias("limit_flow_no"),
            eid.cast("string").alias("listing_id"),
            F.concat(F.lit("A"), eid.cast("string")).alias("loan_apply_no"),
            _days(F.col("ts"), F.when(k % 3 == 0, 0).otherwise(k % 10)).alias("withdraw_time"),
            _days(F.col("ts"), k % 3).alias("loan_apply_time"),
            self._product(k).alias("asset_product"),
        )

    def _role_limit_loan_b(self) -> DataFrame:
        e = self._events(("purchase",))
        k = F.col("k")
        return e.select(
            "user_id",
            _days(F.col("ts"), k % 5).alias("withdraw_time"),
            F.when(k % 7 == 0, 0).otherwise(1).alias("is_deal"),
            F.when(k % 9 == 0, 1).otherwise(0).alias("is_calm_period_repay"),
            self._product(k).alias("asset_product"),
        )

    def _role_loans(self) -> DataFrame:
        e = self._events(("purchase",))
        k = F.col("k")
        # listings of k % 8 = 4 have a second, equal version; of k % 8 = 6 an inactive one beside
        versions = (F.when(k % 8 == 4, F.array(F.lit(True), F.lit(True)))
                    .when(k % 8 == 6, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True))))
        return e.withColumn("live", F.explode(versions)).select(
            F.col("event_id").cast("string").alias("listing_id"),
            "user_id",
            F.col("ts").alias("withdraw_time"),
            F.col("value").cast(MONEY).alias("real_amount"),
            (k % 6 + 1).cast("string").alias("period_no"),
            F.when((k % 10 == 7) | ~F.col("live"), 0).otherwise(1).alias("isactive"),
            ((k % 11) * 10).cast("string").alias("bid_stage"),
            self._product(k).alias("asset_product"),
        )

    def _role_merchant_orders(self) -> DataFrame:
        e = self._events(("purchase",))
        return e.select(
            F.concat(F.lit("A"), F.col("event_id").cast("string")).alias("loan_apply_no"),
            ((F.col("k") % 5) * 10).alias("down_payment_ratio"),
        )

    def _role_ad_cost(self) -> DataFrame:
        e = self._events(("click", "view"))
        chan = F.element_at(F.array(*[F.lit(c) for c in ("tiktok", "google", "facebook", "organic")]),
                            (F.col("user_id") % 4 + 1).cast("int"))
        return e.select(F.to_date("ts").alias("biz_date"),
                        chan.alias("fst_level_channel"),
                        F.col("value").cast(MONEY).alias("cost"))

    def _role_daily_conversions(self) -> DataFrame:
        e = self._events(("purchase",))
        return e.select(F.to_date("ts").alias("biz_date"),
                        self._product(F.col("k")).alias("asset_product"),
                        F.lit(1).cast("bigint").alias("fst_withdraw_succ_cnt"))

    def _funnel_events(self) -> DataFrame:
        return self._events(("signup", "click", "purchase", "view"))

    @staticmethod
    def _ind(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0).cast("bigint")

    def _role_register_funnel(self) -> DataFrame:
        e = self._funnel_events()
        et, k, ind = F.col("event_type"), F.col("k"), self._ind
        return e.select(
            F.to_date("ts").alias("register_date"),
            self._product(k).alias("asset_product"),
            ind(et == "signup").alias("register_user_cnt"),
            ind(et == "click").alias("apply_limit_user_cnt"),
            ind((et == "click") & (k < 70)).alias("fst_has_limit_user_cnt"),
            ind(et == "purchase").alias("withdraw_succ_user_cnt"),
        )

    def _role_natural_day_funnel(self) -> DataFrame:
        e = self._funnel_events()
        et, k, ind = F.col("event_type"), F.col("k"), self._ind
        return e.select(
            F.to_date("ts").alias("biz_date"),
            self._product(k).alias("asset_product"),
            ind(et == "signup").alias("register_user_cnt"),
            ind(et == "click").alias("fst_apply_limit_user_cnt"),
            ind(et == "purchase").alias("repay_user_cnt"),
            ind((et == "purchase") & (k < 60)).alias("apply_limit_user_cnt_t0"),
            ind((et == "click") & (k < 70)).alias("fst_apply_has_limit_user_cnt"),
        )

    def _role_settle_funnel(self) -> DataFrame:
        e = self._funnel_events()
        et, k, ind = F.col("event_type"), F.col("k"), self._ind
        return e.select(
            F.to_date("ts").alias("repay_date"),
            ind(et == "view").alias("has_limit_user_cnt"),
            ind((et == "view") & (k < 40)).alias("reloan_withdraw_user_cnt"),
        )

    # -- loan book -------------------------------------------------------
    def _role_listings(self) -> DataFrame:
        return self._order_listings().union(self._purchase_listings())

    def _order_listings(self) -> DataFrame:
        o = self.src.read("orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                      "o_totalprice", "o_orderdate", "o_orderpriority"])
        digit = F.substring("o_orderpriority", 1, 1).cast("int")
        return self._listing_columns(
            o, key=F.col("o_orderkey"), user=F.col("o_custkey"), time=F.col("o_orderdate"), amount=F.col("o_totalprice"),
            digit=digit, bnpl=F.col("o_orderkey") % 5 == 0, dealt=F.col("o_orderstatus") != "O", named=F.col("o_orderstatus") != "O",
            refunded=F.col("o_orderstatus") == "P", stage=(F.col("o_orderkey") % 11) * 10)

    def _purchase_listings(self) -> DataFrame:
        e = self._events(("purchase",))
        k = F.col("k")
        return self._listing_columns(
            e, key=F.col("event_id") + F.lit(PURCHASE_LISTING), user=F.col("user_id"), time=F.col("ts"),
            amount=F.col("value").cast(MONEY) * 1000,
            digit=k % 5 + 1, bnpl=k < 20, dealt=k % 7 != 0, named=k % 13 != 0, refunded=k % 9 == 0, stage=(k % 6) * 10 + 50)

    @staticmethod
    def _listing_columns(df: DataFrame, *, key, user, time, amount, digit, bnpl, dealt, named, refunded, stage) -> DataFrame:
        new = user % 3 == 0
        money = amount.cast(MONEY)
        return df.select(
            key.alias("listing_id"),
            user.alias("user_id"),
            time.alias("withdraw_time"),
            money.alias("real_amount"),
            money.alias("apply_amount"),
            (F.lit(30) + digit % 3).alias("product_type"),
            digit.alias("term_quantity"),
            digit.alias("total_period"),
            digit.cast("string").alias("period_no"),
            F.when(new, "new").otherwise("old").alias("product_user_type"),
            F.when(bnpl, "bnpl").otherwise("cashloan").alias("asset_product"),
            F.when(named, "platform").alias("asset_subject"),
            F.when(dealt, 1).otherwise(0).alias("is_deal"),
            F.when(refunded, 1).otherwise(0).alias("is_calm_period_repay"),
            stage.cast("string").alias("bid_stage"),
            F.create_map(F.lit("deal_non_calm_repay_asc"), F.when(new, 1).otherwise(2)).alias("total_bid_num"),
        )

    def _role_daily_deals(self) -> DataFrame:
        li = self.listings.filter(F.col("is_deal") == 1)
        return li.select(
            F.to_date("withdraw_time").alias("biz_date"),
            F.lit("organic").alias("channel"),
            "product_type",
            F.col("product_user_type").alias("user_type"),
            "is_calm_period_repay",
            F.lit(1).cast("bigint").alias("deal_cnt"),
            F.lit(1).cast("bigint").alias("deal_users"),
            F.col("real_amount").alias("deal_amount"),
        )

    def _role_installments(self) -> DataFrame:
        return self._order_installments().union(self._purchase_installments())

    def _purchase_installments(self) -> DataFrame:
        # two installments a purchase: the first due on its day, the last 15 days later
        e = self._events(("purchase",))
        k = F.col("k")
        first = F.col("period_seq") == 1
        paid = F.when(first, k % 5 != 4).otherwise(k % 3 != 0)
        delay = F.when(first, k % 10 - 2).otherwise(k % 4)
        money = F.col("value").cast(MONEY)
        return e.withColumn("period_seq", F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint")))).select(
            (F.col("event_id") + F.lit(PURCHASE_LISTING)).alias("listing_id"),
            money.alias("principal"),
            money.alias("list_amount"),
            F.when(first, F.to_date("ts")).otherwise(F.date_add(F.to_date("ts"), 15)).alias("due_date"),
            F.when(paid, _days(F.col("ts"), delay)).alias("repay_time"),
            F.when(paid & (k % 17 != 0), 2).when(paid, 3).otherwise(1).alias("debt_status"),
            "period_seq",
            F.lit(2).alias("period_no"),
            F.when(k % 9 == 0, 1).otherwise(0).alias("is_calm_period_repay"),
            F.lit(1).alias("is_deal"),
            F.when(k % 10 == 7, 0).otherwise(1).alias("isactive"),
            self._product(k).alias("asset_product"),
        )

    def _order_installments(self) -> DataFrame:
        li = self.src.read("lineitem", ["l_orderkey", "l_partkey", "l_linenumber",
                                         "l_extendedprice", "l_discount", "l_returnflag",
                                         "l_linestatus", "l_shipdate"])
        done = F.col("l_linestatus") == "F"
        delay = F.col("l_partkey") % 15
        principal = F.col("l_extendedprice").cast(MONEY)
        return li.select(
            F.col("l_orderkey").alias("listing_id"),
            principal.alias("principal"),
            principal.alias("list_amount"),
            F.to_date("l_shipdate").alias("due_date"),
            F.when(done, _days(F.col("l_shipdate"), delay)).alias("repay_time"),
            F.when(done & (delay != 14), 2).when(done, 3).otherwise(1).alias("debt_status"),
            F.col("l_linenumber").alias("period_seq"),
            F.lit(7).alias("period_no"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_calm_period_repay"),
            F.lit(1).alias("is_deal"),
            F.when(F.col("l_discount") > 0, 1).otherwise(0).alias("isactive"),
            F.when(F.col("l_orderkey") % 5 == 0, "bnpl").otherwise("cashloan").alias("asset_product"),
        )
