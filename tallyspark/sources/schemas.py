"""Declared schemas of the roles, and how stored columns become them.

A role is read with its declared types.  ``check_stored`` compares what a
dataset stores with the declaration and fails with every difference by name;
``conform`` makes a role of a frame whose columns hold other names or text.
Text that doesn't parse becomes NULL and is counted by ``rejected_values``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType,
                               StructType, TimestampNTZType, TimestampType)

SCHEMAS: dict[str, str] = {
    "decisions": "user_id bigint, flow_id string, listing_id string, inserttime timestamp_ntz, dt date, attrs map<string,string>",
    "registrations": "user_id bigint, register_time timestamp_ntz, dt date",
    "register_channel": "user_id bigint, fst_level_channel string, campaign_name string, register_time timestamp_ntz",
    "limit_loan": "limit_flow_no string, listing_id string, loan_apply_no string, withdraw_time timestamp_ntz, "
                  "loan_apply_time timestamp_ntz, asset_product string",
    "limit_loan_b": "user_id bigint, withdraw_time timestamp_ntz, is_deal int, is_calm_period_repay int, asset_product string",
    "loans": "listing_id string, user_id bigint, withdraw_time timestamp_ntz, real_amount decimal(18,2), period_no string, "
             "isactive int, bid_stage string, asset_product string",
    "merchant_orders": "loan_apply_no string, down_payment_ratio int",
    "listings": "listing_id bigint, user_id bigint, withdraw_time timestamp_ntz, real_amount decimal(18,2), apply_amount decimal(18,2), "
                "product_type int, term_quantity int, total_period int, period_no string, product_user_type string, asset_product string, "
                "asset_subject string, is_deal int, is_calm_period_repay int, bid_stage string, total_bid_num map<string,int>",
    "installments": "listing_id bigint, principal decimal(18,2), list_amount decimal(18,2), due_date date, repay_time timestamp_ntz, "
                    "debt_status int, period_seq bigint, period_no int, is_calm_period_repay int, is_deal int, isactive int, "
                    "asset_product string",
    "daily_deals": "biz_date date, channel string, product_type int, user_type string, is_calm_period_repay int, deal_cnt bigint, "
                   "deal_users bigint, deal_amount decimal(18,2)",
    "register_funnel": "register_date date, asset_product string, register_user_cnt bigint, apply_limit_user_cnt bigint, "
                       "fst_has_limit_user_cnt bigint, withdraw_succ_user_cnt bigint",
    "natural_day_funnel": "biz_date date, asset_product string, register_user_cnt bigint, fst_apply_limit_user_cnt bigint, "
                          "repay_user_cnt bigint, apply_limit_user_cnt_t0 bigint, fst_apply_has_limit_user_cnt bigint",
    "settle_funnel": "repay_date date, has_limit_user_cnt bigint, reloan_withdraw_user_cnt bigint",
    "ad_cost": "biz_date date, fst_level_channel string, cost decimal(18,2)",
    "daily_conversions": "biz_date date, asset_product string, fst_withdraw_succ_cnt bigint",
}


def declared(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


class SchemaError(ValueError):
    """A dataset doesn't hold what its role declares."""


_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def widens(have: DataType, want: DataType) -> bool:
    """Whether every value of ``have`` is a value of ``want``, unchanged."""
    if have == want:
        return True
    if isinstance(have, _WHOLE) and isinstance(want, _WHOLE):
        return _WHOLE.index(type(have)) <= _WHOLE.index(type(want))
    if isinstance(have, DecimalType) and isinstance(want, DecimalType):
        return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    if isinstance(have, FloatType):
        return isinstance(want, DoubleType)
    return isinstance(have, DateType) and isinstance(want, TimestampNTZType)


def check_stored(name: str, stored: StructType) -> None:
    """Fail with all columns that are missing or hold a type that doesn't widen to the declared one."""
    have = {f.name: f.dataType for f in stored.fields}
    faults = [f"{f.name} is missing" if f.name not in have else
              f"{f.name} is {have[f.name].simpleString()}, declared {f.dataType.simpleString()}"
              for f in declared(name).fields if f.name not in have or not widens(have[f.name], f.dataType)]
    if faults:
        raise SchemaError(f"role {name}: " + "; ".join(faults))


def typed(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a checked frame, in order, with the declared types."""
    check_stored(name, df.schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared(name).fields])


def parsed(column: Column, have: DataType, want: DataType) -> Column:
    """``column`` as the declared type; text that doesn't parse is NULL."""
    if isinstance(have, StringType) and not isinstance(want, StringType):
        text = F.trim(column)
        if isinstance(want, (DateType, TimestampNTZType, TimestampType)):
            when = F.try_to_timestamp(text).cast("timestamp_ntz")
            return when.cast(want)
        return text.try_cast(want)
    return column.try_cast(want)


def conform(df: DataFrame, name: str, columns: Mapping[str, str] | None = None) -> DataFrame:
    """The role of a physical frame: ``columns`` maps role columns to stored ones of another name."""
    columns = columns or {}
    have = {f.name: f.dataType for f in df.schema.fields}
    lost = [f.name for f in declared(name).fields if columns.get(f.name, f.name) not in have]
    if lost:
        raise SchemaError(f"role {name}: no stored column for " + ", ".join(lost))
    return df.select(*[parsed(F.col(columns.get(f.name, f.name)), have[columns.get(f.name, f.name)], f.dataType).alias(f.name)
                       for f in declared(name).fields])


def rejected_values(df: DataFrame, name: str, columns: Mapping[str, str] | None = None) -> DataFrame:
    """(column, rejected, example): values of a physical frame that are there but don't parse as
    declared; one pass, a row for each column that can have some."""
    columns = columns or {}
    have = {f.name: f.dataType for f in df.schema.fields}
    checks = {}
    for f in declared(name).fields:
        source = columns.get(f.name, f.name)
        if source in have and have[source] != f.dataType:
            bad = F.col(source).isNotNull() & parsed(F.col(source), have[source], f.dataType).isNull()
            checks[f.name] = F.when(bad, F.col(source).cast("string"))
    return rejects(df, checks)


def rejects(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(column, rejected, example) from a column of rejected text for each name: how many, and the least."""
    if not checks:
        return df.sparkSession.createDataFrame([], "column string, rejected bigint, example string")
    one = df.agg(*[F.struct(F.count(bad).alias("rejected"), F.min(bad).alias("example")).alias(c) for c, bad in checks.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).getField("rejected").alias("rejected"),
                              F.col(c).getField("example").alias("example")) for c in checks])
    return one.select(F.explode(rows).alias("r")).select("r.*")
