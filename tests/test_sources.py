"""Declared schemas, the stored decision log and the newest snapshot partition."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.sources import decision_log
from tallyspark.sources.roles import ROLE_NAMES, WarehouseRoles
from tallyspark.sources.schemas import SchemaError, check_stored, conform, declared, rejected_values, typed, widens
from tallyspark.sources.snapshots import newest_partition, read_latest


def test_the_test_roles_have_the_declared_types(roles):
    for name in ROLE_NAMES:
        assert getattr(roles, name).schema.simpleString() == declared(name).simpleString(), name


def test_wrong_and_missing_columns_are_all_named(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1.5)], "biz_date string, cost double")
    df.write.parquet(str(tmp_path / "ad_cost"))
    with pytest.raises(SchemaError) as e:
        WarehouseRoles(spark, str(tmp_path)).ad_cost
    text = str(e.value)
    assert "role ad_cost" in text and "biz_date is string, declared date" in text
    assert "fst_level_channel is missing" in text and "cost is double, declared decimal(18,2)" in text


def test_narrower_types_widen(spark):
    from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType
    assert widens(IntegerType(), LongType()) and not widens(LongType(), IntegerType())
    assert widens(DecimalType(10, 2), DecimalType(18, 2)) and not widens(DecimalType(18, 4), DecimalType(18, 2))
    assert not widens(StringType(), LongType())
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "cashloan", 3)], "biz_date date, asset_product string, fst_withdraw_succ_cnt int")
    assert typed(df, "daily_conversions").schema == declared("daily_conversions")
    check_stored("daily_conversions", df.schema)


def test_conform_parses_text_and_counts_what_does_not(spark):
    df = spark.createDataFrame([("2024-01-05", "tiktok", " 12.50 "), ("2024-01-05 07:00:00", "google", "x"), ("soon", None, None), (None, "a", "1e3")],
                               "day string, fst_level_channel string, cost string")
    names = {"biz_date": "day"}
    role = conform(df, "ad_cost", names)
    assert role.schema == declared("ad_cost")
    d = dt.date(2024, 1, 5)
    assert sorted(map(str, role.collect())) == sorted(map(str, [
        role.sparkSession.createDataFrame([r], role.schema).first() for r in
        [(d, "tiktok", __import__("decimal").Decimal("12.50")), (d, "google", None), (None, None, None), (None, "a", __import__("decimal").Decimal("1000.00"))]]))
    assert {r.column: (r.rejected, r.example) for r in rejected_values(df, "ad_cost", names).collect()} == {
        "biz_date": (1, "soon"), "cost": (1, "x")}
    with pytest.raises(SchemaError, match="biz_date"):
        conform(df, "ad_cost")


def _log(spark, rows):
    schema = ("user_id bigint, flow_id string, listing_id string, inserttime string, dt string, "
              + ", ".join(f"{m} map<string,string>" for m in decision_log.MAPS))
    return spark.createDataFrame(rows, schema)


def test_stored_log_gives_the_role(spark, roles, tmp_path):
    """The role written out as six maps and text, stored by day and read through the adapter, is the role again."""
    d = roles.decisions
    maps = {m: F.create_map(*[x for a, (c, key, _) in decision_log.ATTRIBUTES.items() if c == m for x in (F.lit(key), F.col("attrs")[a])])
            for m in decision_log.MAPS}
    stored = d.select("user_id", "flow_id", "listing_id", F.col("inserttime").cast("string").alias("inserttime"),
                      F.col("dt").cast("string").alias("dt"), *[c.alias(m) for m, c in maps.items()])
    stored.write.partitionBy("dt").parquet(str(tmp_path / "decisions"))
    W = WarehouseRoles(spark, str(tmp_path), {"decisions": decision_log.decisions})

    def rows(df):
        return sorted((r.flow_id, r.user_id, str(r.listing_id), r.inserttime, r.dt, tuple(sorted((k, v or "") for k, v in r.attrs.items())))
                      for r in df.collect())

    assert W.decisions.schema.simpleString() == declared("decisions").simpleString()
    assert rows(W.decisions) == rows(d)
    # a day of the role is one partition of the stored log
    plan = W.decisions.where(F.col("dt") == F.lit(dt.date(2024, 1, 10))).select("flow_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-10" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_dirty_attributes_are_null_and_counted(spark):
    def row(flow, time="2024-01-05 10:00:00", **put):
        text = {"processFlag": "1", "isReloanCustomer": "0", "isWhiteListUser": "0", "isCyclic": "true", "userPayedLoansCnt": "2",
                "creditLimit": "10.5", "bizId": "10000", "auditNewRiskGradeV1": "A", **put}
        maps = [{k: text[k] for c, k, _ in decision_log.ATTRIBUTES.values() if c == m and k in text} for m in decision_log.MAPS]
        return (1, flow, None, time, "2024-01-05", *maps)

    log = _log(spark, [row("ok"), row("a", processFlag="yes"), row("b", processFlag=" 0 "), row("c", creditLimit="1,000", isCyclic="maybe"),
                       row("d", time="later"), (1, "e", None, None, None, *[None] * 6)])
    got = {r.flow_id: r for r in decision_log.decisions(log).collect()}
    assert got["ok"].attrs["process_flag"] == "1" and got["ok"].attrs["credit_limit"] == "10.5"
    assert got["a"].attrs["process_flag"] is None and got["b"].attrs["process_flag"] == "0"
    assert got["c"].attrs["credit_limit"] is None and got["c"].attrs["is_cyclic"] is None
    assert got["d"].inserttime is None and got["d"].dt == dt.date(2024, 1, 5)
    assert set(got["e"].attrs.values()) == {None}
    bad = {r.column: (r.rejected, r.example) for r in decision_log.rejected_attributes(log).collect() if r.rejected}
    assert bad == {"process_flag": (1, "yes"), "credit_limit": (1, "1,000"), "is_cyclic": (1, "maybe"), "inserttime": (1, "later")}
    with pytest.raises(SchemaError, match="c_column is missing"):
        decision_log.decisions(log.drop("c_column"))


def test_newest_of_many_snapshots_is_the_only_one_opened(spark, tmp_path):
    path = str(tmp_path / "registrations")
    days = [dt.date(2023, 12, 1) + dt.timedelta(days=i) for i in range(60)]
    rows = [(u, dt.datetime(2023, 11, 1), d) for d in days for u in range(d.toordinal() % 5 + 1)]
    df = spark.createDataFrame(rows, "user_id bigint, register_time timestamp_ntz, dt date")
    df.repartition("dt").write.partitionBy("dt").parquet(path)
    W = WarehouseRoles(spark, str(tmp_path))
    latest = W.latest("registrations")
    assert latest.schema == declared("registrations")
    assert {r.dt for r in latest.collect()} == {days[-1]} and latest.count() == days[-1].toordinal() % 5 + 1
    assert {f.rsplit("/", 2)[1] for f in latest.inputFiles()} == {f"dt={days[-1]}"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Subquery" not in plan
    # a newer folder of a write that never ended, and the null partition, are passed over
    (tmp_path / "registrations" / "dt=2024-03-01" / "_temporary").mkdir(parents=True)
    (tmp_path / "registrations" / "dt=__HIVE_DEFAULT_PARTITION__").mkdir()
    assert newest_partition(spark, path).endswith(f"dt={days[-1]}")
    assert read_latest(spark, path).count() == latest.count()
    with pytest.raises(ValueError, match="no partition"):
        read_latest(spark, path, "other")


def test_partition_values_are_ordered_as_numbers(spark, tmp_path):
    spark.createDataFrame([(i, i) for i in (2, 9, 10, 11)], "v int, p int").write.partitionBy("p").parquet(str(tmp_path / "t"))
    assert [r.p for r in read_latest(spark, str(tmp_path / "t"), "p").collect()] == [11]
