"""Hand-written edge frames (FIXTURES.md part C): each operator against a
brute-force Python computation of the same rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import fmt, map_attr, safe_div
from tallyspark.operators import joins as J
from tallyspark.operators import panel as PO
from tallyspark.operators import periods as T
from tallyspark.operators.credit import first_payment_default
from tallyspark.operators.rollups import mtd_cumulative
from tallyspark.operators.sequence import event_sequence, first_event_per_key

D = dt.date


def test_fx_map(spark):
    df = spark.createDataFrame(
        [(1, {"k": "1"}), (2, {"k": " 1 "}), (3, {"k": "true"}), (4, {"other": "5"}), (5, None), (6, {"k": "x9"})],
        "id int, m map<string,string>")
    got = {r.id: (r.raw, r.n) for r in df.select("id", map_attr("m", "k").alias("raw"),
                                                 map_attr("m", "k", "int").alias("n")).collect()}
    assert got[1] == ("1", 1)
    assert got[2] == (" 1 ", 1)          # whitespace is trimmed by the cast
    assert got[3] == ("true", None)      # non-numeric -> NULL, not an error (ANSI on)
    assert got[4] == (None, None)        # missing key
    assert got[5] == (None, None)        # NULL map
    assert got[6] == ("x9", None)


def _brute_cohort(entries, convs, windows, grain):
    """entries: (key, day, seg); convs: (key, day); reference LEFT JOIN + AVG."""
    out = {}
    for key, eday, seg in entries:
        matched = [c for c in convs if c[0] == key]
        for name, spec in windows.items():
            lo, hi = spec[0], spec[1]
            scope = spec[2] if len(spec) > 2 else None
            ms = [c for c in matched if scope is None or (c[1] - eday).days >= scope]
            hits = [c for c in ms if c[1] is not None and (lo is None or (c[1] - eday).days >= lo)
                    and (hi is None or (c[1] - eday).days <= hi)]
            rows, conv = (max(len(ms), 1), len(hits)) if grain == "row" else (1, 1 if hits else 0)
            r, c = out.get((eday, seg, name), (0, 0))
            out[(eday, seg, name)] = (r + rows, c + conv)
    return out


def test_fx_fanout_cohort_conversion(spark):
    d0 = D(2024, 1, 10)
    entries = [("a", d0, "x"), ("b", d0, "x"), ("c", d0, "y"), ("d", d0, "y"), ("e", d0, "y"), ("a", d0, "x")]
    convs = [("b", d0), ("c", d0 + dt.timedelta(days=7)), ("c", d0 + dt.timedelta(days=8)),
             ("d", d0 - dt.timedelta(days=2)), ("e", d0 + dt.timedelta(days=1)), ("e", d0)]
    windows = {"t0": (None, 0), "t7": (None, 7), "exact": (0, 0), "scoped": (None, 7, -1)}
    e = spark.createDataFrame(entries, "k string, eday date, seg string")
    c = spark.createDataFrame(convs, "k string, cday date")
    for grain in ("row", "entity"):
        got = J.cohort_conversion(e, c, "k", "eday", "cday", ["seg"], windows, grain).collect()
        want = _brute_cohort(entries, convs, windows, grain)
        for r in got:
            for name in windows:
                assert (r[f"{name}_rows"], r[f"{name}_conv"]) == want[(r.eday, r.seg, name)], (grain, name, r)
        assert len(got) == 2


def test_fx_membership(spark):
    base = spark.createDataFrame([(1,), (2,), (None,), (2,)], "u int")
    members = spark.createDataFrame([(2,), (2,), (None,), (3,)], "u int")
    out = J.membership_flag(base, members, "u", "m").collect()
    assert len(out) == 4                              # no row growth
    assert sorted((r.u is None, r.u or 0, r.m) for r in out) == [
        (False, 1, False), (False, 2, True), (False, 2, True), (True, 0, False)]


def test_fx_first_and_sequence(spark):
    ts = dt.datetime(2024, 1, 1, 10)
    rows = [("u1", ts, "b"), ("u1", ts, "a"), ("u1", ts + dt.timedelta(days=1), "c"), ("u2", ts, "z")]
    df = spark.createDataFrame(rows, "u string, t timestamp_ntz, id string")
    first = {r.u: r.id for r in first_event_per_key(df, "u", "t", "id").collect()}
    assert first == {"u1": "a", "u2": "z"}           # equal times: the smaller id wins
    seq = {r.id: r.n for r in event_sequence(df, "u", "t", "id", "n").collect()}
    assert seq == {"a": 1, "b": 2, "c": 3, "z": 1}


def test_event_sequence_hot_key_spans_partitions(spark):
    # one user holds most rows; buckets split it over many tasks
    n = 3000
    rows = [("hot" if i % 10 else f"u{i}", i // 7, i) for i in range(n)]
    df = spark.createDataFrame(rows, "u string, t long, id long").repartition(9)
    got = {r.id: r.n for r in event_sequence(df, "u", "t", "id", "n", bucket=F.floor(F.col("t") / 20)).collect()}
    want, counters = {}, {}
    for u, t, i in sorted(rows):
        counters[u] = counters.get(u, 0) + 1
        want[i] = counters[u]
    assert got == want


def test_fx_fpd(spark):
    due = D(2024, 1, 10)
    inst = spark.createDataFrame([
        ("L1", 100, due, dt.datetime(2024, 1, 9), 2),     # repaid early -> no default
        ("L2", 200, due, dt.datetime(2024, 1, 11), 2),    # repaid on day 1 -> dpd1
        ("L3", 300, due, dt.datetime(2024, 1, 17), 2),    # repaid on day 7 -> dpd1 and dpd7
        ("L4", 400, due, None, 1),                        # open -> default at every age
        ("L5", 500, due, dt.datetime(2024, 1, 10), 3),    # repay set but status != 2 -> open
        ("L6", 600, due, None, 1),                        # no listing -> NULL attributes
    ], "listing_id string, principal int, due_date date, repay_time timestamp_ntz, debt_status int")
    inst = (inst.withColumn("principal", F.col("principal").cast("decimal(18,2)"))
                .withColumns({"period_seq": F.lit(1), "is_calm_period_repay": F.lit(0), "is_deal": F.lit(1),
                              "isactive": F.lit(1), "asset_product": F.lit("cashloan")}))
    lst = spark.createDataFrame([(f"L{i}", "new", "cashloan", "s") for i in range(1, 6)],
                                "listing_id string, product_user_type string, asset_product string, asset_subject string")
    rows = {r.product_user_type: r for r in first_payment_default(inst, lst, ["cashloan"]).collect()}
    r = rows["new"]
    assert (r.due_cnt, r.dpd1_cnt, r.dpd7_cnt) == (5, 4, 3)
    assert float(r.dpd1_principal) == 200 + 300 + 400 + 500
    assert abs(r.fpd7_amt - (300 + 400 + 500) / 1500) < 1e-12
    assert rows[None].due_cnt == 1


def test_fx_ratio(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (None, 2), (2, None), (1, 4)], "n int, d int")
    assert [r.r for r in df.select(safe_div("n", "d").alias("r")).collect()] == [None, None, None, None, 0.25]


def test_fx_slice(spark):
    d = D(2024, 1, 30)
    df = spark.createDataFrame([(d - dt.timedelta(days=1), 0.5), (d, None), (d - dt.timedelta(days=3), 0.2)],
                               "day date, v double")
    r = T.slice_at(df, "day", d, {"s": ("v", "sum"), "m": ("v", "max"), "a": ("v", "mean"),
                                  "p": ("v", "pick", 0)}).first()
    assert (r.s, r.m, r.a, r.p) == (0.0, None, None, 0.0)     # row present, value NULL: 0 on the reporting day
    r = T.slice_at(df, "day", d + dt.timedelta(days=1), {"s": ("v", "sum"), "p": ("v", "pick", 0),
                                                          "q": ("v", "pick", None)}).first()
    assert (r.s, r.p, r.q) == (0.0, 0.0, None)                # day missing
    r = T.slice_at(df, "day", d, {"p": ("v", "pick", None), "back": ("v", "pick", None, 1), "far": ("v", "sum", None, 3)}).first()
    assert (r.p, r.back, r.far) == (None, 0.5, 0.2)


def test_fx_stage_lexical(spark):
    df = spark.createDataFrame([("80",), ("9",), ("100",), (None,)], "s string")
    got = [r.ok for r in df.select((F.col("s") >= F.lit("80")).alias("ok")).collect()]
    assert got == [True, True, False, None]


def test_fx_flags(spark):
    df = spark.createDataFrame([("0",), ("1",), (None,)], "w string")
    strict = df.filter(F.col("w").try_cast("int") == 0).count()
    tolerant = df.filter((F.col("w").try_cast("int") == 0) | F.col("w").isNull()).count()
    assert (strict, tolerant) == (1, 2)


def test_fx_dup_metric(spark):
    d, e = D(2024, 1, 1), D(2024, 1, 2)
    rows = spark.createDataFrame([(d, "j1", "x", 1.0, 0), (d, "j1", "X", 5.0, 0), (d, "j2", "x", 2.0, 1), (e, "j1", "x", 7.0, 0)],
                                 "as_of date, job string, metric string, value double, job_ordinal int")
    got = {(r.as_of, r.metric): (r.job, r.value) for r in PO.metric_table(rows).collect()}
    assert got == {(d, "x"): ("j2", 2.0), (d, "X"): ("j1", 5.0), (e, "x"): ("j1", 7.0)}


def test_fx_month(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), 1), (D(2024, 2, 1), 2), (D(2024, 2, 29), 3), (D(2024, 3, 1), 4)],
                               "d date, v int")
    got = {r.d: r.c for r in mtd_cumulative(df, "d", [], {"c": "v"}).collect()}
    assert got == {D(2024, 1, 31): 1, D(2024, 2, 1): 2, D(2024, 2, 29): 5, D(2024, 3, 1): 4}
    one = T.period_filter(df, "d", D(2024, 3, 1), "mtd").collect()
    assert [r.v for r in one] == [4]                          # as_of on the 1st: one day


def test_fx_report_formats(spark):
    df = spark.createDataFrame([(None,), (-0.012345,), (0.0,), (0.12345,), (2.675,), (1234.05,)], "v double")
    r = df.select(fmt.percent("v").alias("p"), fmt.change("v").alias("c"), fmt.fixed("v", 2).alias("f2"),
                  fmt.fixed("v", 1).alias("f1"), fmt.integer("v").alias("i")).collect()
    assert [x.p for x in r] == ["null", "-1.23%", "0.0%", "12.35%", "267.5%", "123405.0%"]
    assert [x.c for x in r] == ["N/A", "-1.23%", "+0.0%", "+12.35%", "+267.5%", "+123405.0%"]
    assert [x.f2 for x in r] == ["null", "-0.01", "0.00", "0.12", "2.68", "1234.05"]
    assert [x.i for x in r] == ["null", "0", "0", "0", "2", "1234"]


def test_day_over_day_keys_nulls_and_kept_columns(spark):
    rows = [(D(2024, 1, 1), "a", 1.0, 5, "x"), (D(2024, 1, 2), "a", 3.0, 6, None), (D(2024, 1, 2), "b", 9.0, 7, "z"),
            (D(2024, 1, 3), "a", None, 8, "w"), (D(2024, 1, 4), "a", 2.0, None, "w"), (D(2024, 1, 1), None, 1.0, 1, "n"),
            (D(2024, 1, 2), None, 2.0, 2, "n"), (None, "a", 4.0, 3, "n")]
    df = spark.createDataFrame(rows, "d date, k string, v double, n int, t string")
    out = PO.day_over_day_change(df, ["k"], "d", changes={"dv": ("v", "v"), "dn": ("v", "n")})
    assert out.columns == ["d", "k", "v", "n", "t", "dv", "dn"]
    got = {(r.d, r.k): (r.v, r.n, r.t, r.dv, r.dn) for r in out.collect()}
    assert got == {(D(2024, 1, 1), "a"): (1.0, 5, "x", None, None), (D(2024, 1, 2), "a"): (3.0, 6, None, 2.0, -2.0),
                   (D(2024, 1, 2), "b"): (9.0, 7, "z", None, None), (D(2024, 1, 3), "a"): (None, 8, "w", None, None),
                   (D(2024, 1, 4), "a"): (2.0, None, "w", None, -6.0), (D(2024, 1, 1), None): (1.0, 1, "n", None, None),
                   (D(2024, 1, 2), None): (2.0, 2, "n", None, None), (None, "a"): (4.0, 3, "n", None, None)}


def test_first_in_window_hot_user_against_row_number(spark):
    """A user with most rows, ranked the plain way for each run day."""
    import random
    rng = random.Random(3)
    day = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(12)]
    who = lambda: "hot" if rng.random() < 0.6 else rng.choice(["u1", "u2", "u3", None])
    entries = [(who(), rng.choice(day), rng.random() < 0.7) for _ in range(3000)]
    events = [(who(), rng.choice(day[::2]), rng.random()) for _ in range(400)]
    e = spark.createDataFrame(entries, "u string, d date, c boolean")
    v = spark.createDataFrame(events, "u string, vd date, t double")
    got = {r.d: (r.entries, r["first"], r["any"]) for r in J.first_in_window_conversion(e, v, "u", "d", "vd", F.col("c")).collect()}
    want = {}
    for d in {x[1] for x in entries}:
        first = {}
        for u, vd, t in events:
            if u is not None and vd in (d, d - dt.timedelta(days=1)):
                first[u] = min(first.get(u, (vd, t)), (vd, t))
        mine = [u for u, x, c in entries if x == d and c]
        any_ = {u for u, vd, _ in events if vd == d}
        want[d] = (len(mine), sum(u in first and first[u][0] == d for u in mine), sum(u is not None and u in any_ for u in mine))
    assert got == want


@pytest.mark.parametrize("bucket", ["day", "hour", "minute"])
def test_event_sequence_equals_row_number(spark, bucket):
    """A hot key, equal times, null keys and null times, in every bucket width."""
    from pyspark.sql import Window
    rows = [(["hot", "a", None][min(i % 5, 2)], None if i % 41 == 0 else dt.datetime(2024, 1, 1 + i % 9, i % 24, (7 * i) % 60), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "u string, t timestamp_ntz, id int").repartition(7)
    w = Window.partitionBy("u").orderBy("t", "id")
    want = {r.id: r.n for r in df.withColumn("n", F.row_number().over(w)).collect()}
    assert {r.id: r.n for r in event_sequence(df, "u", "t", "id", "n", bucket=bucket).collect()} == want


def test_day_over_day_gap(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 0.5), (D(2024, 1, 2), 0.7), (D(2024, 1, 4), 0.1)],
                               "d date, v double")
    got = {r.d: r.dod for r in PO.day_over_day_change(df, [], "d", "v", "dod").collect()}
    assert got[D(2024, 1, 1)] is None
    assert abs(got[D(2024, 1, 2)] - 0.2) < 1e-12
    assert got[D(2024, 1, 4)] is None                         # previous day missing


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")], "u int, dt string")
    assert sorted(r.u for r in T.latest_snapshot(df, "dt").collect()) == [2, 3]


def test_same_day_conversion(spark):
    d = D(2024, 1, 5)
    e = spark.createDataFrame([(1, d), (1, d), (2, d), (3, d)], "u int, day date")
    c = spark.createDataFrame([(1, d), (1, d), (2, d + dt.timedelta(days=1))], "u int, cday date")
    r = J.same_day_conversion(e, c, "u", "day", "cday").first()
    assert (r.entry_users, r.conv_users, r.rate) == (3, 1, 1 / 3)


def test_cohort_conversion_hot_key_exact(spark):
    # one key holds most conversion rows (a third of all rows and more);
    # the pre-aggregated plan must still give the exact row-grain counts
    d0 = D(2024, 1, 10)
    entries = [("hot", d0, "s"), ("hot", d0, "s"), ("k1", d0, "s"), ("k2", d0 + dt.timedelta(days=1), "s")]
    convs = [("hot", d0 + dt.timedelta(days=i % 12 - 3)) for i in range(4000)] + \
            [("k1", d0), ("k1", d0 + dt.timedelta(days=9))]
    windows = {"t0": (None, 0), "t7": (None, 7), "w": (0, 7, -1)}
    e = spark.createDataFrame(entries, "k string, eday date, seg string")
    c = spark.createDataFrame(convs, "k string, cday date").repartition(16)
    for grain in ("row", "entity"):
        got = J.cohort_conversion(e, c, "k", "eday", "cday", ["seg"], windows, grain).collect()
        want = _brute_cohort(entries, convs, windows, grain)
        for r in got:
            for name in windows:
                assert (r[f"{name}_rows"], r[f"{name}_conv"]) == want[(r.eday, r.seg, name)], (grain, name)


def test_report_of_two_days_prints_null_for_what_a_day_lacks(spark):
    from tallyspark.operators.report import layout_rows, report_lines
    layout = layout_rows("v", [("0 header", ["Date: {$as_of} Unit: {$unit}"]),
                               ("s", ["A {a:pct}, B {b:f1}, change {c:chg}, count {d:int}", "plain", ""])])
    d, e = D(2024, 1, 1), D(2024, 1, 2)
    metrics = spark.createDataFrame([(d, "a", 0.5), (d, "d", 12.9), (e, "a", None), (e, "b", 2.25), (e, "c", 0.1)],
                                    "as_of date, metric string, value double")
    got = {(r.as_of, r.section, r.line_no): r.text for r in report_lines(metrics, layout, {"unit": "USD"}).collect()}
    assert got == {(d, "0 header", 1): "Date: 2024-01-01 Unit: USD", (e, "0 header", 1): "Date: 2024-01-02 Unit: USD",
                   (d, "s", 1): "A 50.0%, B null, change N/A, count 12", (e, "s", 1): "A null, B 2.3, change +10.0%, count null",
                   (d, "s", 2): "plain", (e, "s", 2): "plain", (d, "s", 3): "", (e, "s", 3): ""}
    with pytest.raises(ValueError, match="unit"):
        report_lines(metrics, layout)


def test_completeness_of_two_days(spark):
    d, e = D(2024, 1, 1), D(2024, 1, 2)
    metrics = spark.createDataFrame([(d, "a", 1.0), (d, "b", None), (e, "b", float("nan"))], "as_of date, metric string, value double")
    got = {(r.as_of, r.metric): (r.job, r.status) for r in PO.metric_completeness(metrics, [("j", "a"), ("k", "b")]).collect()}
    assert got == {(d, "a"): ("j", "ok"), (d, "b"): ("k", "null"), (e, "a"): ("j", "missing"), (e, "b"): ("k", "null")}


def test_fx_loan_versions(spark):
    """0, 1 and 2 versions of a listing, in both grains."""
    d = D(2024, 1, 30)
    entry = spark.createDataFrame([("f0", d, "a"), ("f1", d, "a"), ("f2", d, "a"), ("f3", d, "a")],
                                  "flow_id string, limit_day date, seg string")
    mid = spark.createDataFrame([("f0", "l0", d), ("f1", "l1", d), ("f2", "l2", d), ("f2", None, d + dt.timedelta(days=9))],
                                "flow_id string, listing_id string, wd date")
    versions = spark.createDataFrame([("l1",), ("l2",), ("l2",), (None,)], "listing_id string")
    conv = J.with_versions(mid, versions, "listing_id", "n")
    assert sorted((r.flow_id, r.listing_id or "", r.n) for r in conv.collect()) == [
        ("f0", "l0", 1), ("f1", "l1", 1), ("f2", "", 1), ("f2", "l2", 2)]
    plain = entry.join(mid, "flow_id", "left").join(versions, "listing_id", "left")
    rows, hits = plain.count(), plain.filter("wd = limit_day").count()
    for grain, expected in (("row", (rows, hits)), ("entity", (4, 3))):
        r = J.cohort_conversion(entry, conv, "flow_id", "limit_day", "wd", ["seg"], {"t": (0, 0)}, grain=grain, weight="n").first()
        assert (r.t_rows, r.t_conv) == expected, grain
