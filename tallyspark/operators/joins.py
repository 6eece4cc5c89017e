"""Join operators.

Shuffle discipline: the conversion side of a cohort is pre-aggregated to one
row per (key, day) *before* it is joined, so a key that holds a third of all
conversion rows arrives at the join as at most one row per calendar day.
Dimension-like right sides are joined with a plain equi-join; AQE turns it
into a broadcast only when the measured size is below the broadcast
threshold, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import flag, safe_div


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def cohort_conversion(entry: DataFrame, conv: DataFrame, on: str | Sequence[str],
                      entry_day: str, conv_day: str, segments: Sequence[str] = (),
                      windows: dict | None = None, grain: str = "row", weight: str | None = None) -> DataFrame:
    """Conversion of an entry cohort (per entry day and segment).

    ``entry`` has the join key(s), ``entry_day`` and ``segments``; ``conv`` has
    the key(s) and ``conv_day``.  ``windows`` maps a name to ``(lo, hi)`` or
    ``(lo, hi, scope_lo)``: a joined conversion row converts for that window
    when ``lo <= datediff(conv_day, entry_day) <= hi`` (``None`` = open; the
    difference is signed, so ``hi=0`` also accepts conversions *before* the
    entry day).  ``scope_lo`` drops joined rows with a difference below it
    before counting (a lower bound the reference applies to the joined table).

    grain ``row`` reproduces a LEFT JOIN followed by AVG over joined rows:
    an entry with m matches is m rows, one without matches is one row.
    grain ``entity`` counts each entry once: converted if any match is in
    the window.  ``weight`` is a column of ``conv``: that many joined rows stand
    behind each of its rows (1 without it).

    Output: ``entry_day``, segments, and per window ``<w>_rows``,
    ``<w>_conv``, ``<w>_rate``.
    """
    keys = _keys(on)
    windows = windows or {"t0": (None, 0)}
    e = entry.groupBy(*keys, entry_day, *segments).agg(F.count(F.lit(1)).alias("_m"))
    # a conversion row with a NULL day still counts as a joined row (it never converts)
    c = conv.groupBy(*keys, conv_day).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    j = e.join(c, keys, "left")
    diff = F.datediff(F.col(conv_day), F.col(entry_day))
    per_entry = []
    for name, spec in windows.items():
        lo, hi = spec[0], spec[1]
        scope_lo = spec[2] if len(spec) > 2 else None
        in_scope = F.col("_n").isNotNull()
        if scope_lo is not None:
            in_scope = in_scope & (diff >= scope_lo)
        hit = in_scope & diff.isNotNull()
        if lo is not None:
            hit = hit & (diff >= lo)
        if hi is not None:
            hit = hit & (diff <= hi)
        per_entry.append(F.sum(F.when(in_scope, F.col("_n")).otherwise(0)).alias(f"_{name}_in"))
        per_entry.append(F.sum(F.when(hit, F.col("_n")).otherwise(0)).alias(f"_{name}_hit"))
    # grouped by the join key first: co-partitioned with the join, no shuffle
    g = j.groupBy(*keys, entry_day, *segments, "_m").agg(*per_entry)
    final = []
    for name in windows:
        n_in, n_hit, m = F.col(f"_{name}_in"), F.col(f"_{name}_hit"), F.col("_m")
        if grain == "row":
            rows = m * F.greatest(n_in, F.lit(1))
            conv_ = m * n_hit
        elif grain == "entity":
            rows = m
            conv_ = m * F.when(n_hit > 0, 1).otherwise(0)
        else:
            raise ValueError(grain)
        final.append(F.sum(rows).cast("bigint").alias(f"{name}_rows"))
        final.append(F.sum(conv_).cast("bigint").alias(f"{name}_conv"))
    out = g.groupBy(entry_day, *segments).agg(*final)
    return out.withColumns({f"{n}_rate": safe_div(f"{n}_conv", f"{n}_rows") for n in windows})


def same_day_conversion(entry: DataFrame, conv: DataFrame, user: str, entry_day: str,
                        conv_day: str, segments: Sequence[str] = ()) -> DataFrame:
    """Distinct entry users per day, and how many of them also appear in
    ``conv`` on the same day (COUNT DISTINCT on both sides of a LEFT JOIN on
    user and day).  Both sides are reduced to distinct (user, day) first."""
    e = entry.select(user, F.col(entry_day).alias("_d"), *segments).distinct()
    c = (conv.select(user, F.col(conv_day).alias("_d")).distinct()
             .withColumn("_hit", F.lit(1)))
    j = e.join(c, [user, "_d"], "left")
    # both sides are distinct on (user, day): each joined row is one distinct
    # user of its day and matches at most once, so plain counts are the
    # distinct counts (no Expand, no second shuffle)
    out = j.groupBy(F.col("_d").alias(entry_day), *segments).agg(
        F.count(F.lit(1)).alias("entry_users"),
        F.count(F.col("_hit")).alias("conv_users"))
    return out.withColumn("rate", safe_div("conv_users", "entry_users"))


def first_in_window_flags(events: DataFrame, key: str, event_day: str, day: str = "day") -> DataFrame:
    """Which days of a key would have its first event in the two days that end
    there: one row per (key, day) with an event on the day or the day before,
    ``this_day`` and ``day_before``.  An event is dealt to its own day and the
    next; the flags come from one aggregate, so a key with very many events is
    one row a day after the map side.  Null keys and days are left out."""
    on = F.col(event_day)
    dealt = F.array(F.struct(on.alias("_d"), F.lit(True).alias("_this")), F.struct(F.date_add(on, 1).alias("_d"), F.lit(False).alias("_this")))
    return (events.where(F.col(key).isNotNull() & on.isNotNull()).select(F.col(key), F.explode(dealt).alias("_e"))
            .groupBy(key, F.col("_e._d").alias(day))
            .agg(F.max("_e._this").alias("this_day"), F.max(~F.col("_e._this")).alias("day_before")))


def first_in_window_conversion(entry: DataFrame, events: DataFrame, key: str, entry_day: str, event_day: str,
                               counted: Column) -> DataFrame:
    """Daily conversion of entries to a first event of their key, one join.

    For the entries of a day for which ``counted`` holds: ``entries``; ``first``,
    how many of their keys have an event that day and none the day before (the
    day's event is the first of the two days that end there); ``any``, how many
    have an event that day (what the first of the two days of the next run
    matches).  Days without a counted entry keep a row of zeros.  Entries are
    counted by (key, day) before the join, events are one row there: a key with
    a third of all rows meets one row."""
    e = entry.groupBy(key, entry_day).agg(F.sum(flag(counted)).alias("_n"))
    f = first_in_window_flags(events, key, event_day, entry_day)
    n = F.col("_n")
    return (e.join(f, [key, entry_day], "left").groupBy(entry_day).agg(
        F.sum(n).cast("bigint").alias("entries"),
        F.sum(F.when(F.col("this_day") & ~F.col("day_before"), n).otherwise(0)).cast("bigint").alias("first"),
        F.sum(F.when(F.col("this_day"), n).otherwise(0)).cast("bigint").alias("any")))


def membership_flag(df: DataFrame, members: DataFrame, key: str, name: str = "is_member") -> DataFrame:
    """Flag rows whose key is in ``members`` (LEFT JOIN to the distinct member
    set + null test).  The right side is made distinct first, so the join can
    never add rows; NULL keys are never members."""
    m = members.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_hit", F.lit(True))
    return (df.join(m, key, "left")
              .withColumn(name, F.coalesce(F.col("_hit"), F.lit(False)))
              .drop("_hit"))


def with_versions(df: DataFrame, versions: DataFrame, key: str, name: str) -> DataFrame:
    """How many rows a LEFT JOIN to ``versions`` on ``key`` makes of each row of
    ``df``, as a column instead of the rows: the number of versions of its key, 1
    where there is none.  ``versions`` is counted by key first, so the join
    matches one row at most."""
    n = versions.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return df.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(1).cast("bigint")))


def chained_enrichment(base: DataFrame, steps: Sequence[tuple[DataFrame, str | Sequence[str]]]) -> DataFrame:
    """A -> B -> C left joins: each step adds the columns of a dimension keyed
    by a column already present (row fan-out of duplicate keys is kept)."""
    out = base
    for dim, on in steps:
        out = out.join(dim, _keys(on), "left")
    return out


def allow_list_join(df: DataFrame, allowed: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Keep rows whose key is on the allow-list.  ``unique=True`` declares the
    list distinct and plans a LEFT SEMI join (no fan-out possible); otherwise
    an INNER join keeps the reference's multiplicity."""
    if unique:
        return df.join(allowed.select(key), key, "left_semi")
    return df.join(allowed.select(key), key, "inner")


def join_on_predicate(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                      right_pred: Column | None = None, how: str = "left") -> DataFrame:
    """LEFT JOIN right ON l.a = r.b AND <predicate on right>: the predicate
    filters the right side before the join (it must not drop left rows)."""
    r = right.filter(right_pred) if right_pred is not None else right
    cond = None
    for lc, rc in on:
        c = left[lc] == r[rc]
        cond = c if cond is None else cond & c
    return left.join(r, cond, how)


def cost_per_acquisition(cost: DataFrame, conversions: DataFrame, day: str, cost_col: str,
                         conv_col: str, name: str = "cps") -> DataFrame:
    """Daily cost / daily conversions: both sides pre-aggregated to one row
    per day, then LEFT JOINed on the day (cost days drive the output)."""
    c = cost.groupBy(day).agg(F.sum(cost_col).alias("cost"))
    v = conversions.groupBy(day).agg(F.sum(conv_col).alias("conversions"))
    return (c.join(v, day, "left")
             .select(day, F.col("cost").cast("double").alias("cost"),
                     F.col("conversions").cast("bigint").alias("conversions"),
                     safe_div("cost", "conversions").alias(name)))
