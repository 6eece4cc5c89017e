"""Operator 4: quality rules with adaptive thresholds, in DataFrame functions only.

Fixed cutoffs are replaced by fences from mergeable quantile sketches.  A sketch
is a histogram of integer values in buckets that are exact up to 64 and 1/32
wide, relative to the value, above; two sketches merge by adding their counts,
in any order and with the same result, so sketches of (language, source) groups
are built in one aggregation and those of a language and of all texts are sums
of them.  A group's fence for a measure is

    q90 + max(spread of the measure * (q90 - q50), floor of the measure)

from its own sketch, or from its language's, or from that of all texts where
fewer than ``MIN_GROUP`` texts stand behind it.  A text beyond a fence fails.
Texts that fail the base rules stand in no sketch.

Spreads and floors are the only constants.  A floor decides where nine texts in
ten of a group have (nearly) one value: for symbols, where these texts have
none, it is half a percent.  For repeated lines it nearly always decides: most
texts have none and a clean one may have a few, which no quantile can tell from
junk.  Shouting and repeated words are decided by the quantiles.

Measures, in thousandths: symbols and shouted characters to characters in words,
repeated words to words, repeated lines to lines with words.

Defined results: a null text has no words and fails the base rules; null
languages and sources are groups of their own; repeated rows count each.  Runs
of three words are compared by 64-bit hashes within a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

#: measure -> (times the distance of q90 from q50 that its fence lies above q90, least distance in thousandths)
MEASURES = {"symbols": (8, 5), "shouted": (8, 10), "repeated": (20, 100), "dup_lines": (8, 400)}
MIN_GROUP = 200
SPACE = "[ \\t-\\r]"


def _once(df: DataFrame, keep: list[str], **columns) -> DataFrame:
    """Columns computed in one place: behind a generator they are values, which
    lambdas over them do not compute again for each element."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def text_measures(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouted."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    a = _once(docs, keep,
              hashes=F.transform(words, lambda w: F.xxhash64(w)),
              lines=lines,
              word_chars=(F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long"),
              n_symbols=F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
              n_shouted=F.regexp_count(text, F.lit("[A-Z!]")).cast("long"))
    plain = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_shouted"]
    b = _once(a, [*keep, "word_chars", "n_symbols", "n_shouted"],
              n_words=F.size("hashes").cast("long"),
              n_lines=F.size("lines").cast("long"),
              n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
              runs=F.sort_array(F.transform(
                  F.slice("hashes", 1, F.greatest(F.size("hashes") - 2, F.lit(0))),
                  lambda h, i: F.struct(F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)).alias("h"), i.alias("i")))))
    c = _once(b, [*keep, *plain],
              again=F.transform(F.filter("runs", lambda x, k: F.coalesce(x["h"] == F.get("runs", k - 1)["h"], F.lit(False))
                                         | F.coalesce(x["h"] == F.get("runs", k + 1)["h"], F.lit(False))), lambda x: x["i"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform("again", lambda i: F.array(i, i + 1, i + 2)))))
    return c.select(*keep, *plain, covered.cast("long").alias("n_repeat_words"))


def measured(rows: DataFrame) -> DataFrame:
    """``rows`` of text_measures with the measures in thousandths (0 without words)."""
    def share(a: str, b: str):
        return F.coalesce(F.expr(f"(1000 * {a}) div nullif({b}, 0)"), F.lit(0)).cast("long")
    return rows.withColumns({"symbols": share("n_symbols", "word_chars"), "shouted": share("n_shouted", "word_chars"),
                             "repeated": share("n_repeat_words", "n_words"), "dup_lines": share("n_dup_lines", "n_lines")})


def bucket(value):
    """Lower end of a value's bucket: the value up to 63, then its six leading bits."""
    low_bits = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(F.call_function(
        "shiftleft", F.call_function("shiftright", value, low_bits), low_bits))


def sketches(rows: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, bucket, n): one histogram sketch for each group and measure."""
    long = rows.select(*groups, F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])))
    return long.groupBy(*groups, "measure", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, size, fence) from the sketches merged to the groups ``by``."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by, "measure")
    rank = merged.withColumns({"upto": F.sum("n").over(w.orderBy("bucket")), "size": F.sum("n").over(w)})
    spread, floor = (F.create_map(*[F.lit(x) for m, v in MEASURES.items() for x in (m, v[i])])[F.col("measure")] for i in (0, 1))
    quantiles = rank.groupBy(*by, "measure", "size").agg(
        F.min(F.when(2 * F.col("upto") >= F.col("size"), F.col("bucket"))).alias("q50"),
        F.min(F.when(10 * F.col("upto") >= 9 * F.col("size"), F.col("bucket"))).alias("q90"))
    return quantiles.select(*by, "measure", "size",
                            (F.col("q90") + F.greatest(spread * (F.col("q90") - F.col("q50")), floor)).alias("fence"))


def group_fences(rows: DataFrame, groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """One row for each (language, source) of ``rows``: its fence of each measure,
    from the rows that pass the base rules; null where no row does."""
    lang, source = groups
    sketch = save(sketches(rows.where("not base_failed"), [lang, source]), "quality-sketches")
    own, by_lang, of_all = fences(sketch, [lang, source]), fences(sketch, [lang]), fences(sketch, [])
    names = rows.groupBy(lang, source).agg(F.count("*").alias("rows")).select(
        lang, source, F.explode(F.array(*[F.lit(m) for m in MEASURES])).alias("measure"))
    n, g, l, a = names.alias("n"), own.alias("g"), by_lang.alias("l"), of_all.alias("a")

    def same(other: str, columns: list[str]):
        out = F.col("n.measure") == F.col(f"{other}.measure")
        for c in columns:
            out = out & F.col(f"n.{c}").eqNullSafe(F.col(f"{other}.{c}"))
        return out

    best = (n.join(g, same("g", [lang, source]), "left").join(l, same("l", [lang]), "left").join(a, same("a", []), "left")
            .select(f"n.{lang}", f"n.{source}", "n.measure",
                    F.when(F.col("g.size") >= MIN_GROUP, F.col("g.fence"))
                    .when(F.col("l.size") >= MIN_GROUP, F.col("l.fence")).otherwise(F.col("a.fence")).alias("fence")))
    return best.groupBy(lang, source).agg(*[F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(f"{m}_fence") for m in MEASURES])


def apply_rules(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``keep``, the groups, all measures with their fences, ``base_failed`` and ``kept``."""
    columns = list(dict.fromkeys([*keep, *groups]))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = save(measured(text_measures(docs, columns, text_col)).withColumn("base_failed", base), "quality-measures")
    limits = group_fences(rows, groups)
    lang, source = groups
    r, f = rows.alias("r"), limits.alias("f")
    joined = r.join(f, F.col(f"r.{lang}").eqNullSafe(F.col(f"f.{lang}")) & F.col(f"r.{source}").eqNullSafe(F.col(f"f.{source}")))
    kept = ~F.col("base_failed")
    for m in MEASURES:
        kept = kept & (F.col(m) <= F.col(f"{m}_fence"))
    return joined.select("r.*", *[f"f.{m}_fence" for m in MEASURES], kept.alias("kept"))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "base_failed", "kept")
