"""Operator 10: secret scans over an incremental blob ledger.

Every version of a text is addressed by its SHA-256 (a blob).  The ledger is a
Parquet table with one row for each scanned (blob, rules version) pair and its
findings.  A scan takes the blobs that the ledger lacks for the current rules,
each of them once however many paths hold it, appends their rows, and joins the
findings back to all paths.  Re-running it on the same data scans nothing; a
new rules version scans every blob again, beside the old rows.

The ledger is appended to in one commit, so a scan that dies leaves it as it
was.  Two scans that run side by side can both append a blob; equal rows are
read once.

Defined results: a null text is the empty blob, without findings; rows with
equal text share a blob and get the same findings, each; other columns pass
through ``scan_documents`` untouched, except ``blob`` and ``findings``, which
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path

RULES_VERSION = "2"
#: Kinds in the order of the output; the first three are the base.
KINDS = ("assign", "access", "hex", "private_key", "jwt", "platform_token", "url_password")
HOT_SHARE, SALTS = 500, 64
LEDGER_SCHEMA = "blob string, rules string, findings array<struct<start:int,kind_no:int,end:int>>"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: (kind, what a text must hold to be searched, pattern)
MORE = (
    (3, "-----BEGIN ", re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?")),
    (4, "eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")),
    (5, "_", re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|[sr]k_live_[A-Za-z0-9]{24,})")),
    (5, "xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{20,}")),
    (6, "://", re.compile(r"\b[a-z][a-z0-9+.-]*://[^\s/:@]+:([^\s/@]+)@")),
)


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, sorted.  Quick tests for a rule's
    literals come before its pattern; they never change the result."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for kind, needs, pattern in MORE:
        if needs in text:
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return sorted(out)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [find_secrets(t.as_py()) for t in b.column(1)]
        flat = [x for f in found for x in f]
        ends = [0]
        for f in found:
            ends.append(ends[-1] + len(f))
        rows = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], pa.int32()) for i in range(3)], names=["start", "kind_no", "end"])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)],
                                         names=["blob", "findings"])


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows, none where it doesn't exist yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def with_blobs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.withColumn("blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def update_ledger(docs: DataFrame, ledger: str, text_col: str = "text", rules: str = RULES_VERSION) -> None:
    """Scan the blobs of ``docs`` that the ledger lacks under ``rules`` and append them."""
    spark = docs.sparkSession
    known = read_ledger(spark, ledger).where(F.col("rules") == rules).select("blob")
    text = F.coalesce(F.col(text_col), F.lit("")).alias("blob_text")
    new = (with_blobs(docs.select(text), "blob_text").join(known, "blob", "left_anti")
           .dropDuplicates(["blob"]).select("blob", "blob_text"))
    (new.mapInArrow(_scan, "blob string, findings array<struct<start:int,kind_no:int,end:int>>")
     .select("blob", F.lit(rules).alias("rules"), "findings").write.mode("append").parquet(ledger))


def scan_documents(docs: DataFrame, ledger: str, text_col: str = "text", rules: str = RULES_VERSION) -> DataFrame:
    """``docs`` with ``blob`` and ``findings`` (start, kind_no, end; sorted), after
    the ledger has been brought up to date.  Blobs with more than a HOT_SHARE-th of
    all paths (fewer than HOT_SHARE of them) are joined back in SALTS parts."""
    update_ledger(docs, ledger, text_col, rules)
    rows = (read_ledger(docs.sparkSession, ledger).where(F.col("rules") == rules)
            .dropDuplicates(["blob"]).select("blob", "findings"))
    keyed = with_blobs(docs.drop("findings"), text_col)
    limit = max(SALTS, docs.count() // HOT_SHARE)
    hot = (keyed.groupBy("blob").agg(F.count("*").alias("n")).where(F.col("n") > limit)
           .select("blob", F.lit(SALTS).alias("salts_")))  # fewer than HOT_SHARE rows
    salt = F.when(F.col("salts_").isNotNull(), F.pmod(F.spark_partition_id() * 31 + F.pmod(F.monotonically_increasing_id(), F.lit(31)), F.lit(SALTS)))
    paths = keyed.join(F.broadcast(hot), "blob", "left").withColumn("salt_", F.coalesce(salt, F.lit(0)).cast("int")).drop("salts_")
    parts = rows.join(F.broadcast(hot), "blob", "left").select(
        "blob", "findings", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts_") - 1, F.lit(0)))).alias("salt_"))
    return paths.join(parts, ["blob", "salt_"]).drop("salt_")


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Texts with every finding's span (overlaps as one) replaced by ``mark``."""
    merged = F.aggregate(
        "findings", F.expr("cast(array() as array<struct<s:int,e:int>>)"),
        lambda acc, f: F.when(
            (F.size(acc) > 0) & (f["start"] <= F.element_at(acc, -1)["e"]),
            F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                     F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], f["end"]).alias("e")))))
        .otherwise(F.concat(acc, F.array(F.struct(f["start"].alias("s"), f["end"].alias("e"))))))
    text = F.col(text_col)
    spans = scanned.withColumn("spans_", F.when(F.size("findings") > 0, merged))
    kept = F.transform("spans_", lambda s, i: F.substring(
        text, F.coalesce(F.get("spans_", i - 1)["e"], F.lit(0)) + 1, s["s"] - F.coalesce(F.get("spans_", i - 1)["e"], F.lit(0))))
    tail = F.substring(text, F.element_at("spans_", -1)["e"] + 1, F.lit(2**31 - 1))
    return spans.withColumn(text_col, F.when(
        F.size("findings") > 0, F.concat(F.array_join(kept, mark), F.lit(mark), tail)).otherwise(text)).drop("spans_")


def digests(scanned: DataFrame) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda f: F.concat_ws(
            ":", F.get(kinds, f["kind_no"]), f["start"].cast("string"), f["end"].cast("string"))), ",")

    def count(no: int):
        return F.size(F.filter("findings", lambda f: f["kind_no"] == no)).cast("long")

    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.filter("findings", lambda f: f["kind_no"] < 3)), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table comes in two deliveries, by a hash of the id; the second time all
    rows are given, and only blobs that the first delivery did not hold are scanned."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ledger = scratch_path(spark, "secret-ledger")
    update_ledger(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), ledger)
    return digests(scan_documents(docs, ledger).drop("text"))
