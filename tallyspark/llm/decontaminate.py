"""Operator 3: benchmark decontamination as a prefix-filtered set join.

An item's windows (``window`` consecutive words, or the whole item if it has
fewer) are looked for in the documents.  A window is the set of its ``shingle``
-word shingles; since all of them must be found, one prefix token is enough,
and it is the window's rarest shingle by document count over the whole corpus.

1. Count, for every item shingle, the documents' occurrences (all documents).
2. Each window's rarest shingle becomes its prefix token.
3. Documents emit their occurrences of prefix tokens with the words around.
   The join on the token gives, with the shingle's offset in the window, the
   only place where the window could lie.  It is dropped where it would begin
   before the text (positional bound) or end after it (length bound); the words
   then decide exactly.

Documents are screened by a Bloom filter of fixed size before each join, so the
benchmark may have any size; the joins behind it are exact.  A frequent token's
occurrences spread by Spark's skew handling: only the join needs them together.

Defined results: null texts have no words and no hits; items without words have
no windows; repeated rows are judged each, by (id, text); equal windows of
several items count for each of them; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (ALNUM_WORD, Bloom, build_bloom, byte_table, chunks, find_words, hash_spans, save,
                     shingle_hashes)

WINDOW, SHINGLE = 10, 3
FOLD, IS_WORD = byte_table(True, ALNUM_WORD)


def _words(column: pa.Array):
    """For each run of texts: (first row, last row, folded bytes, word starts, ends, word range of each text)."""
    for lo, hi, data, offs in chunks(column):
        low = FOLD[data]
        yield lo, hi, low, *find_words(low, offs, IS_WORD)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, win, size, words, at, token): each shingle of each window, with
    its place in the window.  ``words`` is the window, its words parted by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            out = {k: [] for k in ("row", "win", "size", "words", "at", "token")}
            for lo, hi, low, starts, ends, bounds in _words(b.column(1)):
                hashes = hash_spans(low, starts, ends)
                raw = low.tobytes()
                for i in range(hi - lo):
                    first, last = int(bounds[i]), int(bounds[i + 1])
                    words = [raw[s:e] for s, e in zip(starts[first:last].tolist(), ends[first:last].tolist())]
                    size = min(window, len(words))
                    k = min(shingle, size)
                    for w in range(len(words) - size + 1 if words else 0):
                        tokens = shingle_hashes(hashes[first + w:first + w + size], k).view(np.int64)
                        text = b" ".join(words[w:w + size])
                        for at, t in enumerate(tokens.tolist()):
                            for key, v in zip(out, (lo + i, w, size, text, at, t)):
                                out[key].append(v)
            if out["row"]:
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(out["row"])), pa.array(out["win"], pa.int32()), pa.array(out["size"], pa.int32()),
                     pa.array(out["words"], pa.binary()), pa.array(out["at"], pa.int32()), pa.array(out["token"], pa.int64())],
                    names=["item_id", "win", "size", "words", "at", "token"])

    kind = items.schema[id_col].dataType.simpleString()
    return items.select(id_col, text_col).mapInArrow(
        run, f"item_id {kind}, win int, size int, words binary, at int, token long")


def token_counts(docs: DataFrame, text_col: str, screen: Bloom, sizes: tuple[int, ...]) -> DataFrame:
    """(token, n): occurrences of screened shingles over all documents, summed in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for _, _, low, starts, ends, bounds in _words(b.column(0)):
                hashes = hash_spans(low, starts, ends)
                last = np.repeat(bounds[1:], np.diff(bounds))
                for k in sizes:
                    t = shingle_hashes(hashes, k)
                    t = t[np.arange(len(t)) + k <= last[:len(t)]]
                    got.append(t[screen.has(t)])
            if got:
                token, n = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["token", "n"])

    return docs.select(text_col).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def document_scan(docs: DataFrame, id_col: str, text_col: str, screen: Bloom, sizes: tuple[int, ...], window: int) -> DataFrame:
    """(id, text_hash, n_words, found): ``found`` lists the screened shingle
    occurrences: token, word position, how many of the words given lie before it,
    and those words, parted by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            n_words = np.zeros(n, np.int64)
            per = np.zeros(n, np.int64)
            parts = []
            for lo, hi, low, starts, ends, bounds in _words(b.column(2)):
                n_words[lo:hi] = np.diff(bounds)
                hashes = hash_spans(low, starts, ends)
                doc = np.repeat(np.arange(hi - lo), np.diff(bounds))
                raw = low.tobytes()
                at, token = [], []
                for k in sizes:
                    t = shingle_hashes(hashes, k)
                    ok = np.arange(len(t)) + k <= bounds[1:][doc[:len(t)]] if len(t) else np.zeros(0, bool)
                    hit = np.flatnonzero(ok & screen.has(t))
                    at.append(hit)
                    token.append(t[hit])
                at, token = np.concatenate(at), np.concatenate(token)
                order = np.argsort(at, kind="stable")
                at, token = at[order], token[order]
                per[lo:hi] += np.bincount(doc[at], minlength=hi - lo) if len(at) else 0
                first = np.maximum(at - window + 1, bounds[:-1][doc[at]])
                last = np.minimum(at + window, bounds[1:][doc[at]])
                around = [b" ".join([raw[s:e] for s, e in zip(starts[f:g].tolist(), ends[f:g].tolist())])
                          for f, g in zip(first.tolist(), last.tolist())]
                parts.append((token.view(np.int64), at - bounds[:-1][doc[at]], at - first, around))
            offsets = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
            cat = (lambda i: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64))
            found = pa.StructArray.from_arrays(
                [pa.array(cat(0), pa.int64()), pa.array(cat(1).astype(np.int32)), pa.array(cat(2).astype(np.int32)),
                 pa.array([x for p in parts for x in p[3]], pa.binary())], names=["token", "pos", "before", "around"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n_words), pa.ListArray.from_arrays(pa.array(offsets), found)],
                names=["id", "text_hash", "n_words", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), text_col).mapInArrow(
        run, f"id {kind}, text_hash long, n_words long, found array<struct<token:long,pos:int,before:int,around:binary>>")


def find_contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text",
                       window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row for each document: ``doc_id``, ``text_hash``, ``n_words``, ``n_hit``
    (words inside an occurring window), ``spans`` (those windows as
    (start, size) in words) and ``items`` (sorted distinct item ids)."""
    windows = save(item_windows(items, item_id, item_text, window, shingle), "decon-windows")
    sizes = tuple(range(1, shingle + 1))
    counts = token_counts(docs, text, build_bloom(windows.select("token").distinct(), "token"), sizes)
    rarest = (windows.join(counts, "token", "left")
              .groupBy("item_id", "win", "size", "words")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at")).alias("r")))
    prefix = save(rarest.select("item_id", "size", "words", "r.token", "r.at"), "decon-prefix")
    scan = save(document_scan(docs, doc_id, text, build_bloom(prefix.select("token").distinct(), "token"), sizes, window), "decon-scan")
    found = scan.select("id", "text_hash", "n_words", F.explode("found").alias("f")).select("id", "text_hash", "n_words", "f.*")
    start = F.col("pos") - F.col("at")
    skip = F.col("before") - F.col("at")  # words of ``around`` before the window
    placed = (found.join(prefix, "token")
              .where((start >= 0) & (start + F.col("size") <= F.col("n_words")) & (skip >= 0))
              .withColumn("around_words", F.split(F.decode("around", "utf-8"), " ")))
    exact = placed.where(F.array_join(F.slice("around_words", skip + 1, F.col("size")), " ") == F.decode("words", "utf-8"))
    hits = (exact.groupBy("id", "text_hash")
            .agg(F.sort_array(F.collect_set(F.struct(start.alias("start"), "size"))).alias("spans"),
                 F.sort_array(F.collect_set("item_id")).alias("items"))
            .withColumnRenamed("id", "hit_id").withColumnRenamed("text_hash", "hit_hash"))
    # words covered: each span adds what lies beyond the ends of the spans before it
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(acc["end"], s["start"]))).cast("long").alias("n"),
            F.greatest(acc["end"], s["start"] + s["size"]).alias("end")),
        lambda acc: acc["n"])
    return (scan.select("id", "text_hash", "n_words")
            .join(hits, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
            .select(F.col("id").alias(doc_id), "text_hash", "n_words", F.coalesce(covered, F.lit(0)).alias("n_hit"),
                    F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,size:int>>)")).alias("spans"),
                    F.coalesce("items", F.expr(f"cast(array() as array<{items.schema[item_id].dataType.simpleString()}>)")).alias("items")))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) without a hit, unchanged."""
    bad = find_contamination(docs, items).where("n_hit > 0").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_hash"]), "left_anti")


def digests(found: DataFrame) -> DataFrame:
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    return digests(find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                                      spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
