"""Operator 8: removal of repeated byte strings by sharded suffix arrays.

Every byte covered by a ``length``-byte string that also starts anywhere else
goes.  Two equal strings hold equal bytes, so they agree on the least of the
hashes of their GRAM-byte grams; that gram's occurrence is the string's anchor.
Strings are dealt to shards by the anchor's hash, so equal strings meet:

1. All texts: the runs of string starts that share an anchor.  An anchor hash
   with one occurrence only (by least and greatest occurrence, summed in the
   tasks first) holds no repeated string and is done.
2. The other runs, as byte pieces; equal pieces of an anchor are counted
   instead of kept, and repeat as a whole.  Anchors whose pieces differ, or
   repeat something within, go on.
3. A shard's pieces form one suffix array, by Larsson-Sadakane refinement
   (doubling ranks, only groups that are not yet told apart are sorted again);
   Kasai's common prefixes, one lane a piece, tell the starts whose ``length``
   bytes occur twice.  An anchor with more than MAX_PIECES pieces is split over
   several shards; their sorted strings are then merged across shards by binary
   search, by ranges of the strings' hashes.
4. The starts become byte spans of the texts.

A text that occurs twice or more, of ``length`` bytes or more, is a repeat as a
whole; only one copy of it takes part in step 2 from a task.

Defined results: a null text is empty; texts shorter than ``length`` lose
nothing; rows with equal ids are texts of their own, and equal texts are each
other's repeats.  Kept bytes can be cut inside a character, so they are binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MULT, MULT_INV, Bloom, build_bloom, chunks, mix64, n_shards, powers, save, tidy, tidy_group

LENGTH, GRAM = 200, 48
MAX_PIECES = 20_000
#: Starts of one anchor in one hash range of its merge.
RANGE_STARTS = 1 << 18
SEGMENT = 2 << 20
#: Starts of one run at most; a run of one anchor place has LENGTH - GRAM + 1, a periodic text's goes on.
MAX_RUN = 4096
SPANS = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position."""
    n = len(data) - size + 1
    acc = np.empty(len(data) + 1, np.uint64)
    acc[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), MULT), out=acc[1:])
    return mix64((acc[size:] - acc[:n]) * powers(n, MULT_INV))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``: suffix minima of one block, prefix minima of the next."""
    n = len(x) - width + 1
    pad = -len(x) % width
    y = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(y, axis=1).ravel()
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchor_runs(column: pa.Array, length: int):
    """For pieces of the texts: (row, anchor hash, first start, number of starts, bytes of the text, its offset
    there, does the anchor's place move within the run).  A run goes on while the anchor's hash stays, so a
    periodic text makes few runs; one whose anchor moves can hold a string twice.

    Long texts are taken in overlapping segments, so that positions fit the low
    24 bits of the packed minima; ties go to the leftmost gram in either case."""
    for lo, _, data, offs in chunks(column, SEGMENT):
        for begin in range(0, max(1, len(data) - length + 1), SEGMENT):
            part = data[begin:begin + SEGMENT + length - 1]
            if len(part) < length:
                continue
            h = grams(part, GRAM)
            packed = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
            anchor = (sliding_least(packed, length - GRAM + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
            start = np.arange(len(anchor))
            row = np.searchsorted(offs, begin + start, side="right") - 1
            inside = begin + start + length <= offs[row + 1]
            cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])]))
            key, keep = h[anchor[cut]], inside[cut]
            cut = cut[np.concatenate([[True], (key[1:] != key[:-1]) | ~keep[1:] | ~keep[:-1]])]
            size = np.diff(np.append(cut, len(anchor)))
            first, size = cut[inside[cut]], size[inside[cut]]
            if len(size) and size.max() > MAX_RUN:
                n = -(-size // MAX_RUN)
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                first, size = np.repeat(first, n) + nth * MAX_RUN, np.minimum(np.repeat(size, n) - nth * MAX_RUN, MAX_RUN)
            moves = anchor[first] != anchor[first + size - 1]
            yield lo + row[first], h[anchor[first]], begin + first - offs[row[first]], size, part, first, moves


def text_keys(column: pa.Array) -> list[str]:
    out = []
    for lo, hi, data, offs in chunks(column):
        raw = data.tobytes()
        out += [hashlib.sha256(raw[offs[i]:offs[i + 1]]).hexdigest()[:32] for i in range(hi - lo)]
    return out


def anchor_occurrences(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(anchor, occ): a hash of the text and place of each run's first start.  Equal
    texts have equal occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.array([int(k[:16], 16) for k in text_keys(b.column(0))], np.uint64)
            for row, anchor, start, _, _, _, moves in anchor_runs(b.column(0), length):
                occ = mix64(keys[row] + mix64(start.astype(np.uint64) + np.uint64(1)))
                anchor, occ = np.append(anchor, anchor[moves]), np.append(occ, ~occ[moves])  # counts as two places
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(occ.view(np.int64))], names=["anchor", "occ"])

    return docs.select(text_col).mapInArrow(tidy(run), "anchor long, occ long")


def anchor_pieces(docs: DataFrame, text_col: str, length: int, screen: Bloom) -> DataFrame:
    """(anchor, t, start, n, moves, piece) of the screened runs, a text once from a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[str] = set()
        for b in batches:
            keys = text_keys(b.column(0))
            new = np.zeros(len(keys), bool)
            for i, k in enumerate(keys):
                if k not in met:
                    met.add(k)
                    new[i] = True
            for row, anchor, start, size, part, at, moves in anchor_runs(b.column(0), length):
                ok = np.flatnonzero(new[row] & screen.has(anchor))
                raw = part.tobytes()
                pieces = [raw[i:i + n + length - 1] for i, n in zip(at[ok].tolist(), size[ok].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[ok].view(np.int64)), pa.array([keys[i] for i in row[ok].tolist()], pa.string()),
                     pa.array(start[ok]), pa.array(size[ok]), pa.array(moves[ok]), pa.array(pieces, pa.binary())],
                    names=["anchor", "t", "start", "n", "moves", "piece"])

    return docs.select(text_col).mapInArrow(tidy(run), "anchor long, t string, start long, n long, moves boolean, piece binary")


# ---------------------------------------------------------------- suffix arrays
def suffix_array(text: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in order, rank of each position): all suffixes by their first
    ``reach`` symbols or more.  Larsson-Sadakane: after a round suffixes are told
    apart by twice as many symbols, and only groups of equals are sorted again."""
    n = len(text)
    h = 7
    key = np.zeros(n, np.uint64)
    for i in range(h):  # the first symbols (0 to 256, in 9 bits) as one number
        key <<= np.uint64(9)
        key[:n - i] |= text[i:].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    # a rank is the place of its group's first member, so ranks never need renumbering
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order] = group
    rank[n] = -1
    while h < reach:
        same = np.concatenate([~new[1:], [False]]) | ~new  # places in groups of two or more
        at = np.flatnonzero(same)
        if not len(at):
            break
        where = order[at]
        second = rank[np.minimum(where + h, n)]
        sub = np.lexsort((second, group[at]))
        order[at] = where = where[sub]
        second = second[sub]
        g = group[at]
        differs = np.concatenate([[True], (g[1:] != g[:-1]) | (second[1:] != second[:-1])])
        new[at] = differs
        group[at] = np.maximum.accumulate(np.where(differs, at, 0))
        rank[where] = group[at]
        h *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(text: np.ndarray, order: np.ndarray, place: np.ndarray, begins: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """Kasai: for each position the symbols (``most`` at most) in common with the
    suffix before it in order.  Lane i walks from begins[i] to ends[i].  A step keeps all but one
    of the symbols that the position before had in common, if the suffix it had them with, moved on
    by one, still comes before (among suffixes equal in ``reach`` symbols the order is open)."""
    n = len(text)
    lcp = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(most + 1, text.dtype)])
    pos = begins.copy()
    have = np.zeros(len(begins), np.int64)
    with_ = np.full(len(begins), n)
    while len(pos):
        before = np.where(place[pos] > 0, order[place[pos] - 1], n)
        moved = np.minimum(with_ + 1, n - 1)
        have = np.where((with_ + 1 < n) & (place[moved] < place[pos]), np.maximum(have - 1, 0), 0)
        todo = np.flatnonzero((before < n) & (have < most))
        while len(todo):
            p, q = pos[todo] + have[todo], before[todo] + have[todo]
            ok = (p < n) & (q < n)
            ok &= padded[np.minimum(p, n)] == padded[np.minimum(q, n)]
            todo = todo[ok]
            have[todo] += 1
            todo = todo[have[todo] < most]
        have[before >= n] = 0
        lcp[pos] = have
        pos = pos + 1
        on = pos < ends
        pos, have, ends, with_ = pos[on], have[on], ends[on], before[on]
    return lcp


def repeated_starts(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece begins, flag of each position): does the position's ``length``-byte string occur elsewhere in the pieces?"""
    sizes = np.array([len(p) for p in pieces], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int16) + 1
    text[begins + sizes] = 0  # separators sort first and end every comparison that counts
    order, place = suffix_array(text, length)
    lcp = common_prefixes(text, order, place, begins, begins + sizes - length + 1, length)
    # a separator inside the first bytes would end the match: starts have ``length`` bytes left in their piece
    start = np.zeros(len(text) + 1, np.int64)
    np.add.at(start, begins, 1)
    np.add.at(start, begins + sizes - length + 1, -1)
    is_start = np.cumsum(start)[:-1] > 0
    hit = (lcp >= length) & is_start
    flag = hit.copy()
    flag[order[place[np.flatnonzero(hit)] - 1]] = True
    return begins, flag & is_start


def runs_of(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flag, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def solve_shard(length: int, export: bool):
    """(shard, anchor, salt, piece_key, piece) to (anchor, piece_key, salt, firsts, lasts[, strings]).

    ``firsts``/``lasts``: ranges of repeated starts; ``strings``: for split anchors the hash of each start's string."""

    def run(table: pa.Table) -> pa.Table:
        pieces = table.column("piece").to_pylist()
        begins, flag = repeated_starts(pieces, length)
        firsts, lasts, strings = [], [], []
        for begin, piece in zip(begins.tolist(), pieces):
            a, z = runs_of(flag[begin:begin + len(piece) - length + 1])
            firsts.append(a)
            lasts.append(z)
            strings.append(grams(np.frombuffer(piece, np.uint8), length).view(np.int64) if export else None)
        wide = pa.list_(pa.int64())
        return pa.table({"anchor": table.column("anchor"), "piece_key": table.column("piece_key"), "salt": table.column("salt"),
                         "firsts": pa.array(firsts, wide), "lasts": pa.array(lasts, wide), "strings": pa.array(strings, wide)})

    return run


SOLVED = "anchor long, piece_key long, salt int, firsts array<bigint>, lasts array<bigint>, strings array<bigint>"


def merge_shards(table: pa.Table) -> pa.Table:
    """(anchor, range, salt, strings): strings of one hash range by shard, to those in
    two shards or more, found by binary search of each shard's in the others' sorted ones."""
    anchor = table.column("anchor")[0].as_py()
    by: dict[int, list] = {}
    for salt, s in zip(table.column("salt").to_pylist(), table.column("strings").to_pylist()):
        by.setdefault(salt, []).append(np.array(s, np.int64))
    sorted_of = {salt: np.unique(np.concatenate(v)) for salt, v in by.items()}
    found = []
    salts = sorted(sorted_of)
    merged = np.zeros(0, np.int64)
    for salt in salts:
        mine = sorted_of[salt]
        if len(merged):
            at = np.minimum(np.searchsorted(merged, mine), len(merged) - 1)
            found.append(mine[merged[at] == mine])
        merged = np.union1d(merged, mine)
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pa.table({"anchor": pa.array(np.full(len(both), anchor)), "string": pa.array(both)})


def hash_ranges(starts: Column) -> Column:
    """Number of hash ranges of a split anchor with so many starts: about RANGE_STARTS starts a range."""
    return F.greatest(F.lit(64).cast("long"), F.ceil(starts / RANGE_STARTS))


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, max_pieces: int = MAX_PIECES) -> DataFrame:
    """(t, spans): by text key the byte ranges (start, end), not merged, of its repeated strings."""
    occ = anchor_occurrences(docs, text_col, length)
    live = save(occ.groupBy("anchor").agg(F.min("occ").alias("a"), F.max("occ").alias("b")).where("a <> b").select("anchor"), "repeat-anchors")
    pieces = save(anchor_pieces(docs, text_col, length, build_bloom(live, "anchor"))
                  .join(live, "anchor", "left_semi").withColumn("piece_key", F.xxhash64("piece")), "repeat-pieces")
    places = pieces.select("anchor", "piece_key", "t", "start", "n", "moves").distinct()
    counts = (places.groupBy("anchor", "piece_key").agg(F.count("*").alias("copies"), F.first("n").alias("n"), F.first("moves").alias("moves")))
    kinds = save(counts, "repeat-kinds")
    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("starts"), F.max("moves").alias("moves"))
    per_anchor = per_anchor.where("kinds > 1 or moves").select("anchor", "kinds", "starts")
    per_anchor = save(per_anchor, "repeat-mixed")
    salt = F.when(F.col("kinds") > max_pieces, F.pmod(F.col("piece_key"), F.ceil(F.col("kinds") / max_pieces))).otherwise(F.lit(0))
    mixed = (pieces.join(per_anchor, "anchor").groupBy("anchor", "piece_key")
             .agg(F.first("piece").alias("piece"), F.first(salt.cast("int")).alias("salt"), F.first(F.col("kinds") > max_pieces).alias("split")))
    size = per_anchor.agg((F.sum("starts") + length * F.sum("kinds"))).first()[0] or 0
    shards = n_shards(size, 3 << 20, 16)
    dealt = mixed.withColumn("shard", F.pmod(F.xxhash64("anchor", "salt"), F.lit(shards)))
    solve, solve_split = tidy_group(solve_shard(length, False)), tidy_group(solve_shard(length, True))
    cols = ["shard", "anchor", "salt", "piece_key", "piece"]
    solved = save(dealt.where("not split").select(*cols).groupBy("shard").applyInArrow(solve, SOLVED), "repeat-solved")
    found = solved.select("anchor", "piece_key", F.explode(F.arrays_zip("firsts", "lasts")).alias("r")).select(
        "anchor", "piece_key", F.col("r.firsts").alias("first"), F.col("r.lasts").alias("last"))
    if per_anchor.where(F.col("kinds") > max_pieces).limit(1).count():
        split = save(dealt.where("split").select(*cols).groupBy("anchor", "salt").applyInArrow(solve_split, SOLVED), "repeat-split")
        own = split.select("anchor", "piece_key", F.explode(F.arrays_zip("firsts", "lasts")).alias("r")).select(
            "anchor", "piece_key", F.col("r.firsts").alias("first"), F.col("r.lasts").alias("last"))
        # one row for each max_pieces texts at most
        hot = per_anchor.where(F.col("kinds") > max_pieces).select("anchor", hash_ranges(F.col("starts")).alias("ranges"))
        strings = split.select("anchor", "piece_key", "salt", F.posexplode("strings").alias("place", "string"))
        packed = (strings.select("anchor", "salt", "string").distinct()
                  .join(F.broadcast(hot), "anchor")
                  .groupBy("anchor", "salt", F.pmod("string", F.col("ranges")).alias("range")).agg(F.collect_list("string").alias("strings")))
        both = packed.groupBy("anchor", "range").applyInArrow(merge_shards, "anchor long, string long")
        across = strings.join(both, ["anchor", "string"]).select(
            "anchor", "piece_key", F.col("place").cast("long").alias("first"), (F.col("place") + 1).cast("long").alias("last"))
        found = found.union(own).union(across)
    whole = kinds.where("copies > 1").select("anchor", "piece_key", F.lit(0).cast("long").alias("first"), F.col("n").alias("last"))
    ranges = found.join(whole.select("anchor", "piece_key"), ["anchor", "piece_key"], "left_anti").union(whole)
    hit = places.join(ranges, ["anchor", "piece_key"]).select(
        "t", (F.col("start") + F.col("first")).alias("s"), (F.col("start") + F.col("last") - 1 + length).alias("e"))
    return hit.groupBy("t").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", length: int = LENGTH,
                   max_pieces: int = MAX_PIECES) -> DataFrame:
    """``keep``, ``n_bytes``, ``removed`` (merged byte ranges) and ``kept`` (the bytes left) for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = save(repeated_spans(docs, text_col, length, max_pieces), "repeat-spans")
    keyed = docs.select(*keep, text.alias("text_"), F.substring(F.sha2(text, 256), 1, 32).alias("t"))
    copies = keyed.groupBy("t").agg(F.count("*").alias("copies")).where("copies > 1")
    known = spans.join(copies, "t", "full_outer").select(F.col("t").alias("t_"), "spans", "copies")
    schema = docs.select(*keep).schema.add("n_bytes", "long").add("removed", SPANS).add("kept", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, gone, kept = [], [], []
            for text, spans, copies in zip(b.column("text_"), b.column("spans"), b.column("copies")):
                raw = text.as_py().encode("utf-8")
                if copies.as_py() and len(raw) >= length:
                    merged = [(0, len(raw))]
                elif spans.as_py():
                    merged = []
                    for s, e in sorted((x["s"], x["e"]) for x in spans.as_py()):
                        if merged and s <= merged[-1][1]:
                            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
                        else:
                            merged.append((s, e))
                else:
                    merged = []
                sizes.append(len(raw))
                gone.append([{"s": s, "e": e} for s, e in merged])
                ends = [0, *[e for _, e in merged]]
                kept.append(b"".join(raw[a:z] for a, z in zip(ends, [*[s for s, _ in merged], len(raw)])))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(sizes, pa.int64()),
                 pa.array(gone, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array(kept, pa.binary())],
                names=[*keep, "n_bytes", "removed", "kept"])

    joined = keyed.join(known, keyed["t"] == known["t_"], "left").select(*keep, "text_", "spans", "copies")
    return joined.mapInArrow(tidy(run), schema)


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    rows = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "n_bytes",
                       F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"]).alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
