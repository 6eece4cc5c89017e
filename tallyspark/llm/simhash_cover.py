"""Operator 11: SimHash near-duplicates by anchor-point covering.

A fingerprint has one bit for each of 64 bits of its shingles' hashes: 1 where
more than half of them (repeats count) have it.  Fingerprints link at a Hamming
distance of ``THRESHOLD`` (2) or less.

Anchors are the words of a covering code of 64 bits: two binary Golay codes of
23 bits (covering radius 3 each), a Hamming code of 15 bits (radius 1) and three
free bits (radius 0).  All three are perfect, so a fingerprint's nearest anchor
is found by syndromes, and the covering radius of the whole is 7.  A fingerprint
goes to the anchor of every point within one bit of itself, about 20 anchors, all
of them within the covering radius plus the threshold.  No link is lost: two fingerprints at
distance 2 or less have a point within one bit of both, and that point's anchor
gets both.

Fingerprints are compared within an anchor only.  Equal fingerprints were made
one before, so an anchor's group holds different ones.  A group of more than
``MAX_GROUP`` is not compared: its fingerprints go to the anchors of the code of
all points (covering radius 0), where a group can't hold more than 65 and all
members are linked through the anchor.  A task gives back a spanning forest of
the links it finds, not the pairs; components are joined by star rounds over
tables in the shared folder.

Defined results: a null or wordless text has fingerprint zero, linked like any
other; a text of fewer words than a shingle has its whole sequence as the one
shingle; every row, repeated ids too, gets its own fingerprint; a null id never
names a component unless all of its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_shards, save, tidy
from .jaccard_join import components

SHINGLE = 3
SEED = 42
THRESHOLD = 2
MAX_GROUP = 256
#: Text of one document is taken so many bytes at a time.
PART_BYTES = 1 << 20
#: A fingerprint held by more than this part of all rows is joined by broadcast: there are at most as many of them.
HOT_PART = 1000

# fixed values: generator polynomials of the Golay code (23 bits) and of the Hamming code (15 bits)
GOLAY, HAMMING = 0b101011100011, 0b10011


# ---------------------------------------------------------------- fingerprints
def parts(raw: bytes, size: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, part by part: a word is never cut."""
    at = 0
    while at < len(raw):
        end = at + size
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        yield raw[at:end].split()
        at = end


def bit_counts(raw: bytes, k: int = SHINGLE) -> tuple[np.ndarray, int]:
    """(how many shingle hashes have each of the 64 bits, number of shingles)."""
    ones, total, carry, n_words = np.zeros(64, np.int64), 0, [], 0
    for words in parts(raw.lower()):
        n_words += len(words)
        words = carry + words
        carry = words[max(0, len(words) - k + 1):]
        if len(words) < k:
            continue
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        end = np.cumsum(size) - 1
        line = b" ".join(words)
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip((end - size + 1)[:len(words) - k + 1].tolist(), end[k - 1:].tolist())]
        h = np.array(hashes, "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
    if 0 < n_words < k:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], "<u8")
        return np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    return ones, total


def fingerprint(raw: bytes, k: int = SHINGLE) -> int:
    ones, total = bit_counts(raw, k)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(id, fp): one row for each row of ``docs``; fp is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            fp = np.array([fingerprint(t.as_buffer().to_pybytes(), k) if t.is_valid else 0 for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"id {kind}, fp long")


# ---------------------------------------------------------------- the covering code
class PerfectCode:
    """A perfect cyclic code of ``length`` bits that corrects ``radius`` errors."""

    def __init__(self, length: int, generator: int, radius: int):
        self.length = length
        check = generator.bit_length() - 1
        unit = []  # syndrome of each single bit: the remainder of x**i
        r = 1
        for _ in range(length):
            unit.append(r)
            r <<= 1
            if r >> check:
                r ^= generator
        # syndromes of each byte of the word, and the error that each syndrome stands for
        self.by_byte = np.zeros(((length + 7) // 8, 256), np.uint64)
        for i, u in enumerate(unit):
            has = (np.arange(256) >> (i % 8)) & 1 == 1
            self.by_byte[i // 8, has] ^= np.uint64(u)
        self.error = np.zeros(1 << check, np.uint64)
        for n in range(1, radius + 1):
            for bits in itertools.combinations(range(length), n):
                syndrome = 0
                for i in bits:
                    syndrome ^= unit[i]
                self.error[syndrome] = sum(1 << i for i in bits)

    def nearest(self, words: np.ndarray) -> np.ndarray:
        """The code word nearest to each word."""
        s = np.zeros(words.shape, np.uint64)
        for i, table in enumerate(self.by_byte):
            s ^= table[((words >> np.uint64(8 * i)) & np.uint64(255)).astype(np.int64)]
        return words ^ self.error[s.astype(np.int64)]


def blocks() -> list[tuple[int, PerfectCode]]:
    """(first bit, code) of the blocks; bits 61 to 63 are free."""
    golay = PerfectCode(23, GOLAY, 3)
    return [(0, golay), (23, golay), (46, PerfectCode(15, HAMMING, 1))]


def anchors(fp: np.ndarray, code: list[tuple[int, PerfectCode]]) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor) for the different anchors of all points within one bit of each fingerprint."""
    home, cols = fp & np.uint64(7 << 61), []
    near = []
    for first, c in code:
        word = (fp >> np.uint64(first)) & np.uint64((1 << c.length) - 1)
        home = home | (c.nearest(word) << np.uint64(first))
        flips = np.uint64(1) << np.arange(c.length, dtype=np.uint64)
        near.append((first, c.length, c.nearest(word[:, None] ^ flips) << np.uint64(first)))
    for first, length, words in near:
        rest = home & ~np.uint64(((1 << length) - 1) << first)
        cols.append(rest[:, None] | words)
    free = np.uint64(1) << np.arange(61, 64, dtype=np.uint64)
    every = np.sort(np.concatenate([home[:, None], *cols, home[:, None] ^ free], axis=1), axis=1)
    new = np.ones(every.shape, bool)
    new[:, 1:] = every[:, 1:] != every[:, :-1]
    of, _ = np.nonzero(new)
    return of, every[new]


def points(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the code of all points: each fingerprint and its 64 neighbours."""
    every = np.concatenate([fp[:, None], fp[:, None] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))], axis=1)
    return np.repeat(np.arange(len(fp)), 65), every.ravel()


def replicate(fps: DataFrame, fine: bool) -> DataFrame:
    """(anchor, fp) for each anchor that a fingerprint goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = blocks()
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(fp), 8192):
                part = fp[lo:lo + 8192]
                of, at = points(part) if fine else anchors(part, code)
                yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array(part[of].view(np.int64))], names=["anchor", "fp"])

    return fps.select("fp").mapInArrow(tidy(run), "anchor long, fp long")


# ---------------------------------------------------------------- links
def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining each a with its b; a label is the least member's index."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        la, lb = la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def forest(anchor: np.ndarray, fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): edges that connect what links within the groups connect; rows come sorted by anchor."""
    members, node = np.unique(fp, return_inverse=True)
    label = np.arange(len(members))
    at, step = np.arange(len(anchor)), 1
    while len(at):
        at = at[at + step < len(anchor)]
        at = at[anchor[at] == anchor[at + step]]  # rows whose group goes on that far
        a, b = node[at], node[at + step]
        ask = label[a] != label[b]
        a, b = a[ask], b[ask]
        link = np.bitwise_count(members[a] ^ members[b]) <= threshold
        label = merge(label, a[link], b[link])
        step += 1
    other = np.flatnonzero(label != np.arange(len(members)))
    return members[label[other]], members[other]


def links(groups: DataFrame, shards: int, threshold: int) -> DataFrame:
    """Edges (a1, a2, b1, b2) between linked fingerprints; (anchor, fp) rows are spread by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def give(rows: np.ndarray):
            a, b = forest(rows[0], rows[1].view(np.uint64), threshold)
            z = pa.array(np.zeros(len(a), np.int64))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), z, pa.array(b.view(np.int64)), z], names=["a1", "a2", "b1", "b2"])

        size = 0
        for batch in batches:
            held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
            size += batch.num_rows
            if size >= 200_000:
                rows = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(rows[0], rows[0, -1]))  # the last anchor may go on
                if cut:
                    yield give(rows[:, :cut])
                held, size = [rows[:, cut:]], rows.shape[1] - cut
        if size:
            yield give(np.concatenate(held, axis=1))

    return (groups.repartition(shards, "anchor").sortWithinPartitions("anchor")
            .mapInArrow(tidy(run), "a1 long, a2 long, b1 long, b2 long"))


def link_fingerprints(fps: DataFrame, threshold: int = THRESHOLD, max_group: int = MAX_GROUP) -> DataFrame:
    """(fp, root) for each of the different fingerprints ``fps`` that is linked with another one."""
    if threshold not in (1, 2):
        raise ValueError("a point within one bit of both ends exists for thresholds 1 and 2")
    rows = replicate(fps, False)
    shards = n_shards(fps.count() * 20, 1_000_000)
    size = save(rows.groupBy("anchor").agg(F.count("*").alias("c")).where(F.col("c") > max_group).select("anchor"), "simhash-heavy")
    if size.limit(1).count():
        heavy = save(rows.join(size, "anchor").select("fp").distinct(), "simhash-crowded")
        fine = links(replicate(heavy, True), n_shards(heavy.count() * 65, 1_000_000), threshold)
        edges = links(rows.join(size, "anchor", "left_anti"), shards, threshold).union(fine)
    else:
        edges = links(rows, shards, threshold)
    found = components(edges)
    return found.select(F.col("s1").alias("fp"), F.col("c1").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    threshold: int = THRESHOLD, max_group: int = MAX_GROUP) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of ``docs``."""
    rows = save(fingerprints(docs, id_col, text_col, k), "simhash-rows")
    same = save(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("c")), "simhash-classes")
    total = same.agg(F.sum("c")).first()[0] or 0
    found = link_fingerprints(same, threshold, max_group)
    named = same.join(found, "fp", "left").select("fp", "least", "c", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = save(named.join(least, "root").select("fp", "component", "c"), "simhash-components")
    often = F.col("c") > total // HOT_PART
    # at most HOT_PART fingerprints are held by more than that part of the rows
    hot = named.where(often).select("fp", F.col("component").alias("hot"), F.lit(True).alias("is_hot"))
    told = rows.join(F.broadcast(hot), "fp", "left")
    rest = told.where("is_hot is null").select("id", "fp").join(named.where(~often).select("fp", "component"), "fp")
    every = told.where("is_hot").select("id", "fp", F.col("hot").alias("component")).union(rest.select("id", "fp", "component"))
    return every.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op11_simhash_cover(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
