"""Helpers shared by the operators: shared scratch tables, vectorised word and
hash arithmetic over Arrow text columns, and Bloom filters of fixed size.

Text arrives in the tasks as Arrow columns.  ``chunks`` cuts a column into runs
of whole documents of a few MB, so that numpy work has bounded memory (a single
longer text is a run of its own).  Words are found and hashed on the UTF-8
bytes without a Python loop: a word's hash is a polynomial over its bytes
modulo 2**64, taken from one cumulative sum.  Two different words share such a
hash with a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
import hashlib
import os
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20
#: Spark removes the shuffle files of a query when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: An odd multiplier and its inverse modulo 2**64.
MULT = 0x9E3779B97F4A7C15
MULT_INV = pow(MULT, -1, 1 << 64)


# ---------------------------------------------------------------- scratch
def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.
    Where it is unset, a local master gets a folder below the warehouse; on a
    cluster an unset folder is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "tallyspark-scratch")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the result is
    computed once and outlives any executor.  The shuffle files behind it go
    when it is written: nothing reads them again."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved(df: DataFrame) -> None:
    """Delete the files of a frame made by ``save`` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    for f in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0


def n_shards(total: int, per_shard: int, least: int = 8) -> int:
    return max(least, -(-int(total) // int(per_shard)))


# ---------------------------------------------------------------- kept results
class Kept:
    """Results of recent calls, at most 2 * ``size``: when the younger half is
    full the older half is let go."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        got = self.young.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def get_all(self, keys: list) -> list:
        """``get`` of each key."""
        out = list(map(self.young.get, keys))
        if self.old or None in out:
            out = [self.get(k) if x is None else x for k, x in zip(keys, out)]
        return out

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def of_process(name: str, make):
    """An object that a Python worker keeps from task to task."""
    all_kept = sys.__dict__.setdefault("_tallyspark_kept", {})
    if name not in all_kept:
        all_kept[name] = make()
    return all_kept[name]


def give_back() -> None:
    """Return freed memory to the system; the allocators would hold it for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(run):
    """A function for ``mapInArrow`` that gives memory back when its task ends."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def tidy_group(run):
    """The same for ``applyInArrow`` on one table, after each group."""

    def tidied(table: pa.Table) -> pa.Table:
        out = run(table)
        give_back()
        return out

    return tidied


# ---------------------------------------------------------------- bytes
def byte_table(low: bool, word_bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte after lower-casing A-Z if ``low``, is it part of a word)."""
    fold = np.arange(256, dtype=np.uint8)
    if low:
        fold[65:91] += 32
    is_word = np.zeros(256, dtype=bool)
    is_word[list(word_bytes)] = True
    return fold, is_word


#: Words are runs of anything but ASCII white space / of letters, digits and non-ASCII.
SPACE_WORD = [b for b in range(256) if b not in (32, 9, 10, 11, 12, 13)]
ALNUM_WORD = [b for b in range(256) if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of whole texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict = {}


def powers(n: int, mult: int) -> np.ndarray:
    """mult**0 .. mult**(n-1) modulo 2**64, kept in the task for reuse."""
    have = _POWERS.get(mult)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), mult, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[mult] = have
    return have[:n]


def find_words(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
    """(starts, ends) of all words and, per text, the range of its words."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    w = is_word[data]
    prev = np.empty_like(w)
    prev[0] = False
    prev[1:] = w[:-1]
    inner = offs[:-1][offs[:-1] < len(data)]
    prev[inner] = False
    starts = np.flatnonzero(w & ~prev)
    nxt = np.empty_like(w)
    nxt[-1] = False
    nxt[:-1] = w[1:]
    nxt[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(w & ~nxt) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes anywhere."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    acc = np.empty(len(data) + 1, np.uint64)
    acc[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), MULT), out=acc[1:])
    h = (acc[ends] - acc[starts]) * powers(len(data) + 1, MULT_INV)[starts]
    return mix64(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; len(words) - k + 1 values."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h + words[i:i + n]) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    return mix64(h)


def doc_shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash) of every k-word shingle; a text of fewer
    words, but not none, has its whole sequence as the one shingle."""
    n = np.diff(bounds)
    full = shingle_hashes(words, k)
    doc = np.repeat(np.arange(len(n)), n)
    left = np.repeat(bounds[1:], n) - np.arange(len(words))  # words from here to the text's end
    at = np.flatnonzero(left >= k)
    d, h = doc[at], full[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for m in range(1, k):
            which = n[short] == m
            first = bounds[:-1][short[which]]
            x = np.full(which.sum(), m, np.uint64)
            for i in range(m):
                x = mix64((x + words[first + i]) * np.uint64(0x9FB21C651E98DF25))
            extra[which] = x
        d, h = np.concatenate([d, short]), np.concatenate([h, extra])
    return d, h


def text_key(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's SHA-256 as two signed 64-bit numbers; null is empty."""
    n = len(column)
    out = np.empty((n, 2), np.int64)
    for lo, hi, data, offs in chunks(column):
        raw = memoryview(np.ascontiguousarray(data))
        for i in range(hi - lo):
            out[lo + i] = np.frombuffer(hashlib.sha256(raw[offs[i]:offs[i + 1]]).digest()[:16], np.int64)
    return out[:, 0], out[:, 1]


# ---------------------------------------------------------------- Bloom filters
def bloom_slots(keys: np.ndarray, log2_bits: int, probes: int) -> np.ndarray:
    """Bit numbers of each key: all within one run of 2**16 bits, chosen by the key's top bits."""
    k = mix64(keys.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    block = (k >> np.uint64(64 - (log2_bits - 16))) << np.uint64(16) if log2_bits > 16 else np.zeros_like(k)
    out = np.empty((probes, len(k)), np.uint64)
    a, b = k & np.uint64(0xFFFF), (k >> np.uint64(16)) & np.uint64(0xFFFF) | np.uint64(1)
    for i in range(probes):
        out[i] = block | (a + b * np.uint64(i) & np.uint64(0xFFFF))
    return out


def bloom_add(bits: np.ndarray, slots: np.ndarray) -> None:
    s = slots.ravel()
    np.bitwise_or.at(bits, (s >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (s & np.uint64(7)).astype(np.uint8)))


def bloom_has(bits: np.ndarray, keys: np.ndarray, log2_bits: int, probes: int) -> np.ndarray:
    ok = np.ones(len(keys), bool)
    if not len(keys):
        return ok
    for s in bloom_slots(keys, log2_bits, probes):
        ok &= (bits[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


class Bloom:
    """A broadcast Bloom filter of ``2**log2_bits`` bits, whatever the number of
    keys: a fuller one passes more strangers on to the exact join behind it."""

    def __init__(self, handle, log2_bits: int, probes: int):
        self.handle, self.log2_bits, self.probes = handle, log2_bits, probes

    def has(self, keys: np.ndarray) -> np.ndarray:
        return bloom_has(np.frombuffer(self.handle.value, np.uint8), keys, self.log2_bits, self.probes)


def build_bloom(keys: DataFrame, column: str, log2_bits: int = 26, probes: int = 3) -> Bloom:
    """Filter over a bigint column; nulls are left out.  Each sixteenth of the
    bits is filled by one task; the driver joins them, 2**(log2_bits - 3) bytes in all."""
    pieces, piece_bits = 16, (1 << log2_bits) // 16

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = bloom_slots(k, log2_bits, 1)[0] // np.uint64(piece_bits)
            yield pa.RecordBatch.from_pydict({"piece": pa.array(at.astype(np.int32)), "k": pa.array(k.view(np.int64))})

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for b in batches:
            piece = b.column(0).to_numpy()
            k = b.column(1).to_numpy().view(np.uint64)
            for p in np.unique(piece).tolist():
                mine = bits.setdefault(p, np.zeros(piece_bits // 8, np.uint8))
                bloom_add(mine, bloom_slots(k[piece == p], log2_bits, probes) - np.uint64(p * piece_bits))
        for p, mine in bits.items():
            yield pa.RecordBatch.from_pydict({"piece": pa.array([p], pa.int32()), "bits": pa.array([mine.tobytes()], pa.binary())})

    made = (keys.select(F.col(column).cast("long").alias("k")).where("k is not null")
            .mapInArrow(route, "piece int, k long")
            .repartition(pieces, "piece").mapInArrow(fill, "piece int, bits binary").collect())
    empty = bytes(piece_bits // 8)
    by = {r["piece"]: bytes(r["bits"]) for r in made}
    return Bloom(keys.sparkSession.sparkContext.broadcast(b"".join(by.get(p, empty) for p in range(pieces))), log2_bits, probes)
