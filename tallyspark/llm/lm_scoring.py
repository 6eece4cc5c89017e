"""Operator 5: language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs of all training texts are quantised to levels
(powers of two) and stored in a Bloom filter: an n-gram of level q is entered
as (n-gram, 1) ... (n-gram, q), and read back by probing 1, 2, ... until a miss.
Words and pairs have level 1 + floor(log2 c), so those seen once are entered
too.  The filter is made in segments, each by one task from the
n-grams of one hash range, with BITS_PER_ENTRY bits for each entry at every size
of the input: it errs alike everywhere (it overstates some counts).  A segment
stays in its task and is probed there, so the filter is never in one place and
has no bound for all.

The score is log10 of  prod over tokens of  MIX * c2 / c1 + (1 - MIX) * P1,
with c2 / c1 the pair's share among its first word's occurrences and P1 the
smoothed share of the word, all from levels.

The base score needs exact counts.  Texts are dealt into blocks by a hash; a
block asks the count shards for its distinct words and word pairs and gets the
words' counts and the levels of both back, packed, so the vocabulary is never in
one place and a block's need is bounded by the block.

Defined results: a null or empty text is the end token alone; a null id counts
as the empty text for the fold; repeated rows are scored each; without training
texts all counts are 0.  Words and pairs are told apart by 64-bit hashes (pairs
by 32 bits and their shard).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (SPACE_WORD, byte_table, chunks, find_words, hash_spans, mix64, n_shards, save, text_bytes)

FOLD, IS_WORD = byte_table(True, SPACE_WORD)
END, BEGIN = np.uint64(0x51ED270B9F3A8C15), np.uint64(0xA0761D6478BD642F)
MIX = 0.2
PROBES = 4
BITS_PER_ENTRY = 10
STAGE_SCHEMA = "kind string, shard int, block int, keys binary, counts binary, a double, b double"


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, each text's end token included; the texts' bounds)."""
    hashes, sizes = [], []
    for _, _, data, offs in chunks(column):
        low = FOLD[data]
        starts, ends, bounds = find_words(low, offs, IS_WORD)
        n = np.diff(bounds)
        out = np.full(len(starts) + len(n), END, np.uint64)
        out[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = hash_spans(low, starts, ends)
        hashes.append(out)
        sizes.append(n + 1)
    if not sizes:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def pair_keys(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Key of each token with the one before it, BEGIN before a text's first."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = BEGIN
    return mix64(before * np.uint64(0x9E6C63D0876A9A47) + tokens)


def _row(out: dict, kind, shard, block, keys=None, counts=None, a=None, b=None) -> None:
    for k, v in zip(out, (kind, shard, block, keys, counts, a, b)):
        out[k].append(v)


def _table(out: dict) -> pa.Table:
    kinds = dict(kind=pa.string(), shard=pa.int32(), block=pa.int32(), keys=pa.binary(), counts=pa.binary(), a=pa.float64(), b=pa.float64())
    return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})


def _new() -> dict:
    return {k: [] for k in ("kind", "shard", "block", "keys", "counts", "a", "b")}


def pack(counts: np.ndarray) -> bytes:
    """Counts (one at least), each in as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64)


def count_block(shard_bits: int):
    """A block's distinct words and pairs with their training counts, packed by shard."""

    def run(table: pa.Table) -> pa.Table:
        out = _new()
        block = table.column("block")[0].as_py()
        train = table.column("train").to_numpy()
        tokens, bounds = tokens_of(table.column("text"))
        used = np.repeat(train, np.diff(bounds))
        words, at = np.unique(tokens, return_inverse=True)
        counts = np.bincount(at, weights=used, minlength=len(words)).astype(np.uint32)
        shard = (words >> np.uint64(64 - shard_bits)).astype(np.int64)
        edge = np.searchsorted(shard, np.arange((1 << shard_bits) + 1))
        for s in range(1 << shard_bits):
            lo, hi = edge[s], edge[s + 1]
            if hi > lo:
                _row(out, "word", s, block, words[lo:hi].tobytes(), pack(counts[lo:hi]))
        pairs, at = np.unique(pair_keys(tokens, bounds) >> np.uint64(32 - shard_bits), return_inverse=True)  # shard, then 32 bits
        n = np.bincount(at, weights=used, minlength=len(pairs)).astype(np.uint32)
        edge = np.searchsorted(pairs, np.arange((1 << shard_bits) + 1, dtype=np.uint64) << np.uint64(32))
        low = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        for s in range(1 << shard_bits):
            lo, hi = edge[s], edge[s + 1]
            if hi > lo:
                _row(out, "pair", s, block, low[lo:hi].tobytes(), pack(n[lo:hi]))
        _row(out, "begin", 0, block, a=float(train.sum()))
        return _table(out)

    return run


def entry_hash(ids: np.ndarray, level: int) -> np.ndarray:
    return mix64(ids + np.uint64(level * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))


class Segment:
    """The filter of one shard's n-grams, with room for ``entries`` entries."""

    def __init__(self, entries: int):
        self.flags = np.zeros(max(64, entries * BITS_PER_ENTRY), bool)

    def slots(self, ids: np.ndarray, level: int, probe: int) -> np.ndarray:
        h = entry_hash(ids, level)
        a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        return ((a + np.uint64(probe) * b) % np.uint64(len(self.flags))).astype(np.int64)

    def add(self, ids: np.ndarray, level: np.ndarray) -> None:
        for k in range(1, int(level.max(initial=0)) + 1):
            for i in range(PROBES):
                self.flags[self.slots(ids[level >= k], k, i)] = True

    def read(self, ids: np.ndarray) -> np.ndarray:
        level, at = np.zeros(len(ids), np.uint8), np.arange(len(ids))
        for k in range(1, 64):
            for i in range(PROBES):
                at = at[self.flags[self.slots(ids[at], k, i)]]
            if not len(at):
                break
            level[at] = k
        return level


def log2_floor(c: np.ndarray) -> np.ndarray:
    return np.frexp(c.astype(np.float64))[1] - 1


def level_of(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, 1 + log2_floor(np.maximum(c, 1)), 0)


def count_of(level: np.ndarray) -> np.ndarray:
    """What a level stands for: 0, 1, then the middle of a power of two."""
    return np.where(level > 1, 1.4 * 2.0 ** np.maximum(level.astype(np.int64) - 1, 0), level)


def gather(keys: list, counts: list, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, their total counts, each asked key's place among them, bounds of the asks)."""
    asks = [np.frombuffer(k, kind) for k in keys]
    have = [unpack(c, len(k)) for c, k in zip(counts, asks)]
    ids, back = np.unique(np.concatenate([np.zeros(0, kind), *asks]), return_inverse=True)
    total = np.bincount(back, weights=np.concatenate([np.zeros(0, np.int64), *have]), minlength=len(ids)).astype(np.int64)
    return ids, total, back, np.cumsum([0, *map(len, asks)])


def count_shard(table: pa.Table) -> pa.Table:
    """A shard's word counts and the levels its filter segment gives, sent back to the blocks that asked, and totals."""
    out = _new()
    kind = np.array(table.column("kind").to_pylist())
    shard = table.column("shard")[0].as_py()
    keys, counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()
    blocks = table.column("block").to_pylist()
    begin = [table.column("a")[int(i)].as_py() for i in np.flatnonzero(kind == "begin")]
    if begin:
        _row(out, "begin", shard, -1, a=sum(begin))
    of_word, of_pair = np.flatnonzero(kind == "word").tolist(), np.flatnonzero(kind == "pair").tolist()
    words, total, word_at, word_edge = gather([keys[i] for i in of_word], [counts[i] for i in of_word], np.uint64)
    low, many, pair_at, pair_edge = gather([keys[i] for i in of_pair], [counts[i] for i in of_pair], np.uint32)
    pairs = mix64((np.uint64(shard) << np.uint64(32)) | low.astype(np.uint64))
    word_levels, pair_levels = level_of(total), level_of(many)
    _row(out, "words", shard, -1, a=float(total.sum()), b=float((total > 0).sum()))
    _row(out, "mass", shard, -1, a=float(count_of(word_levels).sum()))
    segment = Segment(int(word_levels.sum() + pair_levels.sum()))
    segment.add(words, word_levels)
    segment.add(pairs, pair_levels)
    read = segment.read(words)
    for j, i in enumerate(of_word):
        at = word_at[word_edge[j]:word_edge[j + 1]]
        _row(out, "need", shard, blocks[i], read[at].tobytes(), pack(total[at]))
    read = segment.read(pairs)
    for j, i in enumerate(of_pair):
        _row(out, "need pair", shard, blocks[i], read[pair_at[pair_edge[j]:pair_edge[j + 1]]].tobytes())
    return _table(out)


def score_block(shard_bits: int, n: float, v: float, mass: float, texts: float, names: list[str]):
    """Scores of a block's texts, given the exact counts of its words and the levels of its words and pairs."""

    def run(docs: pa.Table, needs: pa.Table) -> pa.Table:
        tokens, bounds = tokens_of(docs.column("text"))
        words, at = np.unique(tokens, return_inverse=True)
        kind, shard = np.array(needs.column("kind").to_pylist()), needs.column("shard").to_numpy()
        packed, counts = needs.column("keys").to_pylist(), needs.column("counts").to_pylist()
        order = np.argsort(shard, kind="stable")
        of_word, of_pair = order[kind[order] == "need"].tolist(), order[kind[order] == "need pair"].tolist()
        word_levels, pair_levels = (np.frombuffer(b"".join(packed[i] for i in which), np.uint8) for which in (of_word, of_pair))
        exact = np.concatenate([np.zeros(0, np.int64), *[unpack(counts[i], len(packed[i])) for i in of_word]])
        pairs, pat = np.unique(pair_keys(tokens, bounds) >> np.uint64(32 - shard_bits), return_inverse=True)
        if len(exact) != len(words) or len(pair_levels) != len(pairs):
            raise ValueError("a block's words and counts don't match")
        first = bounds[:-1]

        def per_text(x):
            return np.add.reduceat(x, first) if len(first) else x

        base = per_text(np.log10((exact + 0.1) / (n + 0.1 * (v + 1)))[at])
        known = per_text((exact > 0).astype(np.int64)[at])
        c1 = count_of(word_levels)
        p1 = ((c1 + 0.1) / (mass + 0.1 * (v + 1)))[at]
        c2 = count_of(pair_levels)[pat]
        before = np.empty(len(tokens))
        before[1:] = c1[at][:-1]
        before[first] = texts
        share = np.where(c2 > 0, np.minimum(1.0, c2 / np.maximum(before, np.maximum(c2, 1.0))), 0.0)
        score = per_text(np.log10(MIX * share + (1 - MIX) * p1))
        cols = [docs.column(c) for c in names]
        return pa.Table.from_arrays(
            [*cols, pa.array(np.diff(bounds)), pa.array(known), pa.array(np.full(len(first), int(n))), pa.array(base), pa.array(score)],
            names=[*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, block_bytes: int = 12 << 20) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) for every text.
    Texts whose crc32(id as text) mod ``folds`` is not 0 are learned from."""
    size = text_bytes(docs, text_col)
    blocks = n_shards(size, block_bytes, 8)
    shard_bits = max(4, (max(1, size // (12 << 20)) - 1).bit_length())  # about two million words a shard
    held = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0
    dealt = docs.select(F.col(id_col), F.col(text_col).alias("text"), held.alias("held_out"),
                        F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int").alias("block"))
    counted = (dealt.select("block", (~F.col("held_out")).alias("train"), "text").groupBy("block")
               .applyInArrow(count_block(shard_bits), STAGE_SCHEMA))
    stage = save(counted.groupBy("shard").applyInArrow(count_shard, STAGE_SCHEMA), "lm-stage")
    total = {r["kind"]: r for r in stage.where("block = -1").groupBy("kind").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()}
    n, v = (total["words"]["a"], total["words"]["b"]) if total else (0.0, 0.0)
    kind = docs.schema[id_col].dataType.simpleString()
    scored = (dealt.groupBy("block").cogroup(stage.where("block >= 0").select("block", "kind", "shard", "keys", "counts").groupBy("block"))
              .applyInArrow(score_block(shard_bits, n, v, total["mass"]["a"] if total else 0.0,
                                        total["begin"]["a"] if total else 0.0, [id_col, "held_out"]),
                            f"{id_col} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    return scored


def op5_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
