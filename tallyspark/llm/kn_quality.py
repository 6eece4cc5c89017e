"""Operator 9: quality classifier by an interpolated modified Kneser-Ney model.

The model is over words (runs of letters, digits and non-ASCII bytes; runs of
other marks are words too), pairs interpolated with single words.  Below the
single words stands a Kneser-Ney model over runs of ``ORDER`` character classes,
which spells a word: new words are dear by their characters, not all alike.  It
learns from all trusted texts (rows labelled 1) but one in HELD, by a hash of the id.

Documents are dealt into blocks by their id and kept packed.  Counts of word pairs
go to shards by a hash of the pair, and the shards' sums for each word to shards
by the word.  A block asks the shards for its distinct pairs and words and gets
their counts back packed, so no count table is ever in one place; only the
table of CLASSES ** ORDER character runs, about 10 MB whatever the corpus, is in
every task.

A document's perplexity by byte, as if PRIOR_BYTES of usual text stood beside it,
is compared with its language's threshold: the ``QUANTILE`` of the perplexities
of the trusted texts that were not learned from in that language, raised by
``MARGIN``; languages with fewer than ``MIN_TRUSTED`` of them use that of all.

Defined results: a null or empty text has null perplexity and is kept (nothing
speaks against it); without trusted texts there is no threshold and everything
is kept; repeated rows are scored each; a document with several labels is
trusted only if all are 1; null languages are a language.  Where no trusted text
is held out, those learned from give the threshold.  Words are told apart by 40
bits of a hash, pairs by 32 bits and their shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (ALNUM_WORD, SPACE_WORD, byte_table, chunks, drop_saved, find_words, give_back, hash_spans, mix64, n_shards, save, text_bytes, tidy,
                     tidy_group)

ORDER = 4
#: Fixed classes of ASCII characters, each one class; other bytes follow below.
LETTERS = b"abcdefghijklmnopqrstuvwxyz"
CLASSES = 40
QUANTILE, MARGIN, MIN_TRUSTED = 0.99, 1.06, 100
#: So many bytes of usual perplexity are added to every text: short texts vary by chance.
PRIOR_BYTES = 120
#: One trusted text in so many is not learned from; those give the thresholds.
HELD = 4
IS_WORD = byte_table(False, ALNUM_WORD)[1]
IS_MARK = byte_table(False, SPACE_WORD)[1] & ~IS_WORD
BEGIN = np.uint64(0xA0761D6478)
#: The blocks ask in so many turns, each a fixed share of them: all of a turn's asks and answers are on disk at once.
SLICES = 4
#: A block's words are scored so many at a time, whole texts each.
RUN_WORDS = 1 << 17
STAGE_SCHEMA = "kind string, shard int, block int, keys binary, counts binary"


def class_table() -> np.ndarray:
    """Class of every byte; class 0 stands before a text."""
    of = np.full(256, 39, np.uint8)
    for i, c in enumerate(LETTERS):
        of[c] = 1 + i
    of[65:91] = 27
    of[48:58] = 28
    of[[32, 9]] = 29
    of[[10, 13]] = 30
    of[ord(".")], of[ord(",")], of[ord("!")], of[ord("|")] = 31, 32, 33, 34
    of[[ord(c) for c in "#*$%&<>"]] = 35
    of[0xC2:0xC4] = 36   # lead bytes of Latin letters
    of[0x80:0xC0] = 37   # continuation bytes
    of[0xC4:] = 38       # lead bytes of other scripts
    return of


CLASS_OF = class_table()


def run_codes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of the run that ends at each byte, text index of each byte)."""
    c = CLASS_OF[data].astype(np.int64)
    n = np.diff(offs)
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(c)) - np.repeat(offs[:-1], n)
    code = c.copy()
    for back in range(1, ORDER):
        before = np.zeros_like(c)
        before[back:] = c[:-back]
        before[place < back] = 0
        code += before * CLASSES ** back
    return code, doc


def count_runs(packs: DataFrame) -> DataFrame:
    """(code, n) over the texts learned from, summed in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** ORDER, np.int64)
        for b in batches:
            for _, pack in unpacked(b):
                for _, _, data, offs in chunks(pack.filter(pc.equal(pack.column("state_"), 1)).column("text_")):
                    total += np.bincount(run_codes(data, offs)[0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])

    return packs.mapInArrow(tidy(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2, 3 and more, from how many n-grams have counts 1 to 4."""
    n1, n2, n3, n4 = (max(1, int(n)) for n in (n1, n2, n3, n4))
    y = n1 / (n1 + 2 * n2)
    d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, 0, [0, 1, 2, 3])


def probabilities(counts: np.ndarray) -> np.ndarray:
    """log10 of the interpolated probability of each run's last class, for all runs.

    ``counts`` has one axis for each place of a run.  Lower orders count the
    distinct classes seen before a run instead of its occurrences.
    """
    order = counts.ndim
    levels = [counts.astype(np.float64)]
    for _ in range(order - 1):
        seen = levels[0] > 0
        levels.insert(0, seen.sum(axis=0).astype(np.float64))
    p = np.full(counts.shape[-1], 1.0 / (counts.shape[-1] - 1))
    p[0] = 0  # nothing is followed by "before a text"
    for c in levels:
        d = discounts(*((c == k).sum() for k in (1, 2, 3, 4)))
        cut = d[np.minimum(c, 3).astype(np.int64)]
        total = c.sum(axis=-1, keepdims=True)
        freed = cut.sum(axis=-1, keepdims=True)
        known = total > 0
        weight = np.where(known, freed / np.where(known, total, 1), 1.0)
        p = np.where(known, (c - cut) / np.where(known, total, 1), 0.0) + weight * p
    return np.log10(np.maximum(p, 1e-12)).astype(np.float32)


def train(packs: DataFrame) -> np.ndarray:
    """The table of log10 probabilities, indexed by run code."""
    counts = np.zeros(CLASSES ** ORDER, np.int64)
    rows = count_runs(packs).toArrow()  # at most CLASSES ** ORDER rows
    counts[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return probabilities(counts.reshape((CLASSES,) * ORDER)).ravel()


# ---------------------------------------------------------------- words
def words_of(column: pa.Array, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(40-bit hashes of all words, each one's predecessor, log10 probability of its spelling, the texts' bounds)."""
    hashes, spelled, sizes = [], [], []
    for _, _, data, offs in chunks(column):
        spans = [find_words(data, offs, kind) for kind in (IS_WORD, IS_MARK)]
        starts, ends = (np.concatenate([x[i] for x in spans]) for i in (0, 1))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        hashes.append(hash_spans(data, starts, ends) >> np.uint64(24))
        sizes.append(sum(np.diff(x[2]) for x in spans))
        if table is not None:
            total = np.concatenate([[0.0], np.cumsum(table[run_codes(data, offs)[0]], dtype=np.float64)])
            after = np.minimum(ends + 1, offs[np.searchsorted(offs, ends)]) if len(ends) else ends  # the byte that ends the word, within its text
            spelled.append(total[after] - total[starts])
    words = np.concatenate([np.zeros(0, np.uint64), *hashes])
    bounds = np.cumsum(np.concatenate([[0], *sizes])).astype(np.int64)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = BEGIN
    return words, before, np.concatenate([np.zeros(0), *spelled]), bounds


def pair_hash(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix64(before * np.uint64(0x9E6C63D0876A9A47) + words)


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values, rising: by sorting, faster here than ``np.unique``."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def five(x: np.ndarray) -> bytes:
    """40-bit numbers, five bytes each, the bytes of one place together."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()


def from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(5, -1).T
    return out.view("<u8").ravel()


def steps(x: np.ndarray) -> bytes:
    """Rising 32-bit numbers as their differences, the bytes of one place together."""
    return np.diff(x, prepend=np.uint64(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint64)


def small(counts: np.ndarray) -> bytes:
    """Counts (one at least), each in as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def from_small(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64)


def by_shard(keys: np.ndarray, shard_bits: int) -> list[tuple[int, int, int]]:
    """(shard, from, to) of rising 64-bit keys, only of shards that have keys."""
    if not len(keys):
        return []
    top = keys >> np.uint64(64 - shard_bits)
    edge = np.concatenate([[0], np.flatnonzero(top[1:] != top[:-1]) + 1, [len(keys)]]).tolist()
    return list(zip(top[edge[:-1]].tolist(), edge[:-1], edge[1:]))


def sparse(counts: np.ndarray) -> bytes:
    """Counts of which many are 0: how many, a bit for each that isn't, those as bytes, and those of 255 and more again whole."""
    has = counts > 0
    some = counts[has]
    return (len(counts).to_bytes(4, "little") + np.packbits(has).tobytes() + np.minimum(some, 255).astype(np.uint8).tobytes()
            + some[some >= 255].astype("<u8").tobytes())


def from_sparse(data: bytes) -> tuple[np.ndarray, int]:
    """(the counts, how many bytes they took)."""
    n = int.from_bytes(data[:4], "little")
    end = 4 + -(-n // 8)
    has = np.unpackbits(np.frombuffer(data[4:end], np.uint8), count=n).astype(bool)
    some = np.frombuffer(data[end:end + int(has.sum())], np.uint8).astype(np.int64)
    end += len(some)
    big = some == 255
    last = end + 8 * int(big.sum())
    some[big] = np.frombuffer(data[end:last], "<u8").astype(np.int64)
    out = np.zeros(n, np.int64)
    out[has] = some
    return out, last


def stage_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    cols = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["kind", "shard", "block", "keys", "counts"])


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
    """(block, its rows) of each pack."""
    for block, data in zip(batch.column(0), batch.column(1)):
        yield block.as_py(), pa.ipc.open_stream(data.as_buffer()).read_all()


def pack_block(docs: pa.Table, trusted: pa.Table) -> pa.Table:
    """A block's documents as one value; ``state_`` is 1 for those learned from, 2 for trusted ones held out."""
    if not docs.num_rows:
        return pa.table({"block": pa.array([], pa.int32()), "pack": pa.array([], pa.binary())})
    at = pc.index_in(docs.column("id_"), value_set=trusted.column("id_").combine_chunks())
    state = pc.fill_null(pc.take(trusted.column("state_").combine_chunks(), at.combine_chunks()), 0)
    rows = docs.drop_columns(["id_", "block"]).append_column("state_", state)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_table(rows)
    return pa.table({"block": pa.array([docs.column("block")[0].as_py()], pa.int32()), "pack": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def learn(shard_bits: int, turn: int):
    """Each block's distinct word pairs of the texts learned from, with counts, packed by the pair's shard: the even or the odd shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, pack in unpacked(b):
                words, before, _, _ = words_of(pack.filter(pc.equal(pack.column("state_"), 1)).column("text_"))
                pairs, first, n = np.unique(pair_hash(before, words), return_index=True, return_counts=True)
                yield stage_batch([("learn", s, block, five(before[first[i:j]]) + five(words[first[i:j]]), small(n[i:j]))
                                   for s, i, j in by_shard(pairs, shard_bits) if s % 2 == turn])

    return run


def sum_pairs(shard_bits: int):
    """A shard's pairs with their counts, and what they add to their words: 'context' has the
    occurrences and the numbers of followers seen once, twice and more, 'follower' the number of predecessors."""

    def run(table: pa.Table) -> pa.Table:
        shard, keys, counts = table.column("shard")[0].as_py(), table.column("keys").to_pylist(), table.column("counts").to_pylist()
        before, words = (np.concatenate([from_five(k[i * len(k) // 2:(i + 1) * len(k) // 2]) for k in keys]) for i in (0, 1))
        n = np.concatenate([from_small(c, len(k) // 10) for k, c in zip(keys, counts)])
        pairs, first, at = np.unique(pair_hash(before, words), return_index=True, return_inverse=True)
        n = np.bincount(at, weights=n).astype(np.int64)
        low, where = np.unique(pairs & np.uint64(0xFFFFFFFF), return_inverse=True)
        rows = [("pair", shard, -1, steps(low), small(np.bincount(where, weights=n).astype(np.int64))),
                ("pair sizes", shard, -1, None, np.bincount(np.minimum(n, 5), minlength=6).astype(np.int64).tobytes())]
        for kind, words_in in (("context", before[first]), ("follower", words[first])):
            ids, at = np.unique(words_in, return_inverse=True)
            if kind == "context":
                adds = np.array([np.bincount(at, weights=x) for x in (n, n == 1, n == 2, n > 2)])
            else:
                adds = np.bincount(at)[None]
            order = np.argsort(mix64(ids))
            ids, adds = ids[order], adds.astype(np.int64)[:, order]
            rows += [(kind, s, -1, five(ids[i:j]), adds[:, i:j].astype("<u4").tobytes()) for s, i, j in by_shard(mix64(ids), shard_bits)]
        return pa.Table.from_batches([stage_batch(rows)])

    return run


def sum_words(table: pa.Table) -> pa.Table:
    """A shard's words: numbers of predecessors, occurrences as a context, and of followers seen once, twice and more."""
    shard, kind = table.column("shard")[0].as_py(), table.column("kind").to_pylist()
    ids = [from_five(k) for k in table.column("keys").to_pylist()]
    adds = [np.frombuffer(c, "<u4").reshape(-1, len(k)) for c, k in zip(table.column("counts").to_pylist(), ids)]
    words, at = np.unique(np.concatenate(ids), return_inverse=True)
    edge, total = np.cumsum([0, *map(len, ids)]), np.zeros((5, len(words)), np.int64)
    for i, k in enumerate(kind):
        place = at[edge[i]:edge[i + 1]]
        total[0 if k == "follower" else slice(1, 5), place] += adds[i][0] if k == "follower" else adds[i]  # a row's words are distinct
    sizes = np.bincount(np.minimum(total[0], 5), minlength=6).astype(np.int64)
    return pa.Table.from_batches([stage_batch([("word", shard, -1, five(words), total.tobytes()), ("word sizes", shard, -1, None, sizes.tobytes())])])


def ask(shard_bits: int):
    """Each block's distinct pairs and words, packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, pack in unpacked(b):
                words, before, _, _ = words_of(pack.column("text_"))
                pairs = distinct(pair_hash(before, words))
                rows = [("ask pair", s, block, steps(distinct(pairs[i:j] & np.uint64(0xFFFFFFFF))), None) for s, i, j in by_shard(pairs, shard_bits)]
                ids = distinct(np.append(words, BEGIN))
                ids = ids[np.argsort(mix64(ids))]
                yield stage_batch(rows + [("ask word", s, block, five(ids[i:j]), None) for s, i, j in by_shard(mix64(ids), shard_bits)])

    return run


def tidy_pair(run):
    """A function for cogrouped ``applyInArrow`` that gives memory back after each group."""

    def tidied(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        give_back()
        return out

    return tidied


def found(keys: np.ndarray, asked: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values (last axis by ``keys``, rising) of the asked keys, 0 for those not there."""
    if not len(keys):
        return np.zeros((*values.shape[:-1], len(asked)), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[..., at], 0)


def answer(asks: pa.Table, tables: pa.Table) -> pa.Table:
    """The counts that the blocks asked a shard for, in the asked order."""
    have = {r["kind"]: r for r in tables.to_pylist()}
    pairs = from_steps(have["pair"]["keys"]) if "pair" in have else np.zeros(0, np.uint64)
    n = from_small(have["pair"]["counts"], len(pairs)) if "pair" in have else np.zeros(0, np.int64)
    words = from_five(have["word"]["keys"]) if "word" in have else np.zeros(0, np.uint64)
    sums = np.frombuffer(have["word"]["counts"], np.int64).reshape(5, -1) if "word" in have else np.zeros((5, 0), np.int64)
    rows = []
    for kind, shard, block, keys in zip(*(asks.column(c).to_pylist() for c in ("kind", "shard", "block", "keys"))):
        if kind == "ask pair":
            asked = from_steps(keys)
            rows.append(("pair", shard, block, None, sparse(found(pairs, asked, n))))
        else:
            rows.append(("word", shard, block, None, b"".join(sparse(x) for x in found(words, from_five(keys), sums))))
    return pa.Table.from_batches([stage_batch(rows)])


def score_block(handle, shard_bits: int, pair_sizes: np.ndarray, word_sizes: np.ndarray, n_pairs: int, keep: list[str]):
    """Log10 probabilities of a block's texts from the counts that it asked for."""
    cut2, cut1 = discounts(*pair_sizes[1:5]), discounts(*word_sizes[1:5])
    freed1 = float(cut1[1] * word_sizes[1] + cut1[2] * word_sizes[2] + cut1[3] * word_sizes[3:].sum())

    def run(packs: pa.Table, answers: pa.Table) -> pa.Table:
        pack = pa.ipc.open_stream(packs.column("pack")[0].as_buffer()).read_all()
        where = {(k, s): i for i, (k, s) in enumerate(zip(*(answers.column(c).to_pylist() for c in ("kind", "shard"))))}
        counts = answers.column("counts")

        def got(kind: str, shard: int) -> bytes:  # one shard's answer at a time
            return counts[where[kind, shard]].as_py()

        words, before, spelled, bounds = words_of(pack.column("text_"), np.frombuffer(handle.value, np.float32))
        keys, at = np.unique(pair_hash(before, words), return_inverse=True)
        c = np.zeros(len(keys), np.int64)
        for s, i, j in by_shard(keys, shard_bits):
            low = keys[i:j] & np.uint64(0xFFFFFFFF)
            asked = distinct(low)
            mine, _ = from_sparse(got("pair", s))
            if len(mine) != len(asked):
                raise ValueError("a block's pairs and counts don't match")
            c[i:j] = mine[np.searchsorted(asked, low)]
        del keys
        c = c[at]
        del at
        ids = distinct(np.append(words, BEGIN))
        order, sums = np.argsort(mix64(ids)), np.zeros((5, len(ids)), np.int64)
        for s, i, j in by_shard(mix64(ids[order]), shard_bits):
            data = got("word", s)
            for k in range(5):
                mine, used = from_sparse(data)
                sums[k, order[i:j]], data = mine, data[used:]
        logs = np.zeros(len(bounds))
        # in runs of texts: what a run needs beside its words is given back before the next
        cuts = np.unique(np.append(np.searchsorted(bounds, np.arange(0, len(words) + 1, RUN_WORDS)), len(bounds) - 1))
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            lo, hi = int(bounds[first]), int(bounds[last])
            n = sums[0][np.searchsorted(ids, words[lo:hi])]
            total, once, twice, more = sums[1:, np.searchsorted(ids, before[lo:hi])]
            p, mine = 10.0 ** np.maximum(spelled[lo:hi], -200), c[lo:hi]
            if n_pairs:
                p = (n - cut1[np.minimum(n, 3)] + freed1 * p) / n_pairs
                whole = np.maximum(total, 1)
                p = np.where(total > 0, (np.maximum(mine - cut2[np.minimum(mine, 3)], 0) + (cut2[1] * once + cut2[2] * twice + cut2[3] * more) * p) / whole, p)
            logs[first + 1:last + 1] = np.add.accumulate(np.concatenate([[0.0], np.log10(p)]))[bounds[first + 1:last + 1] - lo]
            logs[first + 1:last + 1] -= np.concatenate([[0.0], logs[first + 1:last]]) if last > first + 1 else 0.0
        size = pc.fill_null(pc.binary_length(pack.column("text_")), 0).cast(pa.int64())
        return pa.Table.from_arrays([*[pack.column(k) for k in keep], pa.array(logs[1:]), size, pack.column("state_")],
                                    names=[*keep, "log_prob", "n_bytes", "state_"])

    return run


def with_log_prob(docs: DataFrame, trusted: DataFrame, keep: list[str], id_col: str, text_col: str, block_bytes: int = 4 << 20) -> DataFrame:
    """``keep``, ``log_prob`` (log10 of the text's probability), ``n_bytes`` and ``state_`` of all documents."""
    size = text_bytes(docs, text_col)
    blocks = n_shards(size, block_bytes, 8)
    shard_bits = max(4, (max(1, size // (16 << 20)) - 1).bit_length())

    def block_of(key):
        return F.pmod(key, F.lit(blocks)).cast("int").alias("block")

    kind = docs.schema[id_col].dataType
    held = F.when(F.pmod(F.xxhash64("trusted_id"), F.lit(1 << 20)) < (1 << 20) // HELD, 2).otherwise(1).cast("int").alias("state_")
    marked = trusted.select(F.col("trusted_id").cast(kind).alias("id_"), held, block_of(F.xxhash64(F.col("trusted_id").cast(kind))))
    dealt = docs.select(*keep, F.col(text_col).alias("text_"), F.col(id_col).alias("id_"),
                        block_of(F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(id_col))))

    def half(df: DataFrame, i: int):
        return df.where(F.col("block") % 2 == i).groupBy("block")

    # half of the blocks at a time: the texts in the exchange take disk beside their packs
    shares = [save(half(dealt, i).cogroup(half(marked, i)).applyInArrow(pack_block, "block int, pack binary"), "kn-packs") for i in range(2)]
    packs = reduce(DataFrame.union, shares)
    handle = docs.sparkSession.sparkContext.broadcast(train(packs).tobytes())  # CLASSES ** ORDER * 4 bytes
    # half of the shards at a time, for the same reason
    summed = [save(packs.mapInArrow(tidy(learn(shard_bits, i)), STAGE_SCHEMA).groupBy("shard")
                   .applyInArrow(tidy_group(sum_pairs(shard_bits)), STAGE_SCHEMA), "kn-pairs") for i in range(2)]
    pairs = reduce(DataFrame.union, summed)
    words = save(pairs.where("kind in ('context', 'follower')").groupBy("shard").applyInArrow(tidy_group(sum_words), STAGE_SCHEMA), "kn-words")

    def sizes(of: DataFrame, kind: str) -> np.ndarray:  # six numbers a shard
        return sum((np.frombuffer(r["counts"], np.int64) for r in of.where(F.col("kind") == kind).select("counts").collect()), np.zeros(6, np.int64))

    pair_sizes, word_sizes = sizes(pairs, "pair sizes"), sizes(words, "word sizes")
    tables = save(pairs.where("kind = 'pair'").union(words.where("kind = 'word'")), "kn-tables")
    for table in (*summed, words):
        drop_saved(table)
    schema = docs.select(*keep).schema.add("log_prob", "double").add("n_bytes", "long").add("state_", "integer")
    score = tidy_pair(score_block(handle, shard_bits, pair_sizes, word_sizes, int(pair_sizes.sum()), keep))
    parts = []
    for i in range(SLICES):  # each share of the blocks in turn, so that what they ask for takes less disk
        mine = packs.where(F.col("block") % SLICES == i)
        answers = save(mine.mapInArrow(tidy(ask(shard_bits)), STAGE_SCHEMA).groupBy("shard").cogroup(tables.groupBy("shard"))
                       .applyInArrow(tidy_pair(answer), STAGE_SCHEMA), "kn-answers")
        parts.append(save(mine.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema), "kn-scores"))
        drop_saved(answers)
    for table in (tables, *shares):
        drop_saved(table)
    return reduce(DataFrame.union, parts)


def classify(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang"), id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``keep``, ``perplexity``, ``threshold`` and ``kept`` for every document.

    ``labels`` has the id column and ``quality`` (1: trusted)."""
    keep = list(dict.fromkeys([*keep, id_col, lang_col]))
    trusted = (labels.groupBy(F.col(id_col).alias("trusted_id")).agg(F.min("quality").alias("q"))
               .where("q = 1 and trusted_id is not null").select("trusted_id"))
    logs = with_log_prob(docs, trusted, keep, id_col, text_col)
    of_state = {r["state_"]: r for r in logs.where("n_bytes > 0").groupBy("state_").agg(F.sum("log_prob").alias("s"), F.sum("n_bytes").alias("n")).collect()}
    state = 2 if 2 in of_state else 1
    usual = of_state[state]["s"] / of_state[state]["n"] if state in of_state else 0.0
    per_byte = (F.col("log_prob") + F.lit(PRIOR_BYTES * usual)) / (F.col("n_bytes") + PRIOR_BYTES)
    scored = logs.select(*keep, "state_", F.when(F.col("n_bytes") > 0, F.pow(F.lit(10.0), -per_byte)).alias("perplexity"))
    known = scored.where(F.col("state_") == state).where("perplexity is not null").select(F.col(lang_col).alias("l"), "perplexity")
    of_lang = (known.groupBy("l").agg(F.percentile_approx("perplexity", QUANTILE, 10_000).alias("q"), F.count("*").alias("n"))
               .where(F.col("n") >= MIN_TRUSTED).select("l", "q"))
    of_all = known.agg(F.percentile_approx("perplexity", QUANTILE, 10_000).alias("q")).first()["q"]
    threshold = F.coalesce("q", F.lit(of_all).cast("double")) * MARGIN
    return (scored.join(of_lang, scored[lang_col].eqNullSafe(of_lang["l"]), "left")
            .select(*keep, "perplexity", threshold.alias("threshold"),
                    F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, ...) that are kept, unchanged."""
    rows = docs.withColumn("text_hash_", F.xxhash64("text", "lang"))
    bad = (classify(rows, labels, keep=("doc_id", "lang", "text_hash_")).where("not kept")
           .select(F.col("doc_id").alias("bad_id"), F.col("text_hash_").alias("bad_hash")).distinct())
    return rows.join(bad, rows["doc_id"].eqNullSafe(bad["bad_id"]) & (rows["text_hash_"] == bad["bad_hash"]), "left_anti").drop("text_hash_")


def op9_kn_quality(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "perplexity", "threshold", "kept")
