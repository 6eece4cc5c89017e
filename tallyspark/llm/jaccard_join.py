"""Operator 6: exact n-gram Jaccard join with set-relation skipping.

A document's set is its distinct k-word shingles.  Equal sets are one class.
Classes are joined by prefix filtering: under one global order of the shingles,
two sets with similarity t share one of the first n - ceil(t n) + 1 shingles of
each.  The order is by rarity: the number of texts that hold a shingle, counted
over all documents.  Texts are packed in blocks; a block asks shards (by a hash
of the shingle) for the counts of its shingles and gets them back, zeros left
out, so no table of counts is ever in one place and the order is as sharp at any
size.  A shingle of a single text makes no list.  What is skipped, without losing
a link between components:

* equal sets: answered once for their class;
* prefix shingles of a single class: no list;
* lists with the members of another list: answered once for that member set;
* lists that tie MAX_FAMILY classes or fewer together: answered as one list, so
  that a set is read once;
* within a list, sorted by length, all entries outside the run of lengths that
  can reach the threshold, found by binary search (one block skip at either end),
  and those whose place in the set rules it out;
* the search for a set that is much like the one answered before: its overlaps
  with all sets of the list are that one's, less and plus the holders of the
  shingles in which the two differ;
* entries whose bitmap (the parity of the set's shingles in BITMAP slots) differs
  from every other's in more bits than two similar sets can differ in shingles;
* pairs that the answers found so far already connect: a list is searched
  outwards from one set, and a set that is reached is not compared again.

Lists of more than MAX_LIST classes are cut into blocks by a hash, solved one
block a task; blocks of one list that hold several components afterwards are
then compared two at a time, the pairs of blocks spread over the tasks.

Shingles are compared by 64-bit hashes, classes by 128 bits; a count is that of
the texts whose shingle shares the shard and 32 more bits of the hash.

Defined results: null texts and texts without words have the empty set and link
with nothing; a text with fewer words than k has its whole sequence as the one
shingle; repeated rows (same id) belong to the component of any of their texts;
null ids never name a component: a component of null ids only has a null id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (SPACE_WORD, Bloom, build_bloom, byte_table, chunks, doc_shingles, drop_saved, find_words, hash_spans, n_shards, save,
                     text_bytes, tidy, tidy_group)
from .kn_quality import by_shard, distinct, from_small, from_sparse, from_steps, small, sparse, steps, tidy_pair

FOLD, IS_WORD = byte_table(True, SPACE_WORD)
#: Text of a block / of a shard's share of the shingles.
PACK_BYTES, SHARD_BYTES = 4 << 20, 24 << 20
MAX_LIST = 4096
BITMAP = 512
MAX_FAMILY = 1024


def shingle_sets(column: pa.Array, k: int):
    """For each text: its row and the sorted distinct shingle hashes (empty sets left out)."""
    for lo, hi, data, offs in chunks(column):
        low = FOLD[data]
        starts, ends, bounds = find_words(low, offs, IS_WORD)
        doc, h = doc_shingles(hash_spans(low, starts, ends), bounds, k)
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        if not len(h):
            continue
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
        doc, h = doc[new], h[new]
        rows, first = np.unique(doc, return_index=True)
        yield lo + rows, np.append(first, len(h)), h


def set_key(h: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(hashlib.blake2b(h.tobytes(), digest_size=16).digest(), np.int64)
    return int(d[0]), int(d[1])


def document_sets(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, n, s1, s2): set size and the set's key, null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            key = np.zeros((b.num_rows, 2), np.int64)
            for rows, cut, h in shingle_sets(b.column(1), k):
                n[rows] = np.diff(cut)
                for i, r in enumerate(rows.tolist()):
                    key[r] = set_key(h[cut[i]:cut[i + 1]])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(key[:, 0], mask=n == 0), pa.array(key[:, 1], mask=n == 0)], names=["id", "n", "s1", "s2"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"id {kind}, n long, s1 long, s2 long")


ASK_SCHEMA = "shard int, block long, keys binary, counts binary"


def pack_texts(docs: DataFrame, text_col: str, k: int) -> DataFrame:
    """(block, pack): the texts with a set, each class once from a task, PACK_BYTES a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        held, size, block = [], 0, TaskContext.get().partitionId() << 32

        def give():
            table = pa.table({"t": pa.chunked_array(held)}).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
                out.write_table(table)
            return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "pack"])

        for b in batches:
            for rows, cut, h in shingle_sets(b.column(0), k):
                new = []
                for i, r in enumerate(rows.tolist()):
                    key = set_key(h[cut[i]:cut[i + 1]])
                    if key not in met:
                        met.add(key)
                        new.append(r)
                if new:
                    held.append(b.column(0).take(pa.array(new)).cast(pa.large_string()))
                    size += held[-1].nbytes
                if size >= PACK_BYTES:
                    yield give()
                    held, size, block = [], 0, block + 1
        if held:
            yield give()

    return docs.select(text_col).mapInArrow(tidy(run), "block long, pack binary")


def pack_sets(pack, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, shingles) of a pack's sets."""
    cuts, tokens, total = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)], 0
    for _, cut, h in shingle_sets(pa.ipc.open_stream(pack).read_all().column("t"), k):
        cuts.append(cut[1:] + total)
        tokens.append(h)
        total += len(h)
    return np.concatenate(cuts), np.concatenate(tokens)


def shard_keys(tokens: np.ndarray, shard_bits: int):
    """(shard, from, to, 32 bits each after the shard's) of rising tokens."""
    low = (tokens << np.uint64(shard_bits)) >> np.uint64(32)
    return [(s, i, j, low[i:j]) for s, i, j in by_shard(tokens, shard_bits)]


def ask_counts(k: int, shard_bits: int):
    """Each block's distinct shingles with the number of its texts that hold them, packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, pack in zip(b.column(0).to_pylist(), b.column(1)):
                tokens, n = np.unique(pack_sets(pack.as_buffer(), k)[1], return_counts=True)
                rows = []
                for s, i, j, low in shard_keys(tokens, shard_bits):
                    keys, at = np.unique(low, return_inverse=True)
                    rows.append((s, block, steps(keys), small(np.bincount(at, weights=n[i:j]).astype(np.int64))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["shard", "block", "keys", "counts"])

    return run


def answer_counts(asks: pa.Table) -> pa.Table:
    """For each block that asked a shard: how many other texts hold each of its shingles, in the asked order."""
    keys = [from_steps(x) for x in asks.column("keys").to_pylist()]
    n = np.concatenate([from_small(c, len(x)) for c, x in zip(asks.column("counts").to_pylist(), keys)])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    others = (np.bincount(at, weights=n).astype(np.int64) - 1)[at]
    edge = np.cumsum([0, *map(len, keys)])
    return pa.table({"shard": asks.column("shard"), "block": asks.column("block"), "keys": pa.nulls(len(keys), pa.binary()),
                     "counts": pa.array([sparse(others[i:j]) for i, j in zip(edge[:-1], edge[1:])], pa.binary())})


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def parity_bits(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """BITMAP bits for each set: bit i says whether an odd number of its shingles fall on i.
    Two sets' bitmaps differ in no more bits than the sets have shingles that are not in both."""
    slot = ((h >> np.uint64(8)) % np.uint64(BITMAP)).astype(np.int64)
    at = np.repeat(np.arange(len(cut) - 1), np.diff(cut)) * BITMAP + slot
    odd = np.bincount(at, minlength=(len(cut) - 1) * BITMAP) & 1
    return np.packbits(odd.astype(bool).reshape(-1, BITMAP), axis=1).view(np.uint64)


def screen_lists(percent: int):
    """Entries (token, s1, s2, n, pos, bits) of whole lists to those that a length, place or
    bitmap bound does not part from every other entry of the list."""

    def run(table: pa.Table) -> pa.Table:
        token, s1, s2, n, pos = (table.column(c).to_numpy() for c in ("token", "s1", "s2", "n", "pos"))
        order = np.lexsort((s2, s1, token))
        token, s1, s2, n, pos = (x[order] for x in (token, s1, s2, n, pos))
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])])
        keep = np.flatnonzero(new)
        order = order[keep]
        token, s1, s2, n, pos = (x[keep] for x in (token, s1, s2, n, pos))
        raw = table.column("bits").to_pylist()
        bits = np.frombuffer(b"".join(raw), np.uint64).reshape(len(raw), -1)[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(token)) + 1, [len(token)]])
        live = np.zeros(len(token), bool)
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            for i in range(lo, hi - 1):
                j = np.arange(i + 1, hi)
                j = j[~(live[j] & live[i])] if live[i] else j
                both = n[i] + n[j]
                need = -(-percent * both // (100 + percent))
                ok = (100 * n[j] >= percent * n[i]) & (100 * n[i] >= percent * n[j])
                ok &= np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need
                j, both, need = j[ok], both[ok], need[ok]
                if len(j):
                    differ = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
                    j = j[differ <= both - 2 * need]
                    if len(j):
                        live[i] = live[j] = True
        return pa.table({c: pa.array(x[live]) for c, x in (("token", token), ("s1", s1), ("s2", s2), ("n", n), ("pos", pos))})

    return run


def sets_of_classes(docs: DataFrame, text_col: str, k: int, screen: Bloom) -> DataFrame:
    """(s1, s2, members) of the classes that pass the screen on s1, each once from a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for b in batches:
            got = []
            for _, cut, h in shingle_sets(b.column(0), k):
                keys = [set_key(h[x:y]) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                ok = screen.has(np.array([x for x, _ in keys], np.int64).view(np.uint64))
                for i in np.flatnonzero(ok).tolist():
                    if keys[i] not in met:
                        met.add(keys[i])
                        got.append((*keys[i], h[cut[i]:cut[i + 1]].tobytes()))
            if got:
                s1, s2, raw = zip(*got)
                yield pa.RecordBatch.from_arrays([pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(raw, pa.binary())],
                                                 names=["s1", "s2", "members"])

    return docs.select(text_col).mapInArrow(tidy(run), "s1 long, s2 long, members binary")


def prefixes(k: int, percent: int, shard_bits: int):
    """(token, s1, s2, n, pos, bits) of the prefix shingles that another text holds too, from a pack and its answers."""

    def run(packs: pa.Table, answers: pa.Table) -> pa.Table:
        cut, h = pack_sets(packs.column("pack")[0].as_buffer(), k)
        tokens, at = np.unique(h, return_inverse=True)
        others = np.zeros(len(tokens), np.int64)
        where, counts = {s: i for i, s in enumerate(answers.column("shard").to_pylist())}, answers.column("counts")
        for s, i, j, low in shard_keys(tokens, shard_bits):
            others[i:j] = from_sparse(counts[where[s]].as_py())[0][np.searchsorted(distinct(low), low)]
        n = np.diff(cut)
        doc = np.repeat(np.arange(len(n)), n)
        load = others[at]
        order = np.lexsort((h, load, doc))
        pos = np.arange(len(h)) - np.repeat(cut[:-1], n)
        take = (pos < np.repeat(prefix_size(n, percent), n)) & (load[order] > 0)
        token, of, pos = h[order][take], doc[take], pos[take]
        keys = np.zeros((len(n), 2), np.int64)
        for i in np.unique(of).tolist():
            keys[i] = set_key(h[cut[i]:cut[i + 1]])
        maps = parity_bits(h, cut) if len(of) else None
        return pa.table({"token": pa.array(token.view(np.int64)), "s1": pa.array(keys[of, 0]), "s2": pa.array(keys[of, 1]), "n": pa.array(n[of]),
                         "pos": pa.array(pos.astype(np.int64)), "bits": pa.array([maps[i].tobytes() for i in of.tolist()], pa.binary())})

    return run


ENTRY_SCHEMA = "token long, s1 long, s2 long, n long, pos long, bits binary"


def list_entries(docs: DataFrame, text_col: str, k: int, percent: int) -> DataFrame:
    """The entries of all lists: prefix shingles that more than one text holds."""
    packs = save(pack_texts(docs, text_col, k), "jaccard-packs")
    # about one shingle of eight bytes for every six bytes of text
    shard_bits = max(4, (n_shards(text_bytes(docs, text_col), SHARD_BYTES, 1) - 1).bit_length())
    answers = save(packs.mapInArrow(tidy(ask_counts(k, shard_bits)), ASK_SCHEMA).groupBy("shard")
                   .applyInArrow(tidy_group(answer_counts), ASK_SCHEMA), "jaccard-counts")
    rows = save(packs.groupBy("block").cogroup(answers.groupBy("block"))
                .applyInArrow(tidy_pair(prefixes(k, percent, shard_bits)), ENTRY_SCHEMA), "jaccard-prefixes")
    drop_saved(answers)
    drop_saved(packs)
    return rows


class Solver:
    """Connects the sets of one list: breadth first, comparing only sets that no
    answer has connected yet."""

    def __init__(self, sizes: np.ndarray, places: np.ndarray, sets: list[np.ndarray], percent: int):
        """The sets come sorted by size, each rising."""
        self.n, self.pos, self.sets, self.t = sizes, places, sets, percent
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.tokens, self.holder = flat[order], np.repeat(np.arange(len(sets)), sizes)[order]
        self.last, self.overlap = -1, np.zeros(0, np.int64)
        self.skipped = self.derived = 0  # entries passed over by length / sets answered from another's answers

    def holders(self, tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each set holds."""
        lo, hi = np.searchsorted(self.tokens, tokens, side="left"), np.searchsorted(self.tokens, tokens, side="right")
        width = hi - lo
        at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(lo, width)
        return np.bincount(self.holder[at], minlength=len(self.n))

    def overlaps(self, a: int) -> np.ndarray:
        """The sizes of the intersections of set a with all sets, from those of the set answered before where
        the two are much alike."""
        mine = self.sets[a]
        if self.last >= 0:
            last = self.sets[self.last]
            came, gone = np.setdiff1d(mine, last, assume_unique=True), np.setdiff1d(last, mine, assume_unique=True)
            if len(came) + len(gone) < len(mine) // 2:
                self.derived += 1
                self.overlap = self.overlap + self.holders(came) - self.holders(gone)
                self.last = a
                return self.overlap
        self.last, self.overlap = a, self.holders(mine)
        return self.overlap

    def linked(self, a: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` (rising) have similarity of ``percent`` or more with set a."""
        n, pos, t = self.n, self.pos, self.t
        na = n[a]
        # the others are sorted by size: only a run of them can be similar
        lo, hi = np.searchsorted(n[others], -(-t * na // 100)), np.searchsorted(n[others], 100 * na // t, side="right")
        self.skipped += len(others) - (hi - lo)
        others = others[lo:hi]
        nb = n[others]
        # both sets have the list's shingle; at most so many can follow it in both
        at_most = np.minimum(pos[a], pos[others]) + np.minimum(na - pos[a], nb - pos[others])
        others = others[at_most >= -(-t * (na + nb) // (100 + t))]
        if not len(others):
            return others
        common = self.overlaps(a)[others]
        return others[100 * common >= t * (na + n[others] - common)]

    def connect(self, group: np.ndarray | None = None) -> np.ndarray:
        """Component of each set, named by its first member.  ``group``: components
        known already; sets of one are never compared, nor are sets of one block."""
        total = len(self.n)
        name = np.arange(total)
        if group is not None:
            _, first, back = np.unique(group, return_index=True, return_inverse=True)
            name = first[back]
        left = np.ones(total, bool)
        while left.any():
            root = int(np.argmax(left))
            todo = np.flatnonzero(left & (name == name[root])).tolist()
            label = name[root]
            left[todo] = False
            while todo:
                a = todo.pop()
                for b in self.linked(a, np.flatnonzero(left)).tolist():
                    if left[b]:
                        more = np.flatnonzero(left & (name == name[b]))
                        left[more] = False
                        name[more] = label
                        todo += more.tolist()
        return name


def _solve(percent: int, with_groups: bool):
    """Function for tables of (list, s1, s2, n, pos, members[, group]) to edges (a1, a2, b1, b2)."""

    def run(table: pa.Table) -> pa.Table:
        of = table.column("list").to_numpy()
        order = np.argsort(of, kind="stable")
        of = of[order]
        s1, s2, n, pos = (table.column(c).to_numpy()[order] for c in ("s1", "s2", "n", "pos"))
        group = table.column("group").to_numpy()[order] if with_groups else None
        raw = table.column("members").combine_chunks() if isinstance(table.column("members"), pa.ChunkedArray) else table.column("members")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
        edges = [np.zeros((0, 4), np.int64)]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if hi - lo < 2:
                continue
            rows = lo + np.lexsort((s2[lo:hi], s1[lo:hi], n[lo:hi]))
            sets = [np.frombuffer(raw[int(order[i])].as_py(), np.uint64) for i in rows]
            name = Solver(n[rows], pos[rows], sets, percent).connect(group[rows] if with_groups else None)
            if with_groups:  # only links between components that were apart
                joined = np.flatnonzero(group[rows[name]] != group[rows])
            else:
                joined = np.flatnonzero(name != np.arange(len(name)))
            root = rows[name[joined]]
            edges.append(np.stack([s1[root], s2[root], s1[rows[joined]], s2[rows[joined]]], axis=1))
        e = np.concatenate(edges)
        return pa.table({c: pa.array(e[:, i]) for i, c in enumerate(("a1", "a2", "b1", "b2"))})

    return run


EDGE_SCHEMA = "a1 long, a2 long, b1 long, b2 long"


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(s1, s2, c1, c2): the least member of the component of every set on an edge.
    Large-star and small-star rounds until nothing changes; each round's edges
    are a table in the shared folder."""
    a = F.struct(F.col("a1").alias("k1"), F.col("a2").alias("k2"))
    b = F.struct(F.col("b1").alias("k1"), F.col("b2").alias("k2"))
    least, most = F.least(a, b), F.greatest(a, b)
    now = save(edges.select(most.alias("u"), least.alias("v")).where("u <> v").distinct(), "jaccard-edges")
    mark = None
    for _ in range(max_rounds):
        # large star: every larger neighbour is tied to the least of the neighbours and the node itself
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m0")).select("u", F.least("u", "m0").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: the smaller neighbours and the node itself are tied to the least
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v")))).where("u <> v").distinct()
        last, now = now, save(small, "jaccard-edges")
        drop_saved(last)
        is_now = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if is_now == mark:
            break
        mark = is_now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.union(roots).select(F.col("u").getField("k1").alias("s1"), F.col("u").getField("k2").alias("s2"),
                                   F.col("v").getField("k1").alias("c1"), F.col("v").getField("k2").alias("c2"))


def link_classes(docs: DataFrame, text_col: str = "text", k: int = 3, percent: int = 90, max_list: int = MAX_LIST) -> DataFrame:
    """(s1, s2, c1, c2) for every class that is linked with another one."""
    h = F.xxhash64("s1", "s2")
    found = list_entries(docs, text_col, k, percent)
    # lists of two classes or more
    live = found.groupBy("token").agg(F.min(h).alias("a"), F.max(h).alias("b"), F.count("*").alias("c")).where("a <> b").select("token", "c")
    rows = save(found.join(live, "token"), "jaccard-live")
    drop_saved(found)
    shards = n_shards(rows.count(), 100_000, 16)
    plain = "token long, s1 long, s2 long, n long, pos long"
    short = (rows.where(F.col("c") <= max_list).withColumn("shard", F.pmod(F.xxhash64("token"), F.lit(shards)))
             .groupBy("shard").applyInArrow(tidy_group(screen_lists(percent)), plain))
    long = rows.where(F.col("c") > max_list).groupBy("token", "s1", "s2").agg(F.first("n").alias("n"), F.first("pos").alias("pos"))
    entries = save(short.union(long), "jaccard-lists")
    drop_saved(rows)
    # lists with equal members are one
    lists = (entries.groupBy("token").agg(
        F.count("*").alias("size"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 20)).alias("y"))
        .where("size > 1").groupBy("size", "x", "y").agg(F.min("token").alias("token")))
    lists = save(lists.select("token", "size"), "jaccard-distinct")
    block = F.when(F.col("size") > max_list, F.pmod(h, F.ceil(F.col("size") / max_list))).otherwise(F.lit(0))
    listed = save(entries.join(lists, "token").withColumn("block", block.cast("int")), "jaccard-members")
    drop_saved(entries)
    # classes that lists tie together, directly or not, are solved as one list where they are few
    pivot = F.min(F.struct("s1", "s2")).alias("p")
    tied = listed.join(listed.groupBy("token").agg(pivot), "token").select(
        F.col("p.s1").alias("a1"), F.col("p.s2").alias("a2"), F.col("s1").alias("b1"), F.col("s2").alias("b2"))
    family = save(components(tied), "jaccard-families")
    few = family.groupBy("c1", "c2").agg(F.count("*").alias("size")).where(F.col("size") <= MAX_FAMILY).select("c1", "c2")
    few = family.join(few, ["c1", "c2"]).select("s1", "s2", F.xxhash64("c1", "c2").alias("family"))
    apart = listed.join(few, ["s1", "s2"], "left_anti").select("token", "s1", "s2", "n", "pos", "size", "block")
    together = listed.join(few, ["s1", "s2"]).groupBy("family", "s1", "s2").agg(F.first("n").alias("n")).select(
        F.col("family").alias("token"), "s1", "s2", "n", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("size"), F.lit(0).alias("block"))
    members = save(apart.union(together), "jaccard-members")
    drop_saved(listed)
    drop_saved(family)
    bytes_in = members.agg(F.sum("n")).first()[0] or 0
    shards = n_shards(8 * bytes_in, 24 << 20, 16)
    sets = sets_of_classes(docs, text_col, k, build_bloom(members.select("s1").distinct(), "s1")).dropDuplicates(["s1", "s2"])
    full = members.join(sets, ["s1", "s2"])

    def solved(frame: DataFrame, list_key, groups: bool) -> DataFrame:
        cols = ["s1", "s2", "n", "pos", "members", *(["group"] if groups else [])]
        # the salt keeps the blocks of one long list apart
        return (frame.select(list_key.alias("list"), *cols).withColumn("shard", F.pmod("list", F.lit(shards)))
                .groupBy("shard").applyInArrow(tidy_group(_solve(percent, groups)), EDGE_SCHEMA))

    edges = save(solved(full, F.xxhash64("token", "block"), False), "jaccard-links")
    found = save(components(edges), "jaccard-components")
    if lists.where(F.col("size") > max_list).limit(1).count():
        # long lists: blocks that are not of one component yet, two at a time
        cls = found.select("s1", "s2", F.xxhash64("c1", "c2").alias("g"))
        long = (full.where(F.col("size") > max_list).join(cls, ["s1", "s2"], "left")
                .withColumn("group", F.coalesce("g", F.xxhash64("s1", "s2"))).drop("g"))
        long = save(long, "jaccard-long")
        per = long.groupBy("token", "block").agg(F.min("group").alias("lo"), F.max("group").alias("hi"))
        a, b = per.alias("a"), per.alias("b")
        pairs = (a.join(b, F.col("a.token") == F.col("b.token")).where("a.block < b.block and (a.lo <> a.hi or b.lo <> b.hi or a.lo <> b.lo)")
                 .select("a.token", F.col("a.block").alias("first"), F.col("b.block").alias("second")))
        sides = pairs.select("token", "first", "second", F.explode(F.array("first", "second")).alias("block"))
        more = solved(long.join(sides, ["token", "block"]), F.xxhash64("token", "first", "second"), True)
        found = save(components(edges.union(save(more, "jaccard-links"))), "jaccard-components")
    return found


def component_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90,
                  max_list: int = MAX_LIST) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row: component_id is the least
    id that its links reach, its own included."""
    sets = save(document_sets(docs, id_col, text_col, k), "jaccard-sets")
    found = link_classes(docs, text_col, k, percent, max_list)
    classes = sets.where("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("least"))
    named = classes.join(found, ["s1", "s2"], "left").select("s1", "s2", "least", F.coalesce("c1", "s1").alias("c1"), F.coalesce("c2", "s2").alias("c2"))
    least = named.groupBy("c1", "c2").agg(F.min("least").alias("component"))
    of_class = named.join(least, ["c1", "c2"]).select("s1", "s2", "component")
    return (sets.join(of_class, ["s1", "s2"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return component_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"))
