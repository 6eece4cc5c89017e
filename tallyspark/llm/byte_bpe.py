"""Operator 1: byte-level BPE encoding and decoding.

A pre-token whose bytes are a vocabulary entry is that entry.  Any other is
merged by a rank queue: one bucket per merge rank holds the positions (in a
linked list of parts) of the pairs with that rank, and a hierarchical bitmap
over the ranks finds the lowest occupied bucket by find-first-set.  A merge
never searches for the entries it outdates; they are skipped when they are
popped.  A pre-token of n bytes costs O(n log n), however long it is.

Defined results: a null text encodes as an empty one (no ids); decoding null
ids gives empty bytes; repeated rows are encoded each; other columns pass
through untouched, except that columns named like the added ones
(``token_ids``, ``n_tokens``, ``decoded``) are replaced.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Kept, chunks, of_process, tidy

#: White space other than space and newline: texts with it are cut by the pattern alone.
ODD_SPACE = re.compile("[\t\r\x0b\x0c\x85\xa0  -     　]")
#: A run of spaces and newlines with the characters up to the next one.
PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
KEPT_PIECES, KEPT_CHARS = 200_000, 64
#: Bytes of text that are encoded together.
ENCODE_BYTES = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


#: Bits of one word of the bitmap's lower level.
WORD = 256


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always the lowest-ranked pair, the leftmost of equals.

    ``buckets[r]`` is a heap of the positions whose pair has rank r.  Bit r % WORD
    of ``low[r // WORD]`` says that it isn't empty, bit w of ``top`` that low[w]
    has a set bit.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    rank_of = ranks.get
    end = list(range(1, n + 1))   # the part that begins at i ends there, where the next begins
    back = list(range(-1, n - 1))  # begin of the part before
    pair = [-1] * n               # rank of the pair that begins at i; -1: none, or merged away
    buckets: dict[int, list[int]] = {}
    low: dict[int, int] = {}
    top = 0
    fresh = [(r, i) for i in range(n - 1) if (r := rank_of(piece[i:i + 2])) is not None]
    for r, i in fresh:
        pair[i] = r
    while True:
        for r, i in fresh:
            if r in buckets:
                heappush(buckets[r], i)
            else:
                buckets[r] = [i]
                w = r // WORD
                low[w] = low.get(w, 0) | 1 << r % WORD
                top |= 1 << w
        if not top:
            break
        w = (top & -top).bit_length() - 1
        bits = low[w]
        rank = w * WORD + (bits & -bits).bit_length() - 1
        bucket = buckets[rank]
        i = heappop(bucket)
        if not bucket:
            del buckets[rank]
            low[w] = bits = bits & (bits - 1)
            if not bits:
                top &= top - 1
        fresh = ()
        if pair[i] != rank:  # stale
            continue
        j = end[i]
        end[i] = k = end[j]
        pair[j] = pair[i] = -1
        fresh = []
        if k < n:
            back[k] = i
            if (r := rank_of(piece[i:end[k]])) is not None:
                pair[i] = r
                fresh.append((r, i))
        h = back[i]
        if h >= 0:
            pair[h] = -1
            if (r := rank_of(piece[h:k])) is not None:
                pair[h] = r
                fresh.append((r, h))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Merger:
    """Merges many pre-tokens side by side with one rank queue.

    A bucket holds the positions of its rank over all pre-tokens and is merged
    by array operations, left to right where pairs overlap.  Taking a whole
    bucket at once is the same as one position at a time unless a merge opens a
    pair of a lower rank; the pre-tokens where that happens are merged again by
    ``merge``.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=0) + 1
        keys, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    made.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        self.byte_id = np.array([ranks.get(bytes([x]), -1) for x in range(256)], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's joined bytes, -1 without one."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int64)
        want = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.made[at], -1)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each (non-empty) pre-token."""
        sizes = np.array([len(x) for x in pieces], np.int64)
        if not len(sizes):
            return []
        token = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(token)
        first = np.concatenate([[0], np.cumsum(sizes)])
        nxt = np.arange(1, n + 2)          # position n stands for "none", on both sides
        back = np.arange(-1, n)
        nxt[first[1:] - 1] = n
        back[first[:-1]] = n
        token = np.append(token, -1)
        live = np.ones(n, bool)
        pair = np.full(n + 1, -1, np.int64)
        inner = np.flatnonzero(nxt[:n] < n)
        pair[inner] = self.pair_ranks(token[inner], token[inner + 1])
        odd: set[int] = set()
        buckets: dict[int, list[np.ndarray]] = {}
        low: dict[int, int] = {}
        top = 0
        fresh = np.flatnonzero(pair >= 0)
        while True:
            if len(fresh):
                of = pair[fresh]
                order = np.argsort(of, kind="stable")
                fresh, of = fresh[order], of[order]
                cuts = np.flatnonzero(np.diff(of)) + 1
                for r, where in zip(of[np.concatenate([[0], cuts])].tolist(), np.split(fresh, cuts) if len(cuts) else [fresh]):
                    if r in buckets:
                        buckets[r].append(where)
                    else:
                        buckets[r] = [where]
                        w = r // WORD
                        low[w] = low.get(w, 0) | 1 << r % WORD
                        top |= 1 << w
            if not top:
                break
            w = (top & -top).bit_length() - 1
            bits = low[w]
            rank = w * WORD + (bits & -bits).bit_length() - 1
            low[w] = bits = bits & (bits - 1)
            if not bits:
                top &= top - 1
            held = buckets.pop(rank)
            at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            at = at[pair[at] == rank]  # the others are stale
            fresh = at[:0]
            if not len(at):
                continue
            if len(at) > 1 and (touch := nxt[at[:-1]] == at[1:]).any():
                # in a run of overlapping pairs the first, third, ... are merged
                begins = np.flatnonzero(~np.concatenate([[False], touch]))
                run = np.repeat(begins, np.diff(np.append(begins, len(at))))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = nxt[at]
            right = nxt[gone]
            token[at] = rank
            nxt[at] = right
            back[right] = at
            left = back[at]
            live[gone] = False
            pair[gone] = pair[at] = -1
            pair[left] = -1
            a, b = np.concatenate([left, at]), np.concatenate([at, right])
            ok = (a < n) & (b < n)
            a, b = a[ok], b[ok]
            r = self.pair_ranks(token[a], token[b])
            a, r = a[r >= 0], r[r >= 0]
            pair[a] = r
            if (r < rank).any():
                odd.update((np.searchsorted(first, a[r < rank], side="right") - 1).tolist())
            fresh = np.unique(a) if len(a) else a
        packed = memoryview(token[:n][live].astype("<u4").tobytes())
        ends = (4 * np.cumsum(live)[first[1:] - 1]).tolist()
        out, begin = [], 0
        for end in ends:
            out.append(bytes(packed[begin:end]))
            begin = end
        for i in odd:
            out[i] = array("I", merge(pieces[i], self.ranks)).tobytes()
        return out


class Encoder:
    """Encodes texts; keeps the packed ids of recent short pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.merger, self.ranks = Merger(ranks), ranks
        self.find, self.kept = regex.compile(pattern).findall, Kept(KEPT_PIECES)

    def _ids(self, names: set[str], cut) -> dict[str, bytes]:
        """Packed ids of each name; ``cut`` gives those of names not met before."""
        kept = self.kept
        out = {x: kept.get(x) for x in names}
        new = [x for x, ids in out.items() if ids is None]
        for x, ids in zip(new, cut(new)):
            out[x] = ids
            if len(x) <= KEPT_CHARS:
                kept.put(x, ids)
        return out

    def _merged(self, matches: list[str]) -> list[bytes]:
        raw = [m.encode("utf-8") for m in matches]
        out = [b""] * len(raw)
        todo = []
        for i, m in enumerate(raw):
            whole = self.ranks.get(m)
            if whole is None:
                todo.append(i)
            else:
                out[i] = whole.to_bytes(4, "little")
        for i, ids in zip(todo, self.merger.merge_all([raw[i] for i in todo])):
            out[i] = ids
        return out

    def _by_pattern(self, texts: list[str]) -> list[bytes]:
        matches = [self.find(t) for t in texts]
        ids = self._ids({m for ms in matches for m in ms}, self._merged)
        return [b"".join(map(ids.__getitem__, ms)) for ms in matches]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers.

        A match of the pattern never covers parts of two pieces when space and
        newline are a text's only white space, so distinct pieces are cut alone.
        """
        pieces = [[t] if ODD_SPACE.search(t) else PIECE.findall(t) for t in texts]
        ids = self._ids({x for p in pieces for x in p}, self._by_pattern)
        return [b"".join(map(ids.__getitem__, p)) for p in pieces]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


class Decoder:
    """All tokens' bytes in one array; a text is one gather from it."""

    def __init__(self, ranks: dict[bytes, int]):
        by = {r: t for t, r in ranks.items()}
        size = max(by, default=-1) + 1
        self.length = np.array([len(by.get(r, b"")) for r in range(size)], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)[:-1]]) if size else np.zeros(0, np.int64)
        self.flat = np.frombuffer(b"".join(by.get(r, b"") for r in range(size)), np.uint8)

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        if not len(ids):
            return b""
        n = self.length[ids]
        at = np.cumsum(n)
        return self.flat[np.repeat(self.begin[ids] - at + n, n) + np.arange(at[-1])].tobytes()


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` with ``token_ids`` (binary: little-endian unsigned 32-bit) and ``n_tokens``;
    with ``decode`` also ``decoded``, the bytes that the ids stand for, from the same task."""
    out = docs.drop("token_ids", "n_tokens", *(["decoded"] if decode else []))
    at = out.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = of_process(f"bpe {vocabulary} {pattern}", lambda: Encoder(read_ranks(vocabulary), pattern))
        back = of_process(f"bpe bytes {vocabulary}", lambda: Decoder(enc.ranks)).decode if decode else None
        for b in batches:
            for lo, hi, _, _ in chunks(b.column(at), ENCODE_BYTES):
                part = b.slice(lo, hi - lo)
                ids = enc.encode_all([t or "" for t in part.column(at).to_pylist()])
                more = [pa.array(map(back, ids), pa.binary())] if decode else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), *more], names=made.names)

    made = T.StructType([*out.schema.fields, T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
                         *([T.StructField("decoded", T.BinaryType())] if decode else [])])
    return out.mapInArrow(tidy(run), made)


def decode_ids(tokens: DataFrame, vocabulary: str, ids_col: str = "token_ids") -> DataFrame:
    """``tokens`` with ``decoded``: the bytes that the packed ids stand for."""
    out = tokens.drop("decoded")
    at = out.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = of_process(f"bpe bytes {vocabulary}", lambda: Decoder(read_ranks(vocabulary))).decode
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                texts = [decode(x.as_py() or b"") for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())],
                                                 names=[*part.schema.names, "decoded"])

    return out.mapInArrow(tidy(run), T.StructType([*out.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the packed ids and of what they decode to."""
    return encode_texts(docs.select("doc_id", "text"), vocabulary, pattern, decode=True).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
