"""Operator 2: token ids as ORC files for training.

Documents are range-partitioned by id, encoded, and written as one ORC file a
partition, in ascending id order.  ORC keeps the ids as run-length encoded
integers; stripes are small enough for parallel reads, each with a row index
(min and max of every ``row_index`` rows) and a Bloom filter on the document
id, so that a look-up by id skips files, stripes and row groups by metadata.

Columns of the files: doc_id, part (number of the file in order), local_start
(ids before the document in its file), n_tokens, token_ids (array<int>).  A
document's start in the whole corpus is local_start plus the totals of the
earlier files, one number a file.

The tokenizer drops white space and never looks across it, so texts are
encoded word by word, with the library, and the ids of words already met are
kept.  Words of plain characters are cut into the pieces that the tokenizer's
own pattern gives instead, by array operations; each distinct piece of a run of
texts is encoded once, by the library's model.  The result is that of encoding
the whole text.

Defined results: a null text is empty and yields the end id alone; rows with
equal ids follow each other ordered by a hash of the text; null ids come
first; an empty table writes no documents.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Kept, chunks, find_words, hash_spans, n_shards, of_process, scratch_path, text_bytes, tidy

FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, token_ids array<int>"
KEPT_WORDS = 400_000
CHUNK_BYTES = 1 << 20
WHITE = re.compile(rb"[ \n]")


def find_mark(tok) -> tuple[str, int] | None:
    """A control character that the tokenizer makes one id of, and that id."""
    for code in range(1, 9):
        ids = tok.encode(chr(code), add_special_tokens=False).ids
        if len(ids) == 1 and tok.encode(f"a {chr(code)} a", add_special_tokens=False).ids.count(ids[0]) == 1:
            return chr(code), ids[0]
    return None


def encode_words(tok, words: list[str], per_call: int = 1000) -> list[bytes]:
    """Packed ids of each word.  Words go to the library many at a time, between
    marks: a control character with an id of its own.  Words with that character
    go alone."""
    mark = find_mark(tok)
    out: list[bytes] = [b""] * len(words)
    alone = [i for i, w in enumerate(words) if mark is None or mark[0] in w]
    for i, e in zip(alone, tok.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)):
        out[i] = np.array(e.ids, np.int32).tobytes()
    rest = [i for i, w in enumerate(words) if mark is not None and mark[0] not in w]
    for lo in range(0, len(rest), 64 * per_call):
        groups = [rest[i:i + per_call] for i in range(lo, min(lo + 64 * per_call, len(rest)), per_call)]
        texts = [f" {mark[0]} ".join(words[i] for i in g) for g in groups]
        for group, e in zip(groups, tok.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, np.int32)
            cuts = np.flatnonzero(ids == mark[1])
            if len(cuts) != len(group) - 1:
                raise ValueError("words were not cut at the marks")
            raw, begin = ids.tobytes(), 0
            for i, cut in zip(group, [*cuts.tolist(), len(ids)]):
                out[i] = raw[4 * begin:4 * cut]
                begin = cut + 1
    return out


class Pieces:
    """Finds the pieces that the tokenizer's model encodes one by one, by array
    operations over the code points of many texts.

    For a tokenizer that lower-cases, splits by ``PATTERN`` and maps bytes to
    letters, as its own description tells; and for words of characters that
    normalise to one character each, none part of a composition."""

    PLAIN = range(0x21, 0x130)  # below the combining marks
    #: fixed value: the pattern whose matches ``cut`` finds
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    GAP, LETTER, DIGIT, OTHER, ODD = range(5)

    def __init__(self, tok):
        import regex
        from tokenizers import pre_tokenizers
        as_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        normal = {c: tok.normalizer.normalize_str(c) for c in map(chr, self.PLAIN)}
        plain = [c for c, n in normal.items() if n == c.lower() and len(n) == 1 and ord(n) in self.PLAIN and not n.isspace()
                 and not c.isspace() and (not c.isascii() or as_letters(c)[0][0] == c)]  # ASCII pieces are taken as they are
        self.letters = {ord(c): as_letters(c)[0][0] for c in plain}
        self.kind = np.full(self.PLAIN.stop + 1, self.ODD, np.uint8)  # the last entry stands for all further characters
        self.low = np.arange(self.PLAIN.stop + 1, dtype=np.uint32)
        self.kind[[32, 10]] = self.GAP
        for c in plain:
            low = normal[c]
            self.low[ord(c)] = ord(low)
            self.kind[ord(c)] = self.LETTER if regex.match(r"\p{L}", low) else self.DIGIT if regex.match(r"\p{N}", low) else self.OTHER
        added = [t.content.lower() for t in tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.model = tok.model

    @classmethod
    def of(cls, tok) -> Pieces | None:
        """None for a tokenizer made otherwise."""
        made = json.loads(tok.to_str())
        steps = [n.get("type") for n in (made["normalizer"] or {}).get("normalizers", [])]
        cuts = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [c.get("type") for c in cuts] != ["Split", "ByteLevel"]:
            return None
        split, letters = cuts
        if split["behavior"] != "Removed" or not split["invert"] or letters["use_regex"] or letters["add_prefix_space"]:
            return None
        return cls(tok) if split["pattern"]["Regex"] == cls.PATTERN else None

    def cut(self, codes: np.ndarray, offs: np.ndarray):
        """(lower-cased code points, starts, ends, which are whole words for the
        library) of the pieces of the texts ``codes[offs[i]:offs[i + 1]]``."""
        at = np.minimum(codes, self.PLAIN.stop)
        kind, low = self.kind[at], self.low[at]
        far = at == self.PLAIN.stop
        low[far] = codes[far]
        new_text = np.zeros(len(codes) + 1, bool)
        new_text[offs] = True
        word = kind != self.GAP
        changed = new_text[:-1].copy()
        changed[1:] |= kind[1:] != kind[:-1]
        start = word & (changed | (kind == self.DIGIT))
        self._contractions(low, kind, start, new_text)
        odd = np.flatnonzero(kind == self.ODD)
        if self.added:
            text = low.astype("<u4").tobytes().decode("utf-32-le")
            odd = np.concatenate([odd, np.array([m.start() for m in self.added.finditer(text)], odd.dtype)])
        whole = np.zeros(0, np.int64)
        if len(odd):  # their words are pieces of their own
            first = word & new_text[:-1]
            first[1:] |= word[1:] & ~word[:-1]
            first = np.flatnonzero(first)
            mine = np.unique(np.searchsorted(first, odd, side="right") - 1)
            whole = first[mine]
            inside = np.zeros(len(codes) + 1, np.int8)
            inside[whole] = 1
            inside[np.append(first[1:], len(codes))[mine]] -= 1
            start &= np.cumsum(inside[:-1], dtype=np.int8) == 0
            start[whole] = True
        end = word.copy()
        end[:-1] &= start[1:] | ~word[1:] | new_text[1:-1]
        starts = np.flatnonzero(start)
        return low, starts, np.flatnonzero(end) + 1, np.isin(starts, whole)

    def _contractions(self, low: np.ndarray, kind: np.ndarray, start: np.ndarray, new_text: np.ndarray) -> None:
        """'s 't 'm 'd 're 've 'll where a piece starts are pieces; letters behind them start anew."""
        on = np.append((kind == self.LETTER) & ~new_text[:-1], [False, False])  # letters behind something of their text
        mark = np.flatnonzero(start & (low == ord("'")) & on[1:-1])
        after = np.append(low, [0, 0])
        a, b, more = after[mark + 1], after[mark + 2], on[mark + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = more & ((np.isin(a, [ord("r"), ord("v")]) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        size = np.where(one, 1, np.where(two, 2, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        behind = mark + 1 + size
        start[behind[on[behind]]] = True

    def encode(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.translate(self.letters)
        return array("i", [t.id for t in self.model.tokenize(letters)]).tobytes()


def same_spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> bool:
    """Does each span equal the span that starts at ``like`` and is as long?"""
    n = ends - starts
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return bool((codes[at] == codes[at + np.repeat(like - starts, n)]).all())


class Encoder:
    """Encodes texts; keeps the packed ids of recent pieces and words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok, self.kept, self.words = Tokenizer.from_file(path), Kept(KEPT_WORDS), Kept(KEPT_WORDS // 4)
        self.pieces = Pieces.of(self.tok)

    @staticmethod
    def _ids(names: list[str], kept: Kept, encode) -> list[bytes]:
        """Packed ids of each name; ``encode`` gives those of names not met before."""
        out = kept.get_all(names)
        new = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(new, encode([names[i] for i in new])):
            out[i] = ids
            if len(names[i]) <= 64:
                kept.put(names[i], ids)
        return out

    def _cut(self, codes: np.ndarray, offs: np.ndarray):
        if self.pieces:
            return self.pieces.cut(codes, offs)
        is_word = np.ones(256, bool)
        is_word[[32, 10]] = False
        starts, ends, _ = find_words(np.minimum(codes, 255), offs, is_word)
        return codes, starts, ends, np.ones(len(starts), bool)

    def encode_run(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of each text's ids) of UTF-8 texts ``data[offs[i]:offs[i + 1]]``."""
        text = data.tobytes().decode("utf-8")
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if len(text) != len(data):
            offs = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offs]
        low, starts, ends, whole = self._cut(codes, offs)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offs) - 1, np.int64)
        keys = hash_spans(low, starts, ends) ^ whole
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if not (np.array_equal((ends - starts)[first][which], ends - starts) and np.array_equal(whole[first][which], whole)
                and same_spans(low, starts, ends, starts[first][which])):  # two pieces of one hash: each is its own
            first = which = np.arange(len(starts))
        lower = text if low is codes else low.astype("<u4").tobytes().decode("utf-32-le")
        ids: list[bytes] = [b""] * len(first)
        for of_text, kept, encode, flag in ((lower, self.kept, lambda new: map(self.pieces.encode, new), False),
                                            (text, self.words, lambda new: encode_words(self.tok, new), True)):
            mine = np.flatnonzero(whole[first] == flag)
            if not len(mine):
                continue
            names = [of_text[a:z] for a, z in zip(starts[first[mine]].tolist(), ends[first[mine]].tolist())]
            for i, x in zip(mine.tolist(), self._ids(names, kept, encode)):
                ids[i] = x
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, begin, count = np.frombuffer(b"".join(ids), np.int32), (np.cumsum(n) - n)[which], n[which]
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        before = np.concatenate([[0], np.cumsum(count)])
        return flat[at], np.diff(before[np.searchsorted(starts, offs)])


def slices(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Cuts one text before a space or newline, each as soon as ``size`` bytes are full."""
    lo = 0
    while len(data) - lo > size:
        raw = data[lo + size:].tobytes()
        found = WHITE.search(raw)
        if not found:
            break
        yield data[lo:lo + size + found.start()]
        lo += size + found.start()
    yield data[lo:]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, bytes_per_file: int = 32 << 20,
                 stripe_bytes: int = 4 << 20, row_index: int = 1000, bloom_fpp: float = 0.01) -> None:
    """Encode ``docs`` (doc_id, text) into ORC files under ``path``."""
    files = n_shards(text_bytes(docs, "text"), bytes_per_file, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext
        enc = of_process(f"words {tokenizer}", lambda: Encoder(tokenizer))
        part = TaskContext.get().partitionId()
        start = 0
        for whole in batches:
            for lo, hi, data, offs in chunks(whole.column(1), CHUNK_BYTES):
                b = whole.slice(lo, hi - lo)
                if hi - lo == 1:  # one text, of any length
                    made = [enc.encode_run(x, np.array([0, len(x)]))[0] for x in slices(data, CHUNK_BYTES)]
                    flat, n = np.concatenate(made), np.array([sum(map(len, made))])
                else:
                    flat, n = enc.encode_run(data, offs)
                n = n + 1  # with the end id
                offsets = np.concatenate([[0], np.cumsum(n)])
                packed = np.full(offsets[-1], end_id, np.int32)
                is_id = np.ones(len(packed), bool)
                is_id[offsets[1:] - 1] = False
                packed[is_id] = flat
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(packed))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(start + offsets[:-1]), pa.array(n), ids],
                    names=["doc_id", "part", "local_start", "n_tokens", "token_ids"])
                start += int(offsets[-1])

    (docs.select(F.col("doc_id").cast("long"), "text")
     .repartitionByRange(files, F.col("doc_id"), F.xxhash64("text"))
     .sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(tidy(run), FILE_SCHEMA)
     .write.option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", row_index).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", bloom_fpp)
     .orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``, a document's place among all ids."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("t"))  # one row a file
    before = totals.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    return (rows.join(F.broadcast(before), "part")  # a number a file, written by this operator
            .select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "token_ids"))


def find_documents(tokens: DataFrame, ids: list[int]) -> DataFrame:
    """The rows of ``tokens`` (from ``read_tokens``) with these document ids.  The ids reach the
    scan: files, stripes and row groups are skipped by their least and greatest id and Bloom filter."""
    return tokens.where(F.col("doc_id").isin([int(i) for i in ids]))


def with_crc(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(3)
            offs = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
            crc = [zlib.crc32(raw[4 * lo:4 * hi]) for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "token_ids").mapInArrow(
        tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch_path(spark, "op2-tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    return with_crc(read_tokens(spark, path))
