"""Operator 13: spelling variant grouping by sorted-list dynamic programming.

Words are counted over all documents.  Two words are near if one inserted,
deleted or replaced code point turns one into the other.  A word's form is its
near word of largest count, if that is at least ``RATIO`` times its own; its root
is where its chain of forms ends.

Where a pair differs, at a code point i after which the rest is equal again, i
falls into one interval lo..hi of positions, and both words then share the first
lo code points and the last L - hi, L being the shorter one's length.  A word is
dealt to a group for its own length and for the one below (as the longer of a
pair), for either half of the positions, so any near pair meets in the one group
whose interval holds its i.  Groups of more than ``MAX_GROUP`` words are dealt
again with their interval halved; with one position left a group can't hold more
words than there are pairs of letters.

A group's words are a sorted list.  All of them are looked up in it at once, one
code point deeper a step: words that share a prefix (their LCP) are a range with
a single row of the edit matrix for each word looked up, of which the band of
three entries about the diagonal is kept; a range whose band exceeds one edit is
dropped with all words in it, and where adjacent LCPs end a range, its parts go
on from the row they share.  Groups by suffix hold reversed words.

Words of more than ``LONG`` code points are compared in pairs from both ends; their groups are halved
down to ``MAX_LONG_GROUP`` words where that is possible.

Defined results: null texts have no words; a null id is spelt empty in front of
the colon; repeated rows count again; ties of a form's count go to the smaller
word in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_shards, save, tidy

LEAST_LENGTH, LEAST_COUNT = 7, 2
RATIO = 10
DAMAGE = 31
MAX_GROUP = 4096
#: Words of a task's counts before they are sent on / of groups that are searched at once.
HELD_WORDS, SEARCHED_WORDS = 200_000, 30_000
#: Words longer than this are compared with one another, in groups of at most so many.
LONG, MAX_LONG_GROUP = 256, 16


# ---------------------------------------------------------------- counts
def damaged(run: str, prefix: int) -> str:
    """The run, without one code point where its checksum says so."""
    h = zlib.crc32(run.encode(), prefix)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): the words of at least ``least_length`` code points over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # shorter runs can't give a word: deleting only shortens them
        runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")
        low = {i: i + 32 for i in range(65, 91)}
        held: Counter = Counter()

        def give():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                prefix = zlib.crc32(f"{'' if not doc_id.is_valid else doc_id.as_py()}:".encode())
                for word, n in Counter(m.group() for m in runs.finditer(text.translate(low))).items():
                    word = damaged(word, prefix)
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield give()
                    held.clear()
        if held:
            yield give()

    return (docs.select(id_col, text_col).mapInArrow(tidy(run), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


# ---------------------------------------------------------------- groups
def deal(words: DataFrame, first: bool) -> DataFrame:
    """(key, short, lo, hi, word, n): each word in its groups, or the groups of ``words`` halved."""
    size = F.length("word")
    if first:
        rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short")).where(F.col("short") >= LEAST_LENGTH)
        middle = F.floor(F.col("short") / 2).cast("int")
        halves = F.array(F.struct(F.lit(0).alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), (F.col("short") + 1).alias("hi")))
    else:
        rows = words
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    rows = rows.withColumn("half", F.explode(halves)).select("short", F.col("half.lo").alias("lo"), F.col("half.hi").alias("hi"), "word", "n")
    # a replaced code point at i < hi leaves the last short - hi equal, an inserted one more
    tail = F.expr("right(word, greatest(short - hi, 0))")
    return rows.select(F.xxhash64("short", "lo", "hi", F.expr("left(word, lo)"), tail).alias("key"), "short", "lo", "hi", "word", "n")


# ---------------------------------------------------------------- the search in a sorted list
class Lists:
    """The words of several groups as sorted lists of code points."""

    def __init__(self, group: np.ndarray, words: list[str], turned: bool):
        order = sorted(range(len(words)), key=lambda i: (group[i], words[i][::-1] if turned else words[i]))
        self.order = np.array(order, np.int64)
        self.group = group[self.order]
        text = [words[i][::-1] if turned else words[i] for i in order]
        self.size = np.fromiter(map(len, text), np.int64, len(text))
        self.code = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
        self.at = np.cumsum(self.size) - self.size

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the prefix that words a and b share."""
        out = np.zeros(len(a), np.int64)
        live, d = np.arange(len(a)), 0
        while len(live):
            x, y = a[live], b[live]
            both = (self.size[x] > d) & (self.size[y] > d)
            live, x, y = live[both], x[both], y[both]
            same = self.code[self.at[x] + d] == self.code[self.at[y] + d]
            live = live[same]
            d += 1
            out[live] = d
        return out


def near_in_lists(lists: Lists, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): places of words of one list at an edit distance of one; ``start`` is the
    length of the prefix that all words of the word's list share."""
    size, code, at, group = lists.size, lists.code, lists.at, lists.group
    total = len(size)
    # adjacent words: where the LCP with the word before ends (a list's first word shares nothing)
    lcp = np.zeros(total, np.int64)
    lcp[1:] = lists.shared(np.arange(total - 1), np.arange(1, total))
    first = np.concatenate([[True], group[1:] != group[:-1]])
    lcp[first] = -1
    cuts = np.flatnonzero(~first)  # places inside lists by the depth at which they part, as depth * total + place
    cuts = np.sort(lcp[cuts] * total + cuts)
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], total)
    of = np.cumsum(first) - 1
    # (word looked up, range lo..hi of its list, depth, band): the whole list to begin with
    word = np.arange(total)
    lo, hi, depth = begin[of], end[of], start.copy()
    big = np.uint8(9)
    band = np.tile(np.array([1, 0, 1], np.uint8), (total, 1))  # edits to word[:depth-1], word[:depth], word[:depth+1]
    band[depth == 0, 0] = big
    band[size[word] < depth + 1, 2] = big
    out_a, out_b = [], []
    while len(word):
        # the word that ends at this depth is the range's first
        ends = size[lo] == depth
        gap = size[word] - depth
        slot = np.clip(gap + 1, 0, 2)
        hit = ends & (np.abs(gap) <= 1) & (band[np.arange(len(word)), slot] == 1)
        out_a.append(word[hit])
        out_b.append(lo[hit])
        lo = lo + ends
        go = lo < hi
        word, lo, hi, depth, band = word[go], lo[go], hi[go], depth[go], band[go]
        if not len(word):
            break
        # parts of the range: they start at its first word and wherever the LCP is the depth
        left_ = np.searchsorted(cuts, depth * total + lo, side="right")
        width = np.searchsorted(cuts, depth * total + hi, side="left") - left_ + 1
        row = np.repeat(np.arange(len(word)), width)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
        place = np.where(nth == 0, lo[row], cuts[np.maximum(left_[row] + nth - 1, 0)] % total if len(cuts) else lo[row])
        last = np.append(row[1:] != row[:-1], True)
        stop = np.where(last, hi[row], np.append(place[1:], 0))
        letter = code[at[place] + depth[row]]
        # the next row of the matrix, three entries: word[:depth], word[:depth+1], word[:depth+2]
        w, d, old = word[row], depth[row], band[row]
        left = size[w] - d

        def letter_at(shift: int) -> np.ndarray:
            ok = (d + shift >= 0) & (left > shift)
            return np.where(ok, code[np.minimum(at[w] + np.maximum(d + shift, 0), len(code) - 1)], np.uint32(0))

        new = np.empty_like(old)
        new[:, 0] = np.minimum(np.where(d >= 1, old[:, 0] + (letter_at(-1) != letter), big), old[:, 1] + 1)
        new[d == 0, 0] = 1
        new[:, 1] = np.minimum(np.minimum(old[:, 1] + (letter_at(0) != letter), old[:, 2] + 1), new[:, 0] + 1)
        new[:, 2] = np.minimum(old[:, 2] + (letter_at(1) != letter), new[:, 1] + 1)
        new[left < 0, 0] = big
        new[left < 1, 1] = big
        new[left < 2, 2] = big
        keep = new.min(axis=1) <= 1
        word, lo, hi, depth, band = w[keep], place[keep], stop[keep], d[keep] + 1, np.minimum(new[keep], big)
    return np.concatenate([np.zeros(0, np.int64), *out_a]), np.concatenate([np.zeros(0, np.int64), *out_b])


def near_long(group: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, where they first differ) for near long words of one group, a pair at a time: what
    the two share from the front and from the back."""
    code = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
    order = np.argsort(group, kind="stable")
    out = []
    for mine in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        for i, j in itertools.combinations(mine.tolist(), 2):
            x, y = sorted((code[i], code[j]), key=len)
            if len(y) - len(x) > 1:
                continue
            apart = np.flatnonzero(x != y[:len(x)])
            at = int(apart[0]) if len(apart) else len(x)
            tail = len(x) - at - (len(x) == len(y))  # below 0: equal words
            if tail >= 0 and np.array_equal(x[len(x) - tail:], y[len(y) - tail:]):
                out += [(i, j, at), (j, i, at)]
    return tuple(np.array(out, np.int64).reshape(-1, 3).T)


def near_in_groups(key: np.ndarray, short: np.ndarray, lo: np.ndarray, hi: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): rows of one group whose words are near, their first difference within the group's interval."""
    _, group, size = np.unique(key, return_inverse=True, return_counts=True)
    shared = size[group] > 1
    length = np.fromiter(map(len, words), np.int64, len(words))
    out = [(np.zeros(0, np.int64),) * 3]
    long = np.flatnonzero(shared & (short > LONG))
    if len(long):
        a, b, at = near_long(group[long], [words[i] for i in long.tolist()])
        out.append((long[a], long[b], at))
    for turned in (False, True):
        rows = np.flatnonzero(shared & (short <= LONG) & ((lo == 0) == turned))
        if not len(rows):
            continue
        part = [words[i] for i in rows.tolist()]
        lists = Lists(group[rows], part, turned)
        mine = rows[lists.order]
        a, b = near_in_lists(lists, np.maximum(short[mine] - hi[mine], 0) if turned else lo[mine])
        plain = Lists(np.zeros(len(rows), np.int64), part, False)
        place = np.empty(len(rows), np.int64)
        place[plain.order] = np.arange(len(rows))
        out.append((mine[a], mine[b], plain.shared(place[lists.order[a]], place[lists.order[b]])))
    a, b, at = (np.concatenate(x) for x in zip(*out))
    # a pair belongs to the group of its shorter length whose interval holds its first difference
    mine = (np.minimum(length[a], length[b]) == short[a]) & (at >= lo[a]) & (at < hi[a])
    return a[mine], b[mine]


def near_pairs(dealt: DataFrame, shards: int) -> DataFrame:
    """(word, n, near, near_n) for both directions of every near pair of the dealt groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(held: list[pa.RecordBatch], cut_last: bool):
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            stop = int(np.searchsorted(key, key[-1])) if cut_last else len(key)
            part, rest = table.slice(0, stop), table.slice(stop)
            if not stop:
                return None, rest
            short, lo, hi, n = (part.column(c).to_numpy().astype(np.int64) for c in ("short", "lo", "hi", "n"))
            words = part.column("word").to_pylist()
            a, b = near_in_groups(key[:stop], short, lo, hi, words)
            word = part.column("word").combine_chunks()
            return pa.RecordBatch.from_arrays([word.take(pa.array(a)), pa.array(n[a]), word.take(pa.array(b)), pa.array(n[b])],
                                              names=["word", "n", "near", "near_n"]), rest

        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.num_rows
            if size >= SEARCHED_WORDS:
                out, rest = give(held, True)
                if out is not None:
                    yield out
                held, size = rest.to_batches(), rest.num_rows
        if size:
            yield give(held, False)[0]

    return (dealt.repartition(shards, "key").sortWithinPartitions("key")
            .mapInArrow(tidy(run), "word string, n long, near string, near_n long"))


# ---------------------------------------------------------------- the operator
def near_words(words: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """(word, n, near, near_n) for both directions of every near pair of ``words`` (word, n)."""
    dealt, found, first = words, None, True
    while True:
        dealt = deal(dealt, first)
        shards = n_shards(dealt.count(), 200_000)
        most = F.when(F.col("short") > LONG, F.lit(min(max_group, MAX_LONG_GROUP))).otherwise(F.lit(max_group))
        crowd = (dealt.groupBy("key", "short", "lo", "hi").agg(F.count("*").alias("c"))
                 .where((F.col("c") > most) & (F.col("hi") - F.col("lo") > 1)).select("key"))
        crowd = save(crowd, "spelling-crowded")
        more = crowd.limit(1).count() > 0
        got = near_pairs(dealt.join(crowd, "key", "left_anti") if more else dealt, shards)
        found = got if found is None else found.union(got)
        if not more:
            return found
        dealt, first = save(dealt.join(crowd, "key", "left_semi").drop("key"), "spelling-halved"), False


def roots(forms: DataFrame, tag: str = "spelling-roots") -> DataFrame:
    """(word, root) from (word, form): follows the forms, each round twice as far.  Counts grow
    by ``RATIO`` with every form, so chains are short and never come back."""
    now = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        now = save(now, tag)
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not now.join(step, "root", "left_semi").limit(1).count():
            return now
        now = now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_group: int = MAX_GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word."""
    words = save(word_counts(docs, id_col, text_col).where(F.col("n") >= LEAST_COUNT), "spelling-words")
    # the largest count, and of equal ones the word that comes first
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words, max_group).groupBy("word").agg(F.count("*").alias("n_near"), best)
    told = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best")
    strong = -F.col("best.less") >= RATIO * F.col("n")
    told = save(told.select("word", "n", "n_near", F.when(strong, F.col("best.near")).alias("form"),
                            F.when(strong, -F.col("best.less")).alias("form_n")), "spelling-forms")
    return told.join(roots(told), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_groups(spark, sf_dir: str) -> DataFrame:
    return spelling_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
