"""SimHash cover, whitening and spelling groups against brute force: nulls, empty and
long texts, ties, repeated rows, empty tables, clashing names and crowded groups."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tallyspark.llm import simhash_cover, spelling, whitening

SCHEMA = "doc_id long, text string, id string, fp string, word string, n long, anchor int"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {i: i + 32 for i in range(65, 91)}


# ---------------------------------------------------------------- brute force
def plain_fingerprint(text) -> int:
    words = SPACE.findall((text or "").translate(LOW))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(rows) -> list:
    """(fingerprint, component) of each (doc_id, text), by comparing all different fingerprints."""
    fps = [plain_fingerprint(t) for _, t in rows]
    kinds = np.array(sorted(set(fps)), np.uint64)
    name = np.arange(len(kinds))
    for i in range(len(kinds)):
        for j in np.flatnonzero(np.bitwise_count(kinds ^ kinds[i]) <= 2).tolist():
            a, b = sorted((name[i], name[j]))
            name[name == b] = a
    of = dict(zip(kinds.tolist(), name.tolist()))
    least = {}
    for (doc, _), f in zip(rows, fps):
        if doc is not None:
            least[of[f]] = min(doc, least.get(of[f], doc))
    return [(f"{f:016x}", least.get(of[f])) for f in fps]


def plain_spelling(rows) -> dict:
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    by = defaultdict(set)  # words that share a word with one letter taken out
    for w in n:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


# ---------------------------------------------------------------- fixtures
def texts() -> list:
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(150, 400))) for _ in range(25)]
    near = []
    for t in base[:8]:
        w = t.split(" ")
        for _ in range(4):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            near.append(" ".join(v))
    return [None, "", " \n ", "One", "one two", "ONE TWO", *base, *near, base[0].upper(), base[1].replace(" ", "\n\t "),
            " ".join(base) * 2, "y" * 3000, "y" * 3000, "y" * 2999 + "z", "Straße naïveté naïveté naïvete"]


@pytest.fixture(scope="module")
def rows():
    t = texts()
    return [(i, x) for i, x in enumerate(t)] + [(None, t[8]), (None, "alone in the world, without an id"), (3, t[9]), (3, t[9])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 5, 6) for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- simhash
def test_covering_code_reaches_every_point_and_pair():
    code = simhash_cover.blocks()
    rng = np.random.default_rng(1)
    for first, c in code:
        words = rng.integers(0, 1 << c.length, 4000, dtype=np.uint64)
        near = c.nearest(words)
        assert np.bitwise_count(near ^ words).max() == (3 if c.length == 23 else 1)
        assert (c.nearest(near) == near).all()
    fp = rng.integers(0, 2 ** 63, 1000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flip = np.uint64(1) << rng.integers(0, 64, (2, 1000), dtype=np.uint64)
    far = fp ^ flip[0] ^ flip[1]
    of, at = simhash_cover.anchors(fp, code)
    assert np.bitwise_count(fp[of] ^ at).max() <= 7 + simhash_cover.THRESHOLD
    mine = set(zip(of.tolist(), at.tolist()))
    met = np.zeros(1000, bool)
    for i, a in zip(*(x.tolist() for x in simhash_cover.anchors(far, code))):
        met[i] |= (i, a) in mine
    assert met.all()


def test_simhash_matches_brute_force(docs, rows, empty):
    got = sorted((r["doc_id"] is None, r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_cover.near_duplicates(docs).collect()
                 if r["doc_id"] is not None)
    plain = plain_components(rows)
    want = sorted((False, d, f, c) for (d, _), (f, c) in zip(rows, plain) if d is not None)
    assert got == want
    lone = [r for r in simhash_cover.near_duplicates(docs).collect() if r["doc_id"] is None]
    assert sorted((r["fingerprint"], r["component_id"] is None) for r in lone) == sorted((f, c is None) for (d, _), (f, c) in zip(rows, plain) if d is None)
    assert simhash_cover.near_duplicates(empty).count() == 0
    assert len({c for _, c in plain}) < len({f for f, _ in plain})  # some different fingerprints are linked


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = " ".join(texts()[6:12])
    whole = plain_fingerprint(text)
    for size in (1, 7, 100, 1 << 20):
        assert [w for p in simhash_cover.parts(text.encode(), size) for w in p] == text.encode().split()
        monkeypatch.setattr(simhash_cover.parts, "__defaults__", (size,))
        assert simhash_cover.fingerprint(text.encode()) == whole


def test_crowded_anchor_goes_to_the_finer_code(spark):
    """Half of the fingerprints crowd around one point; chains lead out of the crowd."""
    rng = random.Random(2)
    centre = 0x123456789ABCDEF0
    fps = {centre ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for _ in range(600)}
    fps |= {rng.getrandbits(64) for _ in range(300)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    kinds = np.array(signed, np.int64)
    name = np.arange(len(kinds))
    for i in range(len(kinds)):
        for j in np.flatnonzero(np.bitwise_count(kinds.view(np.uint64) ^ kinds.view(np.uint64)[i]) <= 2).tolist():
            a, b = sorted((name[i], name[j]))
            name[name == b] = a
    want = Counter(Counter(name.tolist()).values())
    for most in (8, simhash_cover.MAX_GROUP):
        got = {r["fp"]: r["root"] for r in simhash_cover.link_fingerprints(frame, max_group=most).collect()}
        sizes = Counter(Counter(got.get(f, f) for f in signed).values())
        assert sizes == want


# ---------------------------------------------------------------- whitening
def vectors(n=400, dim=24, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim)) @ (np.diag(0.85 ** np.arange(dim)) @ np.linalg.qr(rng.standard_normal((dim, dim)))[0])
    return [[float(np.float32(v)) for v in row] for row in base]


def plain_whitening(vecs, k=8):
    x = np.floor(1024 * np.array(vecs)).astype(np.int64) + 100000
    n = len(x)
    sums = [int(s) for s in x.sum(axis=0)]
    c = np.array([[(n * int(v) - s) / n for v, s in zip(row, sums)] for row in x])
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    dev = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return n, dev, c @ q / np.sqrt(e), e / np.trace(c.T @ c / n)


def test_whitening_matches_a_dense_solver(spark):
    good = vectors()
    bad = [None, [], [1.0, 2.0], [*good[0][:-1], None], [*good[0][:-1], float("nan")], [*good[0][:-1], float("inf")], [*good[0][:-1], 3e38]]
    data = [(i, v, "x", 1.0) for i, v in enumerate(good)] + [(None, v, "x", 1.0) for v in bad]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, x string, whitened double").repartition(5)
    got = whitening.whiten(frame).collect()
    n, dev, w, share = plain_whitening(good)
    assert len(got) == 8 * n and {r["vec_id"] for r in got} == set(range(n))
    mine = np.zeros((n, 8))
    for r in got:
        mine[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == dev[r["vec_id"]]
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-10
        assert 0 <= r["identity_error"] < 1e-9
    sign = np.sign((mine * w).sum(axis=0))
    assert np.abs(mine - w * sign).max() < 1e-9


def test_whitening_with_repeats_few_rows_and_no_variance(spark):
    kind = "vec_id long, embedding array<double>"
    few = vectors(4, 24)
    got = whitening.whiten(spark.createDataFrame([(7, v) for v in few + few], kind)).collect()
    assert len(got) == 8 * 3  # four different points span three directions
    assert max(r["identity_error"] for r in got) < 1e-6
    assert whitening.whiten(spark.createDataFrame([(1, [2.0, 3.0])] * 3, kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0


@pytest.mark.parametrize("spectrum", [0.7 ** np.arange(64.0), 1 + 0.02 * np.random.default_rng(1).random(64),
                                      1 / (1 + np.arange(200.0)), np.r_[np.ones(12) * 7, np.ones(38)], np.r_[5.0, 3, 1, np.zeros(37)]])
def test_jacobi_davidson_reaches_double_precision(spectrum):
    d = len(spectrum)
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((d, d)))[0]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    e, u = whitening.leading_pairs(lambda b: a @ b, d, 8, float(np.trace(a)))
    true = np.sort(spectrum[spectrum > 0])[::-1][:8]
    assert len(e) == len(true) and np.abs(e - true).max() < 1e-13 * true[0]
    assert np.linalg.norm(a @ u - u * e) < 2e-14 * true[0] * np.sqrt(d) and np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13


def test_deviation_beyond_a_long_is_null():
    x = np.array([[1 << 40, 0], [1, 2]], np.int64)
    sums = [int(x[:, 0].sum()), 2]
    n = 1 << 20
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening.exact_deviation(x, n, sums) == [w if w < 1 << 63 else None for w in want]


# ---------------------------------------------------------------- spelling
def as_dict(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def noisy(seed=6, count=4000):
    """Words with misspellings of misspellings, rarer by ten at each step."""
    rng = random.Random(seed)
    stems = ["government", "separated", "réponses", "straßenbähn", "accommodate", "aaaaaaaa", "aaaaaaab"]
    out = []
    for _ in range(count):
        w = rng.choice(stems)
        for _ in range(3):
            if rng.random() < 0.08:
                i = rng.randrange(len(w))
                w = w[:i] + rng.choice(["", "a", "é", w[i] * 2]) + w[i + 1:]
        out.append(w)
    return [" ".join(out[i:i + 50]) + "." for i in range(0, len(out), 50)]


def test_spelling_matches_brute_force(spark, docs, rows, empty):
    assert as_dict(spelling.spelling_groups(docs)) == plain_spelling(rows)
    more = [*rows, *[(100 + i, t) for i, t in enumerate(noisy())]]
    frame = spark.createDataFrame(more, "doc_id long, text string").repartition(4)
    want = plain_spelling(more)
    assert any(root != form and form is not None for form, root, *_ in want.values())  # chains of forms
    assert as_dict(spelling.spelling_groups(frame)) == want
    assert as_dict(spelling.spelling_groups(frame, max_group=5)) == want  # groups halved again and again
    assert spelling.spelling_groups(empty).count() == 0


@pytest.mark.parametrize("letters,long", [("ab", 256), ("abcdefé", 256), ("ab", 9)])
def test_sorted_list_search_finds_every_near_pair_once(letters, long, monkeypatch):
    monkeypatch.setattr(spelling, "LONG", long)
    rng = random.Random(len(letters) + long)
    words = set()
    for _ in range(80):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(7, 12)))
        for _ in range(4):
            words.add(w)
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice([*letters, ""]) + w[i + rng.randint(0, 1):]
            if len(w) < 7:
                break
    words = sorted(words)
    edits = {w: {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
             | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters} for w in words}
    want = sorted((a, b) for a in words for b in words if a != b and b in edits[a])
    for halvings in range(4):
        dealt = []
        for w in words:
            for short in {len(w), len(w) - 1} - set(range(7)):
                spans = [(0, short // 2), (short // 2, short + 1)]
                for _ in range(halvings):
                    spans = [s for lo, hi in spans for s in ([(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)] if hi - lo > 1 else [(lo, hi)])]
                dealt += [(hash((short, lo, hi, w[:lo], w[len(w) - max(short - hi, 0):])), short, lo, hi, w) for lo, hi in spans]
        dealt.sort()
        key, short, lo, hi = (np.array([r[i] for r in dealt]) for i in range(4))
        a, b = spelling.near_in_groups(key, short, lo, hi, [r[4] for r in dealt])
        assert sorted((dealt[x][4], dealt[y][4]) for x, y in zip(a.tolist(), b.tolist())) == want


# ---------------------------------------------------------------- rarity order and skipping of the Jaccard join
def test_solver_skips_by_length_and_derives_answers():
    from tallyspark.llm.jaccard_join import Solver
    rng = np.random.default_rng(8)
    base = [np.unique(rng.integers(0, 1 << 60, rng.integers(20, 200), dtype=np.uint64)) for _ in range(12)]
    sets = []
    for b in base:
        for _ in range(6):
            keep = b[rng.random(len(b)) > 0.03]
            sets.append(np.unique(np.append(keep, rng.integers(0, 1 << 60, rng.integers(0, 4), dtype=np.uint64))))
    sets.sort(key=len)
    size = np.array([len(s) for s in sets])
    whole = [set(s.tolist()) for s in sets]
    want = np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(whole[i] & whole[j]) >= 90 * len(whole[i] | whole[j]):
                a, b = sorted((want[i], want[j]))
                want[want == b] = a
    solver = Solver(size, np.zeros(len(sets), np.int64), sets, 90)
    name = solver.connect()
    assert len({(a, b) for a, b in zip(name.tolist(), want.tolist())}) == len(set(want.tolist())) == len(set(name.tolist()))
    assert solver.skipped > len(sets) and solver.derived > len(sets) // 4
    for a in (0, 7, 30):  # derived overlaps are the overlaps
        assert solver.overlaps(a).tolist() == [len(whole[a] & w) for w in whole]


def test_rarity_order_is_exact_in_every_block(spark, monkeypatch):
    """A passage that most texts share never makes a list while the texts have shingles of their own."""
    from tallyspark.llm import jaccard_join
    rng = random.Random(4)
    passage = " ".join(f"shared{i}" for i in range(40))
    texts = [" ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(60)) + " " + passage for _ in range(300)]
    copies = [t.replace("shared7", "changed", 1) for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts + copies)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard_join, "PACK_BYTES", 1 << 12)
    entries = jaccard_join.list_entries(docs, "text", 3, 80).collect()
    lists = Counter(r["token"] for r in entries)
    assert max(lists.values()) == 2 and len({(r["s1"], r["s2"]) for r in entries}) == 40
    got = Counter(r["component_id"] for r in jaccard_join.component_ids(docs, percent=80).collect())
    assert sorted(got.values()) == [1] * 280 + [2] * 20


def test_sparse_counts_come_back():
    from tallyspark.llm.kn_quality import by_shard, from_sparse, sparse
    rng = np.random.default_rng(1)
    for n in (0, 1, 8, 1001):
        for top in (2, 300, 1 << 40):
            counts = rng.integers(0, top, n)
            counts[rng.random(n) < 0.5] = 0
            got, used = from_sparse(sparse(counts) + b"rest")
            assert (got == counts).all() and used == len(sparse(counts))
    keys = np.sort(rng.integers(0, 1 << 63, 50, dtype=np.uint64))
    assert [k for s, i, j in by_shard(keys, 10) for k in keys[i:j].tolist()] == keys.tolist()
    assert all((keys[i:j] >> np.uint64(54) == s).all() for s, i, j in by_shard(keys, 10)) and by_shard(keys[:0], 10) == []


# ---------------------------------------------------------------- the pipeline's stages row by row
def test_pipeline_stages_against_brute_force(spark, tmp_path):
    """Each stage after the classifier on all that the one before kept: near copies, benchmark windows, ids.  (The
    classifier's verdict is a trained model's: without trusted texts it keeps everything.)"""
    import hashlib

    import public_tokenizers
    import tiktoken.load
    import tiktoken

    import corpus_pipeline
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    base = [[word() for _ in range(rng.randint(40, 90))] for _ in range(30)]
    items = [[word() for _ in range(14)] for _ in range(4)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(12):  # near copies: two changed words of many; and one too far
        w = list(base[i])
        for _ in range(1 if i % 2 else 12):
            w[rng.randrange(len(w))] = word()
        rows.append((100 + i, " ".join(w)))
    rows += [(200 + i, " ".join(base[20 + i] + item + base[5])) for i, item in enumerate(items)]
    rows += [(300, None), (301, ""), (302, "short text"), (303, "short text"), (None, "short text"), (304, "SHORT text")]
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(f"b{i}", " ".join(w)) for i, w in enumerate(items)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf = str(tmp_path)
    cols = ("doc_id", "text", "lang", "source", "n_chars")

    def as_rows(df):
        return Counter((r["doc_id"], r["text"]) for r in df.collect())

    first = corpus_pipeline.quality(spark, frame, sf)
    assert as_rows(first) == Counter(rows)
    # near copies: components of five-word sets similar by 0.8, the least id of each stays
    def shingles(t):
        w = SPACE.findall((t or "").translate(LOW))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    keyed = [(d, t, shingles(t)) for d, t in rows if d is not None]
    name = list(range(len(keyed)))
    for i in range(len(keyed)):
        for j in range(i):
            a, b = keyed[i][2], keyed[j][2]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = name[i], name[j]
                name = [min(x, y) if n in (x, y) else n for n in name]
    least = {n: min(keyed[i][0] for i in range(len(keyed)) if name[i] == n) for n in name}
    kept = Counter((d, t) for (d, t, _), n in zip(keyed, name) if least[n] == d) + Counter((d, t) for d, t in rows if d is None)
    second = corpus_pipeline.near_copies(spark, first, sf)
    assert as_rows(second) == kept and sum(kept.values()) < len(rows) - 4
    # decontamination: no ten consecutive words of an item
    alnum = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {tuple(w[i:i + 10]) for w in items for i in range(len(w) - 9)}

    def clean(t):
        w = alnum.findall((t or "").translate(LOW))
        return not any(tuple(w[i:i + 10]) in windows for i in range(len(w) - 9))
    third = corpus_pipeline.decontaminated(spark, second, sf)
    want = Counter({k: n for k, n in kept.items() if clean(k[1])})
    assert as_rows(third) == want and sum(want.values()) == sum(kept.values()) - 4
    fourth = corpus_pipeline.without_secrets(spark, third, sf)
    assert as_rows(fourth) == want and list(fourth.columns) == list(cols)  # no text holds a secret
    ranks = tiktoken.load.load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("b", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda t: hashlib.sha256(np.array(library.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest()
    got = Counter((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.encoded(spark, fourth, sf).collect())
    assert got == Counter({(d, sha(t)): n for (d, t), n in want.items()})
