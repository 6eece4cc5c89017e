"""Operator 7: toxicity by gradient-boosted trees with isotonic calibration.

Dense features of a text: densities and counts of a learned lexicon, of learned
word beginnings and of a fixed list of insults, hits near a second-person word,
and rates of capitals, punctuation, digits and obfuscated words.  The lexicons
are words (beginnings of four bytes or more) that are far more often in
toxic than in other training texts; their size is bounded.

Learning uses labelled rows whose crc32(id) mod 5 is not 0, at most
``MAX_TRAIN`` of them (the first by a hash of the id).  Of those, the rows with
remainder 1 are kept from the trees and calibrate their margin by isotonic
regression.  Labels, language, source and id are no features.

Defined results: a null or empty text has all features 0 and gets a score; where
the training rows don't hold both labels and some rows to calibrate by, the
score is the share of label 1 among them (0 without any); a document labelled twice is toxic if any label says so; repeated
rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORD, byte_table, chunks, find_words, hash_spans, save

MAX_TRAIN = 20_000
LEXICON_SIZE = 4096
#: Fixed word lists.
INSULTS = "idiot moron stupid pathetic scum trash loser clown worthless disgusting dumb fool imbecile crap bastard".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split()
NEAR = 5
#: What is written for letters in obfuscated words.
LEET = {ord("0"): ord("o"), ord("1"): ord("i"), ord("3"): ord("e"), ord("4"): ord("a"), ord("5"): ord("s"), ord("7"): ord("t"),
        ord("@"): ord("a"), ord("$"): ord("s"), ord("!"): ord("i")}
FEATURES = ("log_words", "lex_rate", "lex_count", "stem_rate", "stem_count", "insult_rate", "near_you_rate", "capital_rate",
            "shout_rate", "punct_rate", "exclaim_rate", "digit_rate", "obfuscated_rate", "masked_rate")

FOLD, IS_WORD = byte_table(True, ALNUM_WORD)
IS_WORD[[ord("@"), ord("$")]] = True  # parts of masked words
PLAIN = FOLD.copy()
for _a, _b in LEET.items():
    PLAIN[_a] = _b


def word_list(words: list[str]) -> np.ndarray:
    """Sorted hashes of the words."""
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return np.sort(hash_spans(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], ends[:-1]]), ends))


def stems(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...] = (4, 5)) -> list[np.ndarray]:
    """Hashes of the words' beginnings, marked by their size so that they differ from words."""
    return [hash_spans(low, starts, np.minimum(ends, starts + k)) ^ np.uint64(k) for k in sizes]


def count_words(texts: DataFrame) -> DataFrame:
    """(hash, toxic, clean): in how many texts a word or beginning is, by label.
    ``texts``: text, toxic.  Each task sums what it has read before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            got: list[tuple[np.ndarray, np.ndarray]] = []
            for lo, hi, data, offs in chunks(b.column(0)):
                low = FOLD[data]
                starts, ends, bounds = find_words(low, offs, IS_WORD)
                doc = np.repeat(np.arange(lo, hi), np.diff(bounds)).astype(np.int64)
                for h in (hash_spans(low, starts, ends), *stems(low, starts, ends)):
                    order = np.lexsort((doc, h))
                    h, d = h[order], doc[order]
                    if len(h):
                        first = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
                        got.append((h[first], toxic[d[first]]))
            if got:
                h, t = (np.concatenate(x) for x in zip(*got))
                keys, at = np.unique(h, return_inverse=True)
                n = np.bincount(at)
                bad = np.bincount(at, weights=t).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(bad), pa.array(n - bad)],
                                                 names=["hash", "toxic", "clean"])

    return (texts.select("text", F.col("toxic").cast("int")).mapInArrow(run, "hash long, toxic long, clean long")
            .groupBy("hash").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def learn_lexicon(texts: DataFrame, n_toxic: int, n_clean: int, least: int = 5, log_odds: float = 2.5) -> np.ndarray:
    """Sorted hashes of the words and beginnings that speak most for label 1, at most LEXICON_SIZE."""
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    rows = (count_words(texts).where((F.col("toxic") >= least) & (odds > log_odds))
            .orderBy(odds.desc(), "hash").limit(LEXICON_SIZE).collect())
    return np.sort(np.array([r["hash"] for r in rows], np.int64).view(np.uint64))


def _is_in(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def with_features(docs: DataFrame, keep: list[str], text_col: str, lexicon: np.ndarray) -> DataFrame:
    """``keep`` and the FEATURES as double columns."""
    insults, persons = word_list(INSULTS), word_list(SECOND_PERSON)
    schema = T.StructType([*docs.select(*keep).schema.fields, *[T.StructField(f, T.DoubleType()) for f in FEATURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros((len(FEATURES), b.num_rows))
            for lo, hi, data, offs in chunks(b.column(b.num_columns - 1)):
                low = FOLD[data]
                starts, ends, bounds = find_words(low, offs, IS_WORD)
                n_docs = hi - lo
                doc = np.repeat(np.arange(n_docs), np.diff(bounds))
                of_byte = np.repeat(np.arange(n_docs), np.diff(offs))
                h = hash_spans(low, starts, ends)
                lex = _is_in(h, lexicon)
                stem = np.zeros(len(h), bool)
                for s in stems(low, starts, ends):
                    stem |= _is_in(s, lexicon)
                insult = _is_in(h, insults)
                plain = _is_in(hash_spans(PLAIN[data], starts, ends), insults) & ~insult
                # a digit, @ or $ between letters
                letter = (low >= 97) & (low <= 122) | (low >= 128)
                inside = np.zeros(len(low), bool)
                if len(low) > 2:
                    inside[1:-1] = letter[:-2] & letter[2:] & IS_WORD[low[1:-1]] & ~letter[1:-1]
                marks = np.concatenate([[0], np.cumsum(inside)])
                masked = marks[ends] > marks[starts]
                you = np.concatenate([[0], np.cumsum(_is_in(h, persons))])
                first = np.maximum(np.arange(len(h)) - NEAR, bounds[:-1][doc])
                last = np.minimum(np.arange(len(h)) + NEAR + 1, bounds[1:][doc])
                near = (lex | stem | insult | plain) & (you[last] > you[first])
                capital = (data >= 65) & (data <= 90)
                caps = np.concatenate([[0], np.cumsum(capital)])
                shout = (caps[ends] - caps[starts] == ends - starts) & (ends - starts > 1)

                def words(flag):
                    return np.bincount(doc[flag], minlength=n_docs)

                def chars(flag):
                    return np.bincount(of_byte[flag], minlength=n_docs)

                n = np.maximum(1, np.diff(bounds))
                size = np.maximum(1, np.diff(offs))
                punct = (data < 128) & (data > 32) & ~IS_WORD[low]
                out[:, lo:hi] = (
                    np.log1p(np.diff(bounds)), words(lex) / n, words(lex), words(stem) / n, words(stem), words(insult) / n,
                    words(near) / n, chars(capital) / size, words(shout) / n, chars(punct) / size, chars(data == 33) / size,
                    chars((data >= 48) & (data <= 57)) / size, words(plain) / n, words(masked) / n)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *[pa.array(x) for x in out]], names=[*keep, *FEATURES])

    return docs.select(*keep, F.col(text_col).alias("text_to_score")).mapInArrow(run, schema)


def fold_of(column) -> F.Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_train: int = MAX_TRAIN, trees: int = 12, depth: int = 4) -> DataFrame:
    """``id_col``, ``held_out``, the features, and ``score`` for every document."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold_of(id_col) != 0))
             .groupBy(F.col(id_col).alias("train_id")).agg(F.max(label_col).cast("double").alias("label")))
    share = min(1.0, 1.2 * max_train / max(1, known.count()))
    near = known.where(F.pmod(F.xxhash64("train_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = save(near.orderBy(F.xxhash64("train_id"), "train_id").limit(max_train), "toxic-train")
    learn = chosen.where(fold_of("train_id") != 1)  # remainder 1 fits the scale: neither lexicon nor trees see it
    n_of = {r["label"]: r["n"] for r in learn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    texts = docs.join(F.broadcast(learn), docs[id_col] == learn["train_id"]).select(
        docs[text_col].alias("text"), F.col("label").alias("toxic"))  # at most max_train rows are broadcast
    lexicon = learn_lexicon(texts, n_of.get(1.0, 0), n_of.get(0.0, 0))
    rows = save(with_features(docs, [id_col], text_col, lexicon), "toxic-features")
    held = (fold_of(id_col) == 0).alias("held_out")
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    train = save(assemble.transform(rows.join(F.broadcast(chosen), rows[id_col] == chosen["train_id"])
                                    .select(*FEATURES, "label", (fold_of(id_col) == 1).alias("for_scale"))).coalesce(6), "toxic-learn")
    parts = {(r["for_scale"], r["label"]): r["n"] for r in train.groupBy("for_scale", "label").agg(F.count("*").alias("n")).collect()}
    if not ({(False, 0.0), (False, 1.0)} <= set(parts) and any(scale for scale, _ in parts)):
        share = sum(n for (_, label), n in parts.items() if label == 1) / max(1, sum(parts.values()))
        return rows.select(id_col, held, *FEATURES, F.lit(float(share)).alias("score"))
    gbt = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=32, seed=7)
    model = gbt.fit(train.where("not for_scale"))
    margin = vector_to_array("rawPrediction")[1].alias("margin")
    scale = model.transform(train.where("for_scale")).select(margin, "label")
    fit = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(scale)
    return fit.transform(model.transform(assemble.transform(rows)).select(id_col, held, *FEATURES, margin)).select(
        id_col, "held_out", *FEATURES, "score")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    rows = score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
