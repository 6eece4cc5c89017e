"""Operator 12: whitening of embeddings by Jacobi-Davidson.

The leading eigenvectors of the covariance V of integer vectors x, without V:
the rows stay in Spark, and a pass over them gives V U = sum c (c' U) / n for a
block U of a few columns, c = x - S/n centred before it is multiplied.

The driver holds a subspace of at most ``MAX_SUBSPACE`` columns, each as long as
a vector.  Rayleigh-Ritz on it gives approximate pairs; a pair whose residual has
reached double precision is locked.  For the others the projected correction
equations (I - QQ')(V - e I)(I - QQ') t = -r, Q being the locked vectors and the
pair's own, are solved by a few steps of MINRES; the equations of all open pairs
go on in step, so that one pass over the data serves them all.  The corrections
widen the subspace; a full one is cut back to its leading Ritz vectors.

Defined results.  Rows are left out where the vector is null, holds a null, a
non-finite entry or one with no exact integer (1024 |c| of 2**53 or more), is
empty, or isn't of the most frequent length (ties: the longer).  Null and repeated
ids are rows like others.  Components whose eigenvalue can't be told from zero
are left out, so there can be fewer than asked for; a table without rows, or of
equal vectors, gives none.  Where eigenvalues are equal any orthonormal basis of
their space is an answer.  A component's sign makes its largest entry positive.
``deviation`` is null where it doesn't fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_shards, save, tidy

SCALE, SHIFT = 1024, 100000
COMPONENTS = 8
START, MAX_SUBSPACE = 24, 96
INNER_STEPS = 4
MAX_OUTER = 80
EPS = float(np.finfo(np.float64).eps)
#: Sums of a pass are added up by this many tasks before they go to the driver.
SUM_TASKS = 16


# ---------------------------------------------------------------- vectors
def whole_numbers(docs: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, x) of the rows whose vector has only finite entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = b.column(1)
            size = pc.fill_null(pc.list_value_length(vec), 0).to_numpy().astype(np.int64)
            c = vec.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)  # nulls come as nan
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(SCALE * c)
                bad = ~(np.abs(x) < 2.0 ** 53)
            seen = np.concatenate([[0], np.cumsum(bad)])
            end = np.cumsum(size)
            keep = (size > 0) & (seen[end] == seen[end - size])
            take = np.repeat(keep, size)
            cut = np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(x[take].astype(np.int64) + SHIFT))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), pa.array(size[keep].astype(np.int32)), lists], names=["id", "dim", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, vector_col).mapInArrow(tidy(run), f"id {kind}, dim int, x array<long>")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


class Rows:
    """The fit list: the rows of one length, their number and their exact sums."""

    def __init__(self, vectors: DataFrame, dim: int):
        self.frame, self.dim = vectors.select("id", "x"), dim
        dim_ = dim

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, high, low = 0, np.zeros(dim_, np.int64), np.zeros(dim_, np.int64)
            for b in batches:
                x = matrix(b.column(0), dim_)
                n += len(x)
                high += (x >> 26).sum(axis=0)
                low += (x & ((1 << 26) - 1)).sum(axis=0)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(range(dim_), pa.int32()), pa.array([n] * dim_, pa.int64()), pa.array(high), pa.array(low)],
                                                 names=["j", "n", "high", "low"])

        sums = (self.frame.select("x").mapInArrow(add, "j int, n long, high long, low long").groupBy("j")
                .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect())  # dim rows
        self.n = sums[0]["n"] if sums else 0
        self.sums = [0] * dim
        for r in sums:
            self.sums[r["j"]] = (r["high"] << 26) + r["low"]
        # the mean as a whole part and a rest below 1: x - whole is exact
        self.whole = np.array([s // self.n for s in self.sums], np.int64) if self.n else np.zeros(dim, np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums]) if self.n else np.zeros(dim)
        self.parts = self.frame.rdd.getNumPartitions()

    def centred(self) -> Callable[[pa.Array], np.ndarray]:
        dim, whole, rest = self.dim, self.whole, self.rest
        return lambda column: (matrix(column, dim) - whole).astype(np.float64) - rest

    def sum_over(self, of_chunk: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``of_chunk(c)``, an array whose size doesn't depend on the rows, over chunks of centred rows."""
        centred = self.centred()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                if b.num_rows:
                    got = of_chunk(centred(b.column(0)))
                    total = got if total is None else total + got
            if total is not None:
                slot = int.from_bytes(np.random.default_rng().bytes(4), "little") % SUM_TASKS
                yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.astype(np.float64).tobytes()], pa.binary())], names=["slot", "y"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                for y in b.column(1):
                    got = np.frombuffer(y.as_py())
                    total = got if total is None else total + got
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "y"])

        made = self.frame.select("x").mapInArrow(run, "slot int, y binary")
        if self.parts > 4 * SUM_TASKS:
            made = made.repartition(SUM_TASKS, "slot").mapInArrow(add, "slot int, y binary")
        # as many small arrays as SUM_TASKS, four times as many at most
        return np.sum([np.frombuffer(r["y"]) for r in made.collect()], axis=0)

    def product(self, u: np.ndarray) -> np.ndarray:
        """V u for a block of columns."""
        return self.sum_over(lambda c: (c.T @ (c @ u)).ravel()).reshape(u.shape) / self.n

    def trace(self) -> float:
        return float(self.sum_over(lambda c: np.array([np.sum(c * c)]))[0]) / self.n


# ---------------------------------------------------------------- Jacobi-Davidson
def orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Columns of ``new`` orthonormal to the bases and to one another; dependent ones are left out."""
    kept: list[np.ndarray] = []
    for v in new.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            for q in bases:
                v = v - q @ (q.T @ v)
            for w in kept:
                v = v - w * (w @ v)
            left = np.linalg.norm(v)
            if left < 1e-8:
                break
            v = v / left
            if left > 0.5:
                kept.append(v)
                break
    return np.stack(kept, axis=1) if kept else np.zeros((new.shape[0], 0))


def minres_in_step(product: Callable[[np.ndarray], np.ndarray], shift: np.ndarray, project: list[np.ndarray],
                   rhs: np.ndarray, steps: int) -> np.ndarray:
    """MINRES for (I - QiQi')(V - ei I)(I - QiQi') ti = bi, all i in step: one product a step for all."""
    d, m = rhs.shape

    def projected(a: np.ndarray) -> np.ndarray:
        return np.stack([a[:, i] - project[i] @ (project[i].T @ a[:, i]) for i in range(m)], axis=1)

    v_old, v = np.zeros((d, m)), projected(rhs)
    beta = np.linalg.norm(v, axis=0)
    v = v / np.where(beta > 0, beta, 1)
    eta, x = beta.copy(), np.zeros((d, m))
    w, w_old = np.zeros((d, m)), np.zeros((d, m))
    c, c_old, s, s_old = np.ones(m), np.ones(m), np.zeros(m), np.zeros(m)
    beta = np.zeros(m)
    for _ in range(steps):
        av = projected(product(v) - v * shift)
        alpha = np.sum(v * av, axis=0)
        nxt = projected(av - v * alpha - v_old * beta)
        beta_new = np.linalg.norm(nxt, axis=0)
        r1h = c * alpha - c_old * s * beta
        r1 = np.hypot(r1h, beta_new)
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        ok = r1 > 0
        r1 = np.where(ok, r1, 1)
        c_old, c, s_old, s = c, r1h / r1, s, beta_new / r1
        w_new = (v - w * r2 - w_old * r3) / r1 * ok
        x = x + w_new * (c * eta)
        eta = -s * eta
        w_old, w = w, w_new
        v_old, v, beta = v, nxt / np.where(beta_new > 0, beta_new, 1), beta_new
        if not (beta_new > 0).any():
            break
    return x


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of a symmetric non-negative operator, largest first; those that
    can't be told from zero beside ``scale`` (its trace) are left out."""
    wanted = min(wanted, dim)
    rng = np.random.default_rng(12)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = orthonormal(rng.standard_normal((dim, min(dim, START))))
    image = product(basis)
    best: dict[int, list[float]] = {}
    for outer in range(MAX_OUTER):
        h = basis.T @ image
        e, y = np.linalg.eigh((h + h.T) / 2)
        e, y = e[::-1], y[:, ::-1]
        u, au = basis @ y, image @ y
        top = max(e[0] if len(e) else 0.0, values[0] if len(values) else 0.0)
        floor = 4 * EPS * dim * top
        open_ = wanted - locked.shape[1]
        r = au[:, :open_] - u[:, :open_] * e[:open_]
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        tight = 16 * EPS * top * max(1.0, np.sqrt(dim) / 4)
        done = 0
        for i in range(min(open_, len(e))):
            past = best.setdefault(locked.shape[1] + i, [])
            past.append(float(size[i]))
            # rounding of the products themselves can keep a residual above the bound: then it no longer falls
            stuck = len(past) > 4 and min(past[:-3]) <= 2 * min(past[-3:]) and past[-1] <= 64 * tight
            if size[i] > tight and not stuck and basis.shape[1] + locked.shape[1] < dim:
                break
            done += 1
        if done:
            locked, values = np.concatenate([locked, u[:, :done]], axis=1), np.concatenate([values, e[:done]])
            basis, image = u[:, done:], au[:, done:]
            u, au, e, r, size = u[:, done:], au[:, done:], e[done:], r[:, done:], size[done:]
            best.clear()
        open_ = min(wanted - locked.shape[1], len(e))
        if not open_ or (len(values) and e[0] <= floor) or scale <= 0:
            break
        if basis.shape[1] + open_ + locked.shape[1] > MAX_SUBSPACE:
            keep = max(open_ + 8, START)
            basis, image = u[:, :keep], au[:, :keep]
        # pairs that have yet to come down get a correction
        todo = [i for i in range(open_) if size[i] > tight] or [0]
        frames = [np.concatenate([locked, u[:, i:i + 1]], axis=1) for i in todo]
        t = minres_in_step(product, e[todo], frames, -r[:, todo], INNER_STEPS)
        more = orthonormal(t, locked, basis)
        if not more.shape[1]:
            more = orthonormal(rng.standard_normal((dim, 1)), locked, basis)
        basis, image = np.concatenate([basis, more], axis=1), np.concatenate([image, product(more)], axis=1)
    else:
        raise RuntimeError(f"Jacobi-Davidson did not settle in {MAX_OUTER} steps: residuals {size}")
    order = np.argsort(-values, kind="stable")
    values, locked = values[order], locked[:, order]
    told = values > 16 * EPS * dim * scale
    locked, values = locked[:, told], values[told]
    sign = np.sign(locked[np.argmax(np.abs(locked), axis=0), np.arange(locked.shape[1])]) if len(values) else np.ones(0)
    return values, locked * sign


# ---------------------------------------------------------------- the operator
def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list:
    """Sum over dimensions of (n x - S)**2 for each row; null beyond a long."""
    far = max(n * int(np.abs(x).max(initial=0)), max(map(abs, sums)))
    apart = np.abs(n * x.astype(np.float64) - np.array(sums, np.float64))
    if far < 1 << 62 and np.sum(apart * apart, axis=1).max(initial=0) < 2.0 ** 62:
        gap = n * x - np.array(sums, np.int64)
        return (gap * gap).sum(axis=1).tolist()
    out = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) for every row with a
    usable vector and each of the leading components."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    x = save(whole_numbers(vectors, id_col, vector_col), "whiten-vectors")
    lengths = x.groupBy("dim").agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    dim, n = lengths[0]["dim"], lengths[0]["c"]
    chosen = x.where(F.col("dim") == dim)
    # a task for every 16 MB of numbers: a pass is many short tasks otherwise
    fit = Rows(chosen.coalesce(n_shards(8 * dim * n, 16 << 20, 1)), dim)
    trace = fit.trace()
    values, axes = leading_pairs(fit.product, dim, components, trace)
    if not len(values):
        return spark.createDataFrame([], schema)
    scaled = axes / np.sqrt(values)
    k = len(values)
    middle = fit.sum_over(lambda c: (c @ scaled).sum(axis=0)) / n
    spread = fit.sum_over(lambda c: ((c @ scaled - middle).T @ (c @ scaled - middle)).ravel()).reshape(k, k) / n
    error = float(np.abs(spread - np.eye(k)).max())
    explained = values / trace
    centred, sums, n = fit.centred(), fit.sums, fit.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = centred(b.column(1)) @ scaled
            far = exact_deviation(matrix(b.column(1), dim), n, sums)
            rows = np.repeat(np.arange(b.num_rows), k)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                 pa.array(np.full(len(rows), n)), pa.array([v for v in far for _ in range(k)], pa.int64()), pa.array(w.ravel()),
                 pa.array(np.tile(explained, b.num_rows)), pa.array(np.full(len(rows), error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fit.frame.mapInArrow(tidy(run), schema)


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
