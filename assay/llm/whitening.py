"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The distinct integer vectors (the fit list) are packed into binary blocks on
the shared folder.  With A the fit list centred on its mean, one row per
vector, the bidiagonalisation alternates two distributed products over the
blocks, A v and the transposed one with u.  The right vectors v live on the
driver (one number per dimension).  A left vector u has one number per row of
the fit list and is never gathered: every u_j equals A t_j for a short t_j, so
a task computes its rows' part of it anew from t_j, and a lost task is only
computed again.  Both families are orthogonalised in full, twice: the right
ones on the driver, the left ones by the coefficients that the two passes of a
step bring back.  The singular values and right vectors of the small
bidiagonal matrix give deviations and components.

Every pass sends one short vector per task to the driver (beyond
``GATHERED`` tasks they are first added up in groups).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import materialize

#: Vectors in a block, and tasks whose partial vectors go to the driver as they are.
BLOCK_ROWS = 4096
GATHERED = 256
#: |64 c| is held within this bound, so that sums over a block fit in a long.
LARGEST = 1 << 40
#: A singular value below this share of the largest is none: rounding hides it.
RANK_SHARE = 1e-10
#: A component has converged when its residual is below this share of the largest singular value.
CONVERGED = 1e-15

FIT_SCHEMA = "rows int, x binary"
WHITE_SCHEMA = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """What is fitted: ``n`` distinct vectors, their sums per dimension (exact), the components (one
    row each), their eigenvalues, the covariance's trace, and the largest entry by which the whitened
    fit list's covariance differs from the identity."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """``id, x``: rows whose vector is neither null nor holds nulls or non-finite entries, each entry c
    as the long floor(scale * c) + offset (beyond 2**40, c's part is held at 2**40)."""
    c = F.col("_vec").cast("array<double>")
    clean = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(math.inf)))
    held = lambda v: F.greatest(F.least(F.lit(float(scale)) * v, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("_vec")).where(F.col("_vec").isNotNull() & clean)
            .select("id", F.transform(c, lambda v: F.floor(held(v)).cast("long") + F.lit(offset).cast("long")).alias("x")))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_blocks(vectors: DataFrame) -> DataFrame:
    """The distinct vectors of ``vectors`` (``x``, all of one length) in blocks of little-endian longs."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x")).astype("<i8")
            for a in range(0, len(x), BLOCK_ROWS):
                part = x[a:a + BLOCK_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["rows", "x"])

    return materialize(vectors.select("x").distinct().mapInArrow(run, FIT_SCHEMA), "fit-list")


def _summed(blocks: DataFrame, part, length: int) -> np.ndarray:
    """The sum over all blocks of ``part(x)``, a vector of ``length`` doubles (x: the block's longs)."""
    def run(batches):
        total = np.zeros(length)
        for batch in batches:
            for rows, data in zip(batch.column("rows").to_pylist(), batch.column("x").to_pylist()):
                total += part(np.frombuffer(data, "<i8").reshape(rows, -1))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    partial = blocks.mapInArrow(run, "s binary")
    if len(blocks.inputFiles()) > GATHERED:
        def add(table: pa.Table) -> pa.Table:
            return pa.table({"s": pa.array([sum(np.frombuffer(b) for b in table.column("s").to_pylist()).tobytes()], pa.binary())})

        partial = (partial.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(GATHERED))).groupBy("g").applyInArrow(add, "s binary"))
    return np.sum([np.zeros(length), *[np.frombuffer(r.s) for r in partial.collect()]], axis=0)


def _exact_sums(blocks: DataFrame) -> tuple[int, tuple[int, ...], int]:
    """Vectors, their sums per dimension (Python integers) and the largest size of an entry."""
    def run(batches):
        for batch in batches:
            for rows, data in zip(batch.column("rows").to_pylist(), batch.column("x").to_pylist()):
                x = np.frombuffer(data, "<i8").reshape(rows, -1)
                d = x.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(x.sum(axis=0)), pa.array(np.abs(x).max(axis=0)),
                                                  pa.array(np.full(d, rows, dtype=np.int64))], ["j", "s", "most", "rows"])

    per = blocks.mapInArrow(run, "j int, s long, most long, rows long").groupBy("j").agg(
        F.sum(F.col("s").cast("decimal(19,0)")).alias("s"), F.max("most").alias("most"), F.sum("rows").alias("n"))
    found = sorted(per.collect(), key=lambda r: r.j)
    return (found[0].n, tuple(int(r.s) for r in found), max(r.most for r in found)) if found else (0, (), 0)


def _centred(x: np.ndarray, n: int, sums, exact: bool) -> np.ndarray:
    """x minus the mean: n x - S is exact, so only the division rounds."""
    if exact:
        return (n * x - np.array(sums, dtype=np.int64)) / n
    return ((n * x.astype(object) - np.array(sums, dtype=object)) / n).astype(float)


def fit(vectors: DataFrame, components: int = 16) -> Whitening | None:
    """Fit on the distinct vectors of ``vectors`` (``x`` longs, all of one length); None without rows.
    Components are those of the largest eigenvalues, at most ``components``, none that is zero."""
    blocks = fit_blocks(vectors)
    n, sums, most = _exact_sums(blocks)
    if not n:
        return None
    d, exact = len(sums), n * most < 1 << 61

    def centred(x):
        return _centred(x, n, sums, exact)

    trace = float(_summed(blocks, lambda x: np.array([np.square(centred(x)).sum()]), 1)[0])
    right, singular = _bidiagonal(blocks, centred, d, min(d, n - 1), components, math.sqrt(trace))
    keep = singular > RANK_SHARE * (singular[0] if len(singular) else 1.0)
    right, singular = right[keep][:components], singular[keep][:components]
    eigenvalues = np.square(singular) / n

    def moments(x):
        w = centred(x) @ right.T / np.sqrt(eigenvalues)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    k = len(eigenvalues)
    error = 0.0
    if k:
        found = _summed(blocks, moments, k + k * k) / n
        covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
        error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, sums, right, eigenvalues, trace / n, error)


def _bidiagonal(blocks: DataFrame, centred, d: int, rank: int, wanted: int, norm: float):
    """Right singular vectors (rows) and singular values (falling) of A, the centred fit list, by
    bidiagonalisation: A V = U B with B upper bidiagonal and u_j = A t_j.

    It ends when the wanted triplets have converged or all ``rank`` possible steps are made.  A step
    whose new vector vanishes has closed an invariant space (equal singular values, a rank below the
    dimension): the next right vector is then drawn orthogonal to all before it.
    """
    rng = np.random.default_rng(7)
    V, T, G = np.zeros((0, d)), np.zeros((0, d)), np.zeros((0, d))  # G: A'u per left vector
    alphas, betas = [], []
    tiny = 1e-13 * norm
    if norm == 0.0 or rank <= 0:
        return V, np.zeros(0)

    def orthogonal(w):
        for _ in range(2):
            w = w - V.T @ (V @ w)
        return w

    def drawn():
        w = orthogonal(rng.standard_normal(d))
        return w / np.linalg.norm(w)

    v = drawn()
    while True:
        j = len(V)
        V = np.vstack([V, v])
        done = T

        def product(x, v=v, done=done):  # A v and what it shares with the left vectors so far
            a = centred(x)
            u = a @ v
            return np.concatenate([(a @ done.T).T @ u, [u @ u]])

        found = _summed(blocks, product, j + 1)
        t = v - found[:j] @ T

        def transposed(x, t=t, done=done):  # u = A t: its share in the left vectors, its square, A'u
            a = centred(x)
            u = a @ t
            return np.concatenate([(a @ done.T).T @ u, [u @ u], a.T @ u])

        again = _summed(blocks, transposed, j + 1 + d)
        t, w = t - again[:j] @ T, again[j + 1:] - again[:j] @ G
        alpha = math.sqrt(max(0.0, again[j] - again[:j] @ again[:j]))
        if alpha > tiny:
            t, w = t / alpha, w / alpha
        else:
            alpha, t, w = 0.0, np.zeros(d), np.zeros(d)
        T, G = np.vstack([T, t]), np.vstack([G, w])
        alphas.append(alpha)
        w = orthogonal(w)
        beta = float(np.linalg.norm(w))
        B = np.diag(alphas) + np.diag(betas, 1)
        P, singular, Qt = np.linalg.svd(B)
        steps = len(V)
        ended = steps >= d or (steps >= rank and beta <= tiny)
        settled = steps >= wanted and (beta * np.abs(P[-1, :wanted]) <= CONVERGED * singular[0]).all()
        if ended or (settled and beta > tiny):
            return Qt @ V, singular
        if beta > tiny:
            betas.append(beta)
            v = w / beta
        else:
            betas.append(0.0)
            v = drawn()


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """Per row of ``rows`` (``id, x``) and component: ``id``, ``component`` (from 1), ``n``, ``deviation``
    (the sum over dimensions of (n x - S) squared, exact; null beyond a long), ``whitened``,
    ``explained`` (the component's share of the variance) and ``identity_error``."""
    if model is None or not len(model.eigenvalues):
        return rows.sparkSession.createDataFrame([], WHITE_SCHEMA)
    n, sums, k = model.n, model.sums, len(model.eigenvalues)
    onto = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    explained = model.eigenvalues / model.trace

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                x = _matrix(part.column("x"))
                exact = n * int(np.abs(x).max(initial=0)) < 1 << 61
                away = n * x - np.array(sums, dtype=np.int64) if exact else n * x.astype(object) - np.array(sums, dtype=object)
                if not exact or int(np.abs(away).max(initial=0)) ** 2 * max(1, x.shape[1]) >= 1 << 63:
                    squares = [sum(int(v) ** 2 for v in row) for row in away]
                    deviation = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
                else:
                    deviation = pa.array(np.square(away).sum(axis=1))
                white = (away / n).astype(float) @ onto
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n)),
                     deviation.take(each), pa.array(white.ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, model.identity_error))], WHITE_NAMES)

    return rows.select("id", "x").mapInArrow(run, WHITE_SCHEMA)


WHITE_NAMES = [c.split()[0] for c in WHITE_SCHEMA.split(", ")]


def whiten_embeddings(df: DataFrame, id_col: str, vec_col: str, components: int = 16) -> DataFrame:
    """The rows of ``df`` that hold whole finite vectors, whitened on the distinct vectors among them.

    Edge cases: rows with a null vector, a null or a non-finite entry are left out; null ids stay null;
    repeated rows are each returned but fitted once; vectors of several lengths are fitted apart, each
    length on its own; an empty table, empty vectors or a single distinct vector have no components,
    so they give no rows; a dimension without spread adds no component, and of equal eigenvalues
    any orthonormal choice is given.  Other columns do not matter, whatever their names.
    """
    rows = materialize(integer_vectors(df, id_col, vec_col), "vectors")
    lengths = sorted(r.d for r in rows.select(F.size("x").alias("d")).distinct().collect() if r.d)
    out = rows.sparkSession.createDataFrame([], WHITE_SCHEMA)
    for d in lengths:
        own = rows.where(F.size("x") == d)
        found = whiten(own, fit(own, components))
        out = found if len(lengths) == 1 else out.unionByName(found)
    return out
