"""Whitening of embeddings by shifted CholeskyQR: distributed Gram passes, triangular factors on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrow import mapped
from tributary.llm.vectors import integer_vectors, matrix_of
from tributary.session import materialize

#: Gram passes at most, and how near to the identity the last one must come.
PASSES, NEAR = 8, 1e-12
#: Directions whose length stays below this after all passes have no extent.
FLAT = 1e-6
#: Rows that are centred and solved for at a time, and columns that are solved for together.
BLOCK, PANEL = 8192, 16


def solve_right(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """X with X @ ``upper`` = ``rows`` for an upper triangular matrix, panel by panel."""
    out = rows.copy()
    for at in range(0, upper.shape[0], PANEL):
        to = min(at + PANEL, upper.shape[0])
        if at:
            out[:, at:to] -= out[:, :at] @ upper[:at, at:to]
        for j in range(at, to):
            if j > at:
                out[:, j] -= out[:, at:j] @ upper[at:j, j]
            out[:, j] /= upper[j, j]
    return out


def shift_of(gram: np.ndarray, n: int) -> float:
    """What is added to the diagonal so that a Cholesky factor exists whatever the rounding (its trace bounds its norm)."""
    d = len(gram)
    return 11 * (n * d + d * (d + 1)) * np.finfo(float).eps * float(np.trace(gram))


def factor(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper triangular R with RᵀR = ``gram``, or near it: shifted unless the Gram matrix is well conditioned already."""
    if np.linalg.eigvalsh(gram)[0] > 0.5:
        return np.linalg.cholesky(gram).T
    shift, eye = max(shift_of(gram, n), np.finfo(float).tiny), np.eye(len(gram))
    while True:
        try:
            return np.linalg.cholesky(gram + shift * eye).T
        except np.linalg.LinAlgError:
            shift *= 10


@dataclass
class Whitening:
    """What a row is whitened with: x - ``sums`` / ``n``, times a column of ``to`` for each component."""

    n: int
    dim: int
    sums: list[int]
    to: np.ndarray
    explained: np.ndarray
    #: R of each Gram pass, in order.
    factors: list[np.ndarray]

    def centred(self, vectors: np.ndarray) -> np.ndarray:
        return vectors - np.array([s / self.n for s in self.sums])

    def deviations(self, vectors: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)² over the components, exact; None where that doesn't fit a long."""
        top = float(np.abs(vectors.astype(float)).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if top**2 * max(self.dim, 1) < 2.0**62 else object
        away = vectors.astype(kind) * self.n - np.array(self.sums, kind)
        return [x if x < 1 << 63 else None for x in (away**2).sum(axis=1).tolist()]


def _totals(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], size: int) -> np.ndarray:
    """Sums over all tasks of the arrays that ``partial`` makes, one from each; added up by place before they reach the driver."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = partial(batches)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(found.ravel())], names=["at", "part"])

    found = mapped(rows, sent, "at long, part double").groupBy("at").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(size)
    for r in found:
        out[r["at"]] = r["total"]
    return out


def _gram(rows: DataFrame, project: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """YᵀY of the rows Y that ``project`` makes from integer vectors."""

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                y = project(matrix_of(batch.column("vec").slice(at, BLOCK)))
                total = y.T @ y if total is None else total + y.T @ y
        return total

    found = _totals(rows, partial, width * width).reshape(width, width)
    return (found + found.T) / 2


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of the vectors, and exact sums by dimension: those of a task in Python's integers, then as decimals."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = matrix_of(batch.column("vec"))
            n += len(x)
            exact = np.abs(x.astype(float)).max(initial=0) * len(x) < 2.0**62
            here = (x if exact else x.astype(object)).sum(axis=0).astype(object)
            total = here if total is None else total + here
        if n:
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(range(-1, len(total)), pa.int64()), "part": pa.array([str(n), *map(str, total.tolist())], pa.string()),
            })

    found = mapped(rows, partial, "at long, part string").groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["at"]: int(r["s"]) for r in found}
    return by.get(-1, 0), [by[i] for i in range(len(by) - 1)]


def fit(vectors: DataFrame, components: int) -> Whitening | None:
    """The whitening of the distinct vectors of ``vectors`` (``vec``, all of one length); None if they have no extent.

    Every pass computes the Gram matrix of the centred rows after the triangular solves with all earlier factors, in tasks, and
    factors it on the driver, where only matrices of dim x dim ever are. The first ones are shifted, so that nearly dependent columns are
    orthogonalised step by step; passes end when the rows are orthonormal, or after ``PASSES``, when what is still short has no
    extent. The product of the factors is R; its singular values and right vectors are those of the centred rows.
    """
    n, sums = _sums(vectors)
    dim = len(sums)
    if n < 2 or not dim:
        return None
    now = Whitening(n, dim, sums, np.zeros((dim, 0)), np.zeros(0), [])

    def orthogonal(x: np.ndarray) -> np.ndarray:
        y = now.centred(x)
        for r in now.factors:
            y = solve_right(y, r)
        return y

    whole, gram = np.eye(dim), None
    for _ in range(PASSES):
        gram = _gram(vectors, orthogonal, dim)
        if not now.factors and not gram.any():
            return None
        if now.factors and np.abs(gram - np.eye(dim)).max() < NEAR:
            break
        now.factors.append(factor(gram, n))
        whole = now.factors[-1] @ whole
    else:
        gram = _gram(vectors, orthogonal, dim)
    # what the last pass left of the identity; columns without extent stay at 0
    left, turn = np.linalg.eigh(gram)
    last = np.where(left > FLAT, np.sqrt(np.maximum(left, 0)), 0)[:, None] * turn.T
    _, sizes, axes = np.linalg.svd(last @ whole)
    k = min(components, int((sizes > sizes[0] * np.sqrt(np.finfo(float).eps)).sum()))
    variances = sizes**2 / n
    signs = np.sign(axes[np.arange(dim), np.abs(axes).argmax(axis=1)])  # the largest entry of an axis is positive
    axes = axes * signs[:, None]
    now.to = axes[:k].T / np.sqrt(variances[:k])
    now.explained = variances[:k] / variances.sum()
    return now


def commonest_length(vectors: DataFrame) -> DataFrame:
    """The vectors of the commonest length above 0, the shorter of equally common ones."""
    best = vectors.where("dim > 0").groupBy("dim").count().orderBy(F.col("count").desc(), "dim").limit(1)
    return vectors.join(best.select("dim"), "dim", "left_semi")


def whiten(
    rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), ``components`` rows for each row of ``rows``.

    x is floor(``scale`` * c) of each component c; the fit takes every distinct vector once, ``n`` of them. ``whitened`` is the
    centred row on a principal axis, over the root of its variance; ``explained`` that variance's share; ``deviation`` the exact sum
    of (n x - S)², null beyond a long; ``identity_error`` how far the covariance of the whitened fit list is from the identity.

    Rows whose vector is null or holds null or non-finite components are left out, so are those of another length than the
    commonest. Rows with one vector get a result each, a null id stays null. Vectors that extend in fewer directions than
    ``components`` have fewer components; an empty table, or one vector alone, gives no rows. Other columns are ignored.
    """
    kind = dict(rows.dtypes)[id_col]
    key: Column = F.struct(F.col(id_col).alias("id"))
    vectors = commonest_length(integer_vectors(rows, vector_col, scale, key=key))
    distinct = materialize(vectors.select("vec").distinct(), "distinct")
    model = fit(distinct, components)
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k = model.to.shape[1]
    spread = _gram(distinct, lambda x: np.hstack([model.centred(x) @ model.to, np.ones((len(x), 1))]), k + 1)
    mean = spread[-1, :k] / model.n
    error = float(np.abs(spread[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                x = matrix_of(some.column("vec"))
                n = len(x)
                found = model.centred(x) @ model.to
                ids = some.column("key").field("id").take(pa.array(np.repeat(np.arange(n), k)))
                apart = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, model.n)), apart,
                     pa.array(found.ravel()), pa.array(np.tile(model.explained, n)), pa.array(np.full(n * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return mapped(vectors.select("key", "vec"), project, schema)
