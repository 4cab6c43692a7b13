"""Exact nearest rows by inner product, with a table of distances to pivots that bounds every score from above."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.arrow import bounded_sample, mapped
from tributary.llm.vectors import integer_vectors
from tributary.session import materialize

PIVOTS, PIVOT_SAMPLE = 32, 512
#: Candidates and queries that one task holds at a time, at least and at most; in between, as many cells as SPREAD.
CELL, CHUNK, SPREAD = (512, 16_384), (2048, 16_384), 64

#: Bounds that are held at once.
BOUNDS = 1 << 18


def choose_pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension up to ``PIVOTS`` vectors far apart, from a sample of about ``PIVOT_SAMPLE``, and the origin."""
    sample = bounded_sample(vectors, PIVOT_SAMPLE, F.col("vec_id")).orderBy(F.xxhash64("vec_id"), "vec_id").collect()
    out = {}
    for dim in {r["dim"] for r in sample}:
        own = [r["vec"] for r in sample if r["dim"] == dim]
        x = np.array(own, float).reshape(len(own), dim)
        chosen = [np.zeros(dim)]
        far = np.sqrt((x**2).sum(axis=1))
        while len(chosen) <= PIVOTS and far.max() > 0:
            chosen.append(x[far.argmax()])
            far = np.minimum(far, np.sqrt(((x - chosen[-1]) ** 2).sum(axis=1)))
        out[dim] = np.array(chosen)
    return out


def with_distances(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``vectors`` with ``table``, their distances to the pivots of their dimension (to the origin, if there are none)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            tables: list = [None] * len(dims)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = np.array(batch.column("vec").take(pa.array(at)).to_pylist(), float).reshape(len(at), dim)
                marks = pivots.get(dim, np.zeros((1, dim)))
                found = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in marks], axis=1)
                for i, row in zip(at.tolist(), found, strict=True):
                    tables[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tables, pa.list_(pa.float64()))], names=[*batch.schema.names, "table"])

    kind = dict(vectors.dtypes)["vec_id"]
    return mapped(vectors.select("vec_id", "vec", "dim", "row"), measure, f"vec_id {kind}, vec array<bigint>, dim int, row long, table array<double>")


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """Lists of one length as rows."""
    n = len(column)
    flat = pa.concat_arrays(column.chunks).flatten() if column.num_chunks else pa.array([], pa.float64())
    flat = flat.to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(n, len(flat) // n)


def upper_bounds(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For queries (distances to pivots in ``rows``) and candidates (in ``table``) a bound on the inner product from above.

    A candidate is at least as far from a query as their distances to any pivot differ. The first pivot is the origin.
    """
    low = np.zeros((len(rows), len(table)))
    for p in range(table.shape[1]):
        np.maximum(low, np.abs(table[:, p] - rows[:, p, None]), out=low)
    lengths = table[:, 0] ** 2 + rows[:, 0, None] ** 2
    return (lengths - np.maximum(low * (1 - 1e-9) - 1e-6, 0) ** 2) / 2 * (1 + 1e-9) + 1


def best_of_cell(ids: np.ndarray, x: np.ndarray, above: np.ndarray, order: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, object]]:
    """(score, id) of the ``k`` best candidates, equal scores by id.

    Candidates are evaluated in the order of their bounds, until the next bound falls below the k-th score.
    """
    best: list[tuple[int, object]] = []
    at, step = 0, 64
    while at < len(order) and (len(best) < k or above[order[at]] >= -best[-1][0]):
        some = order[at : at + step]
        scores = x[some] @ q
        if len(best) >= k:
            some, scores = some[good := scores >= -best[-1][0]], scores[good]
        if len(some) > 4 * k:  # no more than the k-th of these and its equals can stay
            some, scores = some[good := scores >= np.partition(scores, -k)[-k]], scores[good]
        best = sorted(best + [(-int(s), i) for s, i in zip(scores.tolist(), ids[some].tolist(), strict=True)])[:k]
        at, step = at + step, step * 2
    return [(-s, i) for s, i in best]


def _exact(x: np.ndarray, q: np.ndarray) -> type:
    """A number type that holds all inner products of two integer matrices exactly."""
    size = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(x.shape[1], 1)
    return np.float64 if size < 2**52 else np.int64 if size < 2**62 else object


def top_k(
    rows: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (a condition on ``vec_id``) its ``k`` best other rows.

    Rows that share an id are rows of their own, as queries too.

    Scores are inner products of floor(``scale`` * x); equal scores rank by smaller id; vectors of another length than the
    query's take no part. Candidates are dealt into cells and queries into chunks by hashed ids, and every pair of cell and
    chunk is one bounded group, so no task grows with the table; the best of all cells are merged. Vectors that are null or
    hold a null or non-finite component take no part, an empty table gives no rows, other columns are ignored.
    """
    vectors = integer_vectors(rows, vector_col, scale, vec_id=F.col(id_col))
    indexed = materialize(with_distances(vectors, choose_pivots(vectors)), "pivot-table")
    queries = indexed.where(is_query)
    n, m = indexed.count(), queries.count()
    cells = max(1, math.ceil(n / min(max(n // SPREAD, CELL[0]), CELL[1])))
    chunks = max(1, math.ceil(m / min(max(m // SPREAD, CHUNK[0]), CHUNK[1])))

    def part(of: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(of)).cast("int")

    def every(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    left = indexed.select("*", part(cells, 1).alias("cell"), every(chunks).alias("chunk"))
    right = queries.select("*", part(chunks, 2).alias("chunk"), every(cells).alias("cell"))
    kind = dict(indexed.dtypes)["vec_id"]

    def search(key: tuple, near: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if near.num_rows and asked.num_rows:
            x, q = _matrix(near["vec"], np.int64), _matrix(asked["vec"], np.int64)
            kind = _exact(x, q)
            x, q = x.astype(kind), q.astype(kind)
            table, rows = _matrix(near["table"], np.float64), _matrix(asked["table"], np.float64)
            ids, own = near["vec_id"].to_numpy(), near["row"].to_numpy()
            asked_ids, asked_rows = asked["vec_id"].to_numpy(), asked["row"].to_numpy()
            for first in range(0, len(q), block := max(1, BOUNDS // len(x))):
                above = upper_bounds(table, rows[first : first + block])
                order = np.argsort(-above, axis=1, kind="stable")
                asking = zip(asked_ids[first : first + block].tolist(), asked_rows[first : first + block].tolist(), strict=True)
                for i, (query_id, row) in enumerate(asking):
                    others = order[i][own[order[i]] != row]
                    out += [(row, query_id, one, score) for score, one in best_of_cell(ids, x, above[i], others, q[first + i], k)]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kind = near.schema.field("vec_id").type
        kinds = (pa.int64(), kind, kind, pa.int64())
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(("query", "query_id", "vec_id", "score"), columns, kinds, strict=True)})

    keys = ["dim", "cell", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, f"query long, query_id {kind}, vec_id {kind}, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
