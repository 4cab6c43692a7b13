"""Hard negatives for contrastive training: rows of another label that score close below a positive.

Scores are exact integer products of many candidates at a time: their components, shifted to start at 0, lie side by side in the
fields of one 64-bit word, so one multiplication per anchor component serves all of them (Kronecker substitution).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.arrow import mapped
from tributary.llm.vectors import integer_vectors, matrix_of
from tributary.session import materialize

#: Anchors that a task holds at a time, and candidates that pass by them in one group at least and at most.
CHUNK, LANE = 8192, (512, 1 << 20)
#: Groups that a table is dealt into, unless its lanes become too short or too long.
SPREAD = 16
#: Candidates that are packed together, and products of words and anchors that are held at a time.
BLOCK, PRODUCTS = 8192, 1 << 18
WORD = 64
#: Candidates in one word where a field needs more than half of 64 bits; such words are Python's integers of any width.
WIDE_FIELDS = 4


class Packed:
    """Rows of integers, packed for products with any of the given anchors."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        wide = rows.astype(object) if _large(rows, anchors) else rows
        self.n, dim = rows.shape
        self.low = wide.min(axis=0) if self.n else np.zeros(dim, wide.dtype)
        biased = wide - self.low
        span = biased.max(axis=0) if self.n else np.zeros(dim, wide.dtype)
        sizes = np.abs(anchors.astype(wide.dtype)) @ span if dim else np.zeros(len(anchors), np.int64)
        self.width = max(1, int(max(sizes, default=0)).bit_length())
        self.kind = np.uint64 if wide.dtype != object and self.width <= WORD // 2 else object
        self.fields = WORD // self.width if self.kind is np.uint64 else WIDE_FIELDS
        words = -(-self.n // self.fields)
        spread = np.zeros((words * self.fields, dim), self.kind)
        spread[: self.n] = biased.astype(self.kind)
        spread = spread.reshape(self.fields, words, dim)  # field f holds rows f * words up to (f + 1) * words
        self.words = np.zeros((words, dim), self.kind)
        for f in range(self.fields):
            self.words += spread[f] << self.kind(f * self.width) if self.kind is np.uint64 else spread[f] * (1 << f * self.width)
        self.words = np.ascontiguousarray(self.words.T)  # a line for each component
        self.span = span

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of every anchor (a line each) with every row; what doesn't fit a long becomes the nearest one that does.

        A field holds the product with the shifted row and, so that none borrows from the next, what negative components can
        take off at most; both are taken back after unpacking.
        """
        m, n = len(anchors), self.n
        if self.kind is object:
            a = anchors.astype(object)
            lift = np.array([sum(int(-x) * int(s) for x, s in zip(row, self.span, strict=True) if x < 0) for row in anchors], object)
            base = np.array([sum(int(x) * int(s) for x, s in zip(row, self.low, strict=True)) for row in anchors], object)
            unit, mask = sum(1 << f * self.width for f in range(self.fields)), (1 << self.width) - 1
            total = (a @ self.words if a.shape[1] else np.zeros((m, self.words.shape[1]), object)) + (lift * unit)[:, None]
            found = np.concatenate([(total >> f * self.width) & mask for f in range(self.fields)], axis=1)[:, :n]
            exact = found - lift[:, None] + base[:, None]
            top = (1 << 63) - 1
            return np.array([[min(max(int(x), -top - 1), top) for x in line] for line in exact], np.int64).reshape(m, n)
        lift = np.maximum(-anchors, 0) @ self.span
        base = anchors @ self.low
        a = anchors.astype(np.uint64)  # negative numbers wrap, and what wraps cancels out
        unit = np.uint64(sum(1 << f * self.width for f in range(self.fields)))
        words = self.words.shape[1]
        total = np.empty((m, words), np.uint64)
        total[:] = (lift.astype(np.uint64) * unit)[:, None]
        part = np.empty_like(total)
        for j in range(anchors.shape[1]):
            np.multiply(a[:, j, None], self.words[j], out=part)
            total += part
        mask = np.uint64((1 << self.width) - 1)
        found = np.empty((m, self.fields * words), np.int64)
        for f in range(self.fields):
            found[:, f * words : (f + 1) * words] = (total >> np.uint64(f * self.width)) & mask
        return found[:, :n] + (base - lift)[:, None]


def _large(rows: np.ndarray, anchors: np.ndarray) -> bool:
    """Whether sums of products may leave 64-bit integers."""
    size = [float(np.abs(x.astype(float)).max(initial=0)) for x in (rows, anchors)]
    return 2 * size[0] * max(size[1], 1) * max(rows.shape[1], 1) >= 2.0**62 or max(size) >= 2.0**61


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores in order, equal ones by smaller id."""
    some = np.arange(len(scores))
    if len(scores) > 4 * k:  # no more than the k-th and its equals can stay
        some = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return some[np.lexsort((ids[some], ~scores[some]))][:k]


class _Best:
    """For each anchor, and each list of it, the first ``k`` candidates so far."""

    def __init__(self, k: int):
        self.k = k
        self.held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def add(self, at: tuple[int, int], scores: np.ndarray, ids: np.ndarray) -> None:
        if at in self.held:
            scores, ids = np.append(self.held[at][0], scores), np.append(self.held[at][1], ids)
        best = first(scores, ids, self.k)
        self.held[at] = scores[best], ids[best]


def _dealt(anchors: DataFrame, rows: DataFrame, keys: list[str], lane_rows: int) -> DataFrame:
    """Groups of anchors and candidates that agree on ``keys``, one behind the other, anchors first.

    Anchors with one key are cut into slices and candidates into lanes, by their row numbers, and each slice meets each lane
    once; a key of any size so makes groups of bounded slices, through which a lane passes in batches.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).join(anchors.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m")), keys)
    lanes, slices = F.ceil(F.col("_n") / lane_rows), F.ceil(F.col("_m") / CHUNK)

    def part(of: Column) -> Column:
        return F.pmod(F.xxhash64("row"), of)

    def every(of: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), of - 1))

    left = anchors.join(sizes, keys).select(*anchors.columns, F.lit(0).alias("side"), part(slices).alias("_slice"), every(lanes).alias("_lane"), lanes.alias("_lanes"))
    right = rows.join(sizes, keys).select(*rows.columns, F.lit(1).alias("side"), part(lanes).alias("_lane"), every(slices).alias("_slice"), lanes.alias("_lanes"))
    both = left.unionByName(right, allowMissingColumns=True)
    tasks = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.xxhash64(*keys, "_slice", "_lane")
    turn = F.pmod(F.hash(*keys) + F.col("_slice") * F.col("_lanes") + F.col("_lane"), F.lit(tasks)).cast("int")
    dealt = both.withColumns({"group": group, "_turn": turn}).repartitionById(tasks, "_turn")
    return dealt.drop("_slice", "_lane", "_lanes", "_turn").sortWithinPartitions("dim", "group", "side")


def _runs(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive rows with equal values in integer columns."""
    columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
    new = np.zeros(batch.num_rows, bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    ends = [*np.flatnonzero(new).tolist(), batch.num_rows]
    for at, to in zip([0, *ends[:-1]], ends, strict=True):
        if to > at:
            yield tuple(int(c[at]) for c in columns), batch.slice(at, to - at)


def _searched(dealt: DataFrame, k: int, pick, row_kind: str) -> DataFrame:
    """(row, list, vec_id, score): what ``pick`` takes from each group for its anchors, ``k`` rows a list at most."""

    def flushed(anchors: list[pa.RecordBatch], best: _Best) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate([a.column("row").to_numpy() for a in anchors])
        lists = sorted(best.held)
        sizes = [len(best.held[x][0]) for x in lists]
        columns = [np.repeat([rows[i] for i, _ in lists], sizes), np.repeat([j for _, j in lists], sizes)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(np.concatenate([best.held[x][1] for x in lists])),
             pa.array(np.concatenate([best.held[x][0] for x in lists]))],
            names=["row", "list", "vec_id", "score"],
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, anchors, best, asked = None, [], _Best(k), None
        for batch in batches:
            for (dim, group, side), part in _runs(batch, "dim", "group", "side"):
                if (dim, group) != now:
                    if best.held:
                        yield from flushed(anchors, best)
                    now, anchors, best, asked = (dim, group), [], _Best(k), None
                if side == 0:
                    anchors.append(part)
                    continue
                if not anchors:
                    continue
                if asked is None:
                    table = pa.Table.from_batches(anchors).combine_chunks()
                    asked = (matrix_of(table["vec"]), table)
                vectors, table = asked
                for at in range(0, part.num_rows, BLOCK):
                    some = part.slice(at, BLOCK)
                    packed = Packed(matrix_of(some.column("vec")), vectors)
                    step = max(1, PRODUCTS // max(packed.words.shape[1], 1))
                    for first_anchor in range(0, len(vectors), step):
                        scores = packed.scores(vectors[first_anchor : first_anchor + step])
                        pick(best, table, first_anchor, scores, some)
        if best.held:
            yield from flushed(anchors, best)

    return mapped(dealt, search, f"row long, list int, vec_id {row_kind}, score long")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), negatives of each anchor and positive in order.

    Anchors are the rows that ``is_anchor``, a condition on ``vec_id``, holds for. Its positives are the ``positives`` rows of its own
    label with the highest integer inner products of floor(``scale`` * x); for each of them come the first ``negatives`` rows of other
    labels whose score is from ``least`` to ``most`` per cent of the positive's. Equal scores go by smaller id. ``label`` is a
    column of ``rows`` ("label" if not given).

    The anchors meet all rows in blocks, twice: those of their label for the positives, then all of them for the negatives.
    Rows without id, label or whole vector take no part, and vectors of another length than the anchor's don't for that anchor. Rows
    that share an id are rows of their own, as anchors too. An empty table gives no rows; other columns are ignored. A positive
    score of 0 admits scores of 0 alone, one below 0 none.
    """
    kind = dict(rows.dtypes)[id_col]
    label = F.col("label") if label is None else label
    vectors = integer_vectors(rows, vector_col, scale, vec_id=F.col(id_col), label=label.cast("long"))
    anchors = vectors.where(is_anchor)
    lane_rows = min(max(vectors.count() // SPREAD, LANE[0]), LANE[1])

    def nearest(best: _Best, table: pa.Table, start: int, scores: np.ndarray, some: pa.RecordBatch) -> None:
        own, labels = table["row"].to_numpy(), table["label"].to_numpy()
        ids, numbers, theirs = (some.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "row", "label"))
        for i, line in enumerate(scores, start):
            fit = np.flatnonzero((theirs == labels[i]) & (numbers != own[i]))
            if len(fit):
                best.add((i, 0), line[fit], ids[fit])

    close = _searched(_dealt(anchors, vectors, ["dim", "label"], lane_rows), positives, nearest, kind)
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    close = close.withColumn("list", F.row_number().over(order) - 1).where(F.col("list") < positives)
    # at most ``positives`` entries a list
    lists = close.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("list", "vec_id", "score"))).alias("close"))
    asked = materialize(anchors.join(lists, "row").withColumn("wanted", F.col("close.score")), "anchors")

    def between(best: _Best, table: pa.Table, start: int, scores: np.ndarray, some: pa.RecordBatch) -> None:
        labels, wanted = table["label"].to_numpy(), table["wanted"]
        ids, theirs = (some.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        for i, line in enumerate(scores, start):
            bounds = [(-(-least * p // 100), most * p // 100) for p in wanted[i].as_py()]
            bounds = [(max(lo, -(1 << 63)), min(hi, (1 << 63) - 1)) for lo, hi in bounds]
            fit = np.flatnonzero((line >= min(lo for lo, _ in bounds)) & (line <= max(hi for _, hi in bounds)) & (theirs != labels[i]))
            if not len(fit):
                continue
            fit = fit[np.lexsort((ids[fit], ~line[fit]))]
            down = ~line[fit]
            for j, (lo, hi) in enumerate(bounds):
                begin, end = np.searchsorted(down, ~hi, "left"), np.searchsorted(down, ~lo, "right")
                took = fit[begin : min(end, begin + negatives)]
                if len(took):
                    best.add((i, j), line[took], ids[took])

    found = _searched(_dealt(asked.drop("close"), vectors, ["dim"], lane_rows), negatives, between, kind)
    order = Window.partitionBy("row", "list").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = asked.select("row", F.col("vec_id").alias("anchor_id"), F.posexplode("close").alias("list", "one"))
    return ranked.join(named, ["row", "list"]).select(
        "anchor_id", F.col("one.vec_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("one.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
