"""Hard negatives and whitening against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import negatives, whitening


def whole(v, scale=256):
    """Integer vector, or None for one that takes no part."""
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(scale * float(x)) for x in v]


def mined(rows, is_anchor, positives=5, negatives=10, least=30, most=90):
    good = [(i, label, whole(v)) for i, label, v in rows if i is not None and label is not None and whole(v) is not None]
    out = []
    for a, (i, label, x) in enumerate(good):
        if not is_anchor(i):
            continue
        scores = [(-sum(p * q for p, q in zip(x, y, strict=True)), j, same == label) for c, (j, same, y) in enumerate(good) if c != a and len(y) == len(x)]
        scores.sort()
        for s, j, _ in [t for t in scores if t[2]][:positives]:
            fit = [(-t, k) for t, k, same in scores if not same and least * -s <= 100 * -t <= most * -s][:negatives]
            out += [(i, j, rank, k, -s, t) for rank, (t, k) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1, 1 << 20, 1 << 30, 1 << 45])
def test_packed_products_are_exact(size):
    rng = np.random.default_rng(size)
    for n, m, dim in [(50, 7, 64), (1, 1, 1), (6, 3, 0), (33, 5, 3)]:
        x, a = (rng.integers(-130 * size, 130 * size, (k, dim)) for k in (n, m))
        packed = negatives.Packed(x, a)
        want = [[max(-1 << 63, min((1 << 63) - 1, sum(int(p) * int(q) for p, q in zip(i, j, strict=True)))) for j in x] for i in a]
        assert packed.scores(a).tolist() == want
        assert size > 1 or dim < 64 or packed.fields == 3  # three candidates in a word


@pytest.fixture
def small_groups(monkeypatch):
    monkeypatch.setattr(negatives, "LANE", (16, 16))
    monkeypatch.setattr(negatives, "CHUNK", 4)


def odd_vectors():
    rng = random.Random(6)
    value = lambda: float(np.float32(rng.gauss(0, 0.3)))
    rows = [(k, rng.randrange(3), [value() for _ in range(6)]) for k in range(160)]
    rows += [(200 + k, 1, rows[20][2]) for k in range(40)]  # a group of copies
    rows += [(300, 1, None), (310, None, rows[0][2]), (320, 2, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (330, 0, [float("nan")] * 6), (340, 0, [float("inf")] * 6)]
    rows += [(None, 1, rows[4][2]), (350, 1, [0.5, 0.25]), (351, 1, [0.5, 0.3]), (352, 0, [0.4, 0.1]), (353, 0, [-0.0, -0.0]), (360, 0, []), (361, 1, [])]
    rows += [(370, 0, [0.0] * 6), (371, 0, [0.0] * 6), (10, 2, rows[11][2]), rows[30], rows[30], (380, 2, [3e38] * 6), (381, 2, [3e38] * 6)]
    return rows


def test_hard_negatives_equal_brute_force(spark, small_groups):
    rows = odd_vectors()
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").repartition(4)
    table = table.withColumns({c: F.lit("own") for c in ("row", "score", "dim", "group", "side", "wanted", "list")})
    got = negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, positives=3, negatives=4)
    far = {380, 381}  # their products don't fit a long: here only that nothing fails
    want = [r for r in mined(rows, lambda i: i % 10 == 0, 3, 4) if not far.intersection(r[:2])]
    found = sorted(tuple(r) for r in got.collect())
    assert want and [r for r in found if not far.intersection(r[:2])] == want
    assert not negatives.hard_negatives(table.limit(0), F.col("vec_id") % 10 == 0).count()


def test_a_hot_label_meets_every_row_once(spark, small_groups):
    """Copies under one label are dealt into many groups; every anchor meets each row of its label in one of them."""
    rows = [(k, 0 if k % 3 else 1, [float(k % 5), 1.0]) for k in range(300)]
    table = spark.createDataFrame(rows, "vec_id bigint, label bigint, embedding array<float>")
    vectors = negatives.integer_vectors(table, "embedding", 256, vec_id=F.col("vec_id"), label=F.col("label"))
    anchors = vectors.where("vec_id % 10 = 0")
    dealt = negatives._dealt(anchors, vectors, ["dim", "label"], 16).select("group", "side", "row", "label").collect()
    for label, n in ((0, 200), (1, 100)):
        some = [r for r in dealt if r["label"] == label]
        own = {r["row"] for r in some if r["side"] == 0}
        groups = {g: ({r["row"] for r in some if r["group"] == g and r["side"] == 0}, [r["row"] for r in some if r["group"] == g and r["side"] == 1]) for g in {r["group"] for r in some}}
        assert all(sum(len(c) for a, c in groups.values() if x in a) == n for x in own)
        assert max(len(c) for _, c in groups.values()) < 40
    got = negatives.hard_negatives(table, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == mined(rows, lambda i: i % 10 == 0)


def plain_whitening(vectors):
    x = np.unique(np.array(vectors, np.int64), axis=0)
    mean = x.mean(axis=0)
    v = (x - mean).T @ (x - mean) / len(x)
    e, u = np.linalg.eigh(v)
    return len(x), x.sum(axis=0), mean, e[::-1], u[:, ::-1]


def test_whitening_equals_an_eigendecomposition(spark):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(8, 8)) * np.array([3, 2, 1, 0.6, 0.3, 0.1, 0.05, 0.01])[:, None]
    rows = [(k, [float(np.float32(c)) for c in rng.normal(size=8) @ mix + 0.7]) for k in range(400)]
    rows += [(500 + k, rows[3][1]) for k in range(60)] + [rows[5], (None, rows[6][1]), (600, None), (601, [None] + [0.0] * 7), (602, [float("nan")] * 8), (603, [0.5, 1.0]), (604, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5).withColumns({c: F.lit("own") for c in ("row", "n", "key", "dim", "vec", "component")})
    got = whitening.whiten(table).collect()
    kept = [(i, whole(v)) for i, v in rows if whole(v) and len(v) == 8]
    n, sums, mean, e, u = plain_whitening([v for _, v in kept])
    assert len(got) == 4 * len(kept) and {r["n"] for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for k in range(4):
        side = None
        for i, v in kept:
            for r in by[i, k + 1]:
                want = (np.array(v) - mean) @ u[:, k] / np.sqrt(e[k])
                side = side or np.sign(want * r["whitened"]) or None
                assert abs(side * r["whitened"] - want) < 1e-9
                assert r["deviation"] == sum((n * a - int(s)) ** 2 for a, s in zip(v, sums, strict=True))
                assert abs(r["explained"] / (e[k] / e.sum()) - 1) < 1e-10 and r["identity_error"] < 1e-10


@pytest.mark.parametrize("rows,extent", [
    ([], 0), ([(1, [1.0, 2.0])], 0), ([(1, [1.0, 2.0]), (2, [1.0, 2.0])], 0), ([(1, [1.0, 2.0]), (2, [3.0, 2.0])], 1),
    ([(k, [float(k), float(2 * k), 5.0, float(k % 7)]) for k in range(50)], 2), ([(1, None), (2, [])], 0),
    ([(k, [1e9 + k % 3, 1e9 - k % 5, float(k % 11)]) for k in range(60)], 3),
])
def test_whitening_of_few_directions(spark, rows, extent):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == extent * len(rows)
    if extent:
        table = np.array([[r["whitened"] for r in sorted(got, key=lambda r: r["vec_id"]) if r["component"] == k + 1] for k in range(extent)])
        x = np.array(sorted({tuple(v) for _, v in rows}))
        if len(x) == len(rows):
            assert np.abs(np.cov(table, bias=True) - np.eye(extent)).max() < 1e-6
        assert all(r["identity_error"] < 1e-4 for r in got)


def test_triangular_solves_and_factors():
    rng = np.random.default_rng(1)
    for d in (1, 5, 16, 37):
        r = np.triu(rng.normal(size=(d, d))) + 5 * np.eye(d)
        b = rng.normal(size=(9, d))
        assert np.abs(whitening.solve_right(b, r) @ r - b).max() < 1e-12
    flat = np.ones((4, 4))  # singular: only the shifted matrix has a factor
    r = whitening.factor(flat, 10)
    assert np.abs(r.T @ r - flat).max() < 1e-9 and np.allclose(r, np.triu(r))


def test_deviations_beyond_a_long_are_null(spark):
    model = whitening.Whitening(10, 2, [0, 0], np.zeros((2, 0)), np.zeros(0), [])
    assert model.deviations(np.array([[1 << 40, 0], [3, 4]])) == [None, 2500]
