"""Toxicity by non-negative learning from confirmed toxic examples and unlabelled text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrow import bounded_sample, mapped, slices, texts_of
from tributary.llm.langid import in_fold
from tributary.session import materialize

#: About so many confirmed toxic documents and so many unlabelled ones are learned from.
TOXIC_DOCS, UNLABELLED_DOCS = 4000, 16_000
#: So many features at most, each in so many toxic documents at least and so many times likelier there than in others.
FEATURES, LEAST_DOCS, LEAST_LIFT = 1000, 4, 2
PREFIXES = (3, 4, 5, 6)
THRESHOLD = 0.7
WORD = re.compile(r"\w+")
CACHED_WORDS = 200_000


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, so that inflected forms share what they have in common."""
    return ["=" + word, *["^" + word[:n] for n in PREFIXES if len(word) > n]]


def document_features(text: str) -> set[str]:
    return {f for w in set(WORD.findall(text.lower())) for f in features_of(w)}


@dataclass
class Classifier:
    """Logistic regression on the presence of chosen features."""

    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        self.known: dict[str, tuple[str, ...]] = {}

    def logit(self, text: str) -> float:
        present: set[str] = set()
        for word in set(WORD.findall(text.lower())):
            found = self.known.get(word)
            if found is None:
                found = tuple(f for f in features_of(word) if f in self.weights)
                if len(self.known) >= CACHED_WORDS:
                    self.known.clear()
                self.known[word] = found
            if found:
                present.update(found)
        # in a fixed order: a float sum depends on it
        return self.bias + sum(self.weights[f] for f in sorted(present))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(text), -30, 30))))


def fit_nonnegative(
    rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, n_features: int, prior: float, steps: int = 400, rate: float = 0.05,
    decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias that lower the non-negative risk of positive and unlabelled examples.

    With the logistic loss, the risk of positives taken as positive weighs ``prior``; that of unlabelled ones taken as negative
    loses what positives among them account for. Where the difference falls below zero the model has begun to learn single
    examples by heart, and a step goes the other way. ``rows`` and ``columns`` list the features present; ``positive`` marks rows.
    """
    n = len(positive)
    w, b = np.zeros(n_features), np.log(prior / (1 - prior))
    share = np.where(positive, 1 / max(positive.sum(), 1), 1 / max((~positive).sum(), 1))
    moment, square = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(rows, w[columns], n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        as_negative = np.logaddexp(0, z) * share
        negative_risk = as_negative[~positive].sum() - prior * as_negative[positive].sum()
        if negative_risk >= 0:
            pull = np.where(positive, prior * (p - 1) - prior * p, p) * share
        else:
            pull = -np.where(positive, -prior * p, p) * share
        grad = np.append(np.bincount(columns, pull[rows], n_features) + decay * w, pull.sum())
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Classifier | None:
    """A classifier from documents with ``label_col`` 1 and from documents whose labels are not looked at.

    About ``TOXIC_DOCS`` toxic and ``UNLABELLED_DOCS`` other documents are learned from, those with the smallest hashed ids. The
    class prior is the share of 1 among all labels. An id with several labels is toxic if one of them says so. None without
    a toxic document that has a text.
    """
    judged = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    judged = judged.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col) == 1).alias("toxic"))
    counted = judged.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("toxic").cast("long")).alias("k")).first()
    if not counted["k"]:
        return None
    prior = min(max(counted["k"] / counted["n"], 0.001), 0.5)
    known = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where("doc is not null and text is not null")
    # the sample is bounded by its parameter, so it may be broadcast
    ids = bounded_sample(judged.where("toxic").select("id"), TOXIC_DOCS, F.col("id"))
    toxic = known.join(F.broadcast(ids), F.col("doc") == F.col("id"), "left_semi")
    plain = bounded_sample(known, UNLABELLED_DOCS, F.col("doc"))
    sample = toxic.select("text", F.lit(True).alias("toxic")).unionByName(plain.select("text", F.lit(False).alias("toxic")))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found = [sorted(document_features(x)) for x in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("toxic"), pa.array(found, pa.list_(pa.string()))], names=["toxic", "features"])

    # written once: sizes, counts and the matrix come from it
    rows = materialize(mapped(sample, featured, "toxic boolean, features array<string>"), "sample")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_all = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos:
        return None
    counts = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum(F.col("toxic").cast("long")).alias("p"), F.sum((~F.col("toxic")).cast("long")).alias("u")
    ).where(F.col("p") >= LEAST_DOCS)
    lift = ((F.col("p") + 0.5) / (n_pos + 1)) / ((F.col("u") + 0.5) / (n_all + 1))
    weight = F.round(F.log(lift) * F.sqrt(F.col("p")), 9)
    best = counts.where(lift >= LEAST_LIFT).orderBy(weight.desc(), "feature").limit(FEATURES)
    chosen = [r["feature"] for r in best.select("feature").collect()]
    number = {f: i for i, f in enumerate(sorted(chosen))}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[number[f] for f in x if f in number] for x in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "at"])

    table = mapped(rows, numbered, "toxic boolean, at array<int>").toArrow().combine_chunks()
    found = [(t, tuple(x)) for t, x in zip(table["toxic"].to_pylist(), table["at"].to_pylist(), strict=True)]
    found.sort()  # tasks end in any order
    positive = np.array([t for t, _ in found], bool)
    each = np.array([len(x) for _, x in found], np.int64)
    columns = np.fromiter((i for _, x in found for i in x), np.int64, int(each.sum()))
    w, b = fit_nonnegative(np.repeat(np.arange(len(found)), each), columns, positive, len(number), prior)
    return Classifier({f: float(w[i]) for f, i in number.items()}, b)


def score(docs: DataFrame, model: Classifier | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted), one row per row of ``docs``; null texts are scored as empty ones; without a model all scores are 0.

    Repeated rows get a row each, an empty table none, and columns beside the two named are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for piece in slices(batches):
            texts = piece.column("text").to_pylist()
            found = np.array([known.score(x) if known else 0.0 for x in texts])
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )
        if known:
            known.known.clear()

    return mapped(texts_of(docs, id_col, text_col), judge, f"doc_id {dict(docs.dtypes)[id_col]}, score double, predicted int")


def without_toxic(docs: DataFrame, model: Classifier | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns; a null text counts as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for piece in slices(batches, text_col):
            keep = [not known or known.score(x or "") < threshold for x in piece.column(text_col).to_pylist()]
            yield piece.filter(pa.array(keep, pa.bool_()))
        if known:
            known.known.clear()

    return mapped(docs, judge, docs.schema)


def learnable(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that labels may be learned from: two folds of three by the id."""
    return rows.where(~in_fold(id_col, 3, 1))


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) with a classifier learned from the other folds alone."""
    model = train(learnable(docs), learnable(labels))
    return score(docs, model).select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", "predicted")
