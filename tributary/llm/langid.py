"""Language identification with n-gram Bloom filters, one bit per language in every cell."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrow import keeps, mapped, mix, slices, texts_of
from tributary.session import materialize

CELLS = 1 << 20
HASHES = 3
ORDERS = (3, 4)
SAMPLE_DOCS = 3000
RAREST = 20_000
UNKNOWN = "und"

_letters: list[np.ndarray] = []
keeps(__name__, _letters.clear)


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the letter n-grams of whole texts, the text each is from, and whether a text has a letter.

    Texts are lower-cased; whatever is no letter becomes one blank, so that a gram may hold the end or start of a word.
    A gram has a letter at every place but the first and the last.
    """
    low = [x.lower() for x in texts]
    # a blank before each text and two after the last: no gram holds letters of two texts
    codes = np.frombuffer((" " + " ".join(low) + "   ").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([1] + [len(x) + 1 for x in low])
    letter = _is_letter()[codes]
    c = np.where(letter, codes, 0).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    c, letter = c[keep], letter[keep]
    owner = (np.searchsorted(ends, np.flatnonzero(keep), "right") - 1).clip(0, max(len(low) - 1, 0))
    has = np.zeros(len(low), bool)
    has[np.unique(owner[letter])] = True
    found, owners = [], []
    for n in ORDERS:
        size = max(len(c) - n + 1, 0)
        inner = np.ones(size, bool)
        h = np.full(size, np.uint64(n), np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + c[k : k + size]
            if 0 < k < n - 1:
                inner &= letter[k : k + size]
        found.append(mix(h[inner]))
        owners.append(owner[1 : size + 1][inner])  # the place after the first belongs to the text
    return np.concatenate(found), np.concatenate(owners), has


def _cells(h: np.ndarray) -> list[np.ndarray]:
    step = (h >> np.uint64(40)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(CELLS - 1)).astype(np.int64) for i in range(HASHES)]


@dataclass
class Model:
    """``cells[w]`` holds languages 64 w to 64 w + 63, a bit each; ``false_rate``: what a filter answers to unknown grams."""

    langs: list[str]
    cells: list[np.ndarray]
    false_rate: np.ndarray
    fallback: str | None

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], fallback: str | None) -> Model:
        langs = sorted(grams)
        kind = np.uint8 if len(langs) <= 8 else np.uint64
        cells = [np.zeros(CELLS, kind) for _ in range(0, len(langs), 64)]
        rate = np.zeros(len(langs))
        for i, lang in enumerate(langs):
            mine = np.zeros(CELLS, bool)
            for at in _cells(grams[lang]):
                mine[at] = True
            cells[i // 64][mine] |= kind(1 << i % 64)
            rate[i] = mine.mean() ** HASHES
        return cls(langs, cells, rate, fallback)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        h, owner, has = grams_of(texts)
        n = np.bincount(owner, minlength=len(texts)).astype(float)
        hits = np.zeros((len(texts), max(len(self.langs), 1)))
        places = _cells(h)
        for w, cells in enumerate(self.cells):
            masks = cells[places[0]]
            for at in places[1:]:
                masks = masks & cells[at]
            for i in range(64 * w, min(64 * w + 64, len(self.langs))):
                bit = (masks >> masks.dtype.type(i % 64)) & masks.dtype.type(1)
                hits[:, i] = np.bincount(owner, weights=bit, minlength=len(texts))
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        true = np.maximum(hits - n[:, None] * self.false_rate, 0) / (1 - self.false_rate).clip(1e-9)
        best = true.argmax(axis=1)  # the first of equals, in order of names
        total = true.sum(axis=1)
        score = np.divide(true[np.arange(len(texts)), best], total, out=np.zeros(len(texts)), where=total > 0)
        names = [UNKNOWN if not a else self.langs[b] if t > 0 else self.fallback for a, b, t in zip(has, best, total, strict=True)]
        return names, np.where(has, score.clip(0, 1), 0.0)


def train(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int = SAMPLE_DOCS, rarest: int = RAREST) -> Model:
    """Filters of the n-grams that make up at least one in ``rarest`` of a language's n-grams.

    At most ``rarest`` grams of a language can do so, which bounds what the driver gathers. The grams come from about
    ``sample_docs`` documents per language, those with the smallest hashed ids, so partitioning doesn't matter.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model.build({}, None)
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col(lang_col) == lang, min(1 << 30, (sample_docs << 30) // n)).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            langs = np.array(piece.column("lang").to_pylist())
            h, owner, _ = grams_of(piece.column("text").to_pylist())
            for lang in np.unique(langs):
                keys, n = np.unique(h[langs[owner] == lang], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()), "gram": keys.view(np.int64), "n": n})

    grams = mapped(sample.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), count, "lang string, gram long, n long")
    grams = materialize(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    total = grams.groupBy("lang").agg(F.sum("n").alias("total"))
    often = grams.join(F.broadcast(total), "lang").where(F.col("n") * rarest >= F.col("total"))
    found: dict[str, list[int]] = {}
    for r in often.select("lang", "gram").collect():
        found.setdefault(r["lang"], []).append(r["gram"])
    fallback = min(counts, key=lambda x: (-counts[x], x))
    return Model.build({k: np.array(v, np.int64).view(np.uint64) for k, v in found.items()}, fallback)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``.

    A text that is null or has no letter is ``und`` with score 0; one with letters but no known gram gets the commonest
    language with score 0; equal counts go to the name that sorts first. Repeated rows get a row each, an empty table none.
    The score is the winner's share of all languages' corrected counts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for piece in slices(batches):
            lang, score = known.predict(piece.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": piece.column("id"), "lang_pred": pa.array(lang, pa.string()), "score": score})

    kind = dict(docs.dtypes)[id_col]
    return mapped(texts_of(docs, id_col, text_col), predict, f"doc_id {kind}, lang_pred string, score double")


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in a fold; rows without an id do, so nothing is learned from them."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))
