"""Language-model scores with stupid backoff, from n-gram counts of the whole corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrow import bytes_of, mapped, mix, slices, words_in

#: N-grams of several words seen less often back off. What a shorter context is worth.
LEAST, BACKOFF = 1, 0.4
#: Of a word that the corpus lacks altogether.
UNSEEN = -12.0
#: Bytes of text whose n-grams are counted, and looked up, together.
TOGETHER = 12 << 20
#: Keys are dealt by their top bits into buckets: so many at least (as a power of two), and of about so many words.
BITS, BUCKET = 10, 1 << 19
#: Of differences between keys the low bytes look random and aren't worth compressing.
PLAIN = 5
_SCALE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """``counts``: (bucket, keys, counts), packed keys of n-grams of up to ``order`` words; those of several rows add up.

    ``source``: the table and column they are from.
    """

    source: tuple[DataFrame, str]
    counts: DataFrame
    total: int
    bits: int
    order: int


def _keys(texts: pa.Array, order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """By length: a 64-bit key of the n-gram that starts at each word, and whether it lies in one text. The text of each word."""
    words, owners, row = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for piece in slices(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])):  # bytes take more room than their words
        word, owner, _ = words_in(*bytes_of(piece.column("text")), lower=True)
        words.append(word)
        owners.append(owner + row)
        row += piece.num_rows
    word, owner = np.concatenate(words), np.concatenate(owners)
    keys, whole = [word], [np.ones(len(word), bool)]
    for n in range(2, order + 1):
        size = max(len(word) - n + 1, 0)
        keys.append(mix(keys[-1][:size] * _SCALE + word[n - 1 :] + np.uint64(n)))
        whole.append(owner[:size] == owner[n - 1 :])
    return keys, whole, owner


def _pack(x: np.ndarray, plain: int = 0) -> bytes:
    """64-bit integers byte by byte, after their number: ``plain`` low bytes as they are, the others compressed."""
    by = x.view(np.uint8).reshape(-1, 8).T
    return len(x).to_bytes(4, "little") + by[:plain].tobytes() + pa.compress(by[plain:].tobytes(), "zstd", asbytes=True)


def _unpack(raw: bytes, plain: int = 0) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    by = np.empty((8, n), np.uint8)
    by[:plain] = np.frombuffer(raw, np.uint8, plain * n, 4).reshape(plain, n)
    by[plain:] = np.frombuffer(pa.decompress(raw[4 + plain * n :], (8 - plain) * n, "zstd"), np.uint8).reshape(8 - plain, n)
    return np.ascontiguousarray(by.T).view(np.uint64).ravel()


def _unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, PLAIN), dtype=np.uint64)


def _packets(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[slice], list[bytes]]:
    """Buckets of sorted keys, where each one's keys are, and these packed as differences."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    step = keys.copy()
    step[1:] -= keys[:-1]
    step[first] = keys[first]
    parts = [slice(a, b) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=False)]
    return bucket[first], parts, [_pack(step[p], PLAIN) for p in parts]


def _sums(packets: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of some packets in order, and their counts summed."""
    if not packets:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    keys = np.concatenate([_unpacked_keys(k) for k, _ in packets])
    counts = np.concatenate([_unpack(c) for _, c in packets])
    order = np.argsort(keys, kind="stable")  # runs in order are merged
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def train(docs: DataFrame, order: int = 3, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Counts of all n-grams over all documents. Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z folded.

    N-grams are known by 64-bit hashes of their words. They are counted by some MB of text, and these counts dealt into
    buckets by key, as many as the corpus needs; nothing but the number of words reaches the driver.
    """
    if not 1 <= order <= 3:
        raise ValueError("order is 1, 2 or 3")
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(words_in(*bytes_of(piece.column("text")))[0]) for piece in slices(batches))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    total = mapped(texts, sizes, "n long").agg(F.sum("n")).first()[0] or 0
    bits = max(BITS, (total // BUCKET).bit_length())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, limit=TOGETHER):
            yield _counted(piece.column("text"), order, bits)

    return Model((docs, text_col), mapped(texts, count, "bucket long, keys binary, counts binary"), total, bits, order)


def _counted(texts: pa.Array, order: int, bits: int) -> pa.RecordBatch:
    """(bucket, keys, counts): a packet for each bucket that the n-grams of some texts are in."""
    keys, whole, _ = _keys(texts, order)
    found, n = np.unique(np.concatenate([k[w] for k, w in zip(keys, whole, strict=True)]), return_counts=True)
    bucket, parts, packed = _packets(found, bits)
    n = n.astype(np.uint64)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(packed, pa.binary()), pa.array([_pack(n[p]) for p in parts], pa.binary())], names=["bucket", "keys", "counts"]
    )


def _slices(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(slice, id, text): about ``TOGETHER`` bytes of rows in a slice, by a hash of id and text, so that every scan finds the same slices."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return texts.select(F.pmod(F.xxhash64("id", "text"), F.lit(max(1, math.ceil(size / TOGETHER)))).alias("slice"), "id", "text")


def _answers(packets: DataFrame) -> DataFrame:
    """(slice, bucket, counts): how often the corpus has the keys of each packet that names a slice, in their order.

    Packets with counts make up the corpus; one with both is counted and answered.
    """

    def found(table: tuple[np.ndarray, np.ndarray], keys: bytes) -> bytes:
        want = _unpacked_keys(keys)
        if not len(table[0]):
            return _pack(np.zeros(len(want), np.uint64))
        place = np.minimum(np.searchsorted(table[0], want), len(table[0]) - 1)
        return _pack(np.where(table[0][place] == want, table[1][place], np.uint64(0)))

    def told(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["slice", "bucket", "counts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting, table = None, [], [], None
        for batch in batches:
            out = []
            for bucket, at, keys, n in zip(*[batch.column(c).to_pylist() for c in ("bucket", "slice", "keys", "counts")], strict=True):
                if bucket != now:
                    if waiting:
                        table = _sums(held)
                        out += [(x, now, found(table, k)) for x, k in waiting]
                    now, held, waiting, table = bucket, [], [], None
                if n is not None:
                    held.append((keys, n))
                    if at is not None:
                        waiting.append((at, keys))
                else:  # a bucket's counts come first
                    if table is None:
                        table, held = _sums(held), []
                    out.append((at, bucket, found(table, keys)))
            yield told(out)
        if waiting:
            table = _sums(held)
            yield told([(x, now, found(table, k)) for x, k in waiting])

    dealt = packets.select("bucket", "slice", "keys", "counts").repartition("bucket").sortWithinPartitions("bucket", F.col("slice").asc_nulls_first())
    return mapped(dealt, answer, "slice long, bucket long, counts binary")


def _values(keys: list[np.ndarray], whole: list[np.ndarray], found: np.ndarray, total: int) -> np.ndarray:
    """The log10 score of each word, from the counts of the distinct keys in order."""
    distinct, place = np.unique(np.concatenate([k[w] for k, w in zip(keys, whole, strict=True)]), return_inverse=True)
    if len(distinct) != len(found):
        raise RuntimeError("a slice was asked with other rows than it is scored with")
    step, at = float(np.log10(BACKOFF)), 0
    shorter = value = np.zeros(0)
    for n, same in enumerate(whole, 1):
        count = np.zeros(len(same))
        count[same] = found[place[at : at + int(same.sum())]]
        at += int(same.sum())
        if n == 1:
            value = np.where(count > 0, np.log10(np.maximum(count, 1) / max(total, 1)), UNSEEN)
        else:
            share = np.log10(np.maximum(count, 1) / np.maximum(shorter[: len(count)], 1))
            # a row's first words have no longer context
            value[n - 1 :] = np.where(same & (count >= max(LEAST, 1)), share, value[n - 1 :] + np.where(same, step, 0.0))
        shorter = count
    return value


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, score), one row per row of ``docs``: the mean log10 of its words' scores, rounded to 9 places.

    A word's score is the share of its longest context that it follows, if that n-gram was seen ``LEAST`` times; otherwise that
    of the next shorter context times ``BACKOFF``. Some MB of rows ask each bucket for the counts of their distinct n-grams, and
    get them back in the same order. Asking and scoring group the rows alike, so texts are shuffled once and read from there
    again. Texts without words (null, empty, blank) score null; repeated rows score alike (and lie in one slice); an empty
    table gives no rows; other columns are ignored.
    """
    order, bits, total = model.order, model.bits, model.total
    kind = dict(docs.dtypes)[id_col]
    table = _slices(docs, id_col, text_col)

    own = model.source[0] is docs and model.source[1] == text_col

    def joined(column: pa.ChunkedArray) -> pa.Array:
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)

    def ask(rows: pa.Table) -> pa.Table:
        bucket, keys, counts = _counted(joined(rows["text"]), order, bits).columns
        at = pa.array(np.full(len(bucket), rows["slice"][0].as_py(), np.int64))
        return pa.table({"bucket": bucket, "slice": at, "keys": keys, "counts": counts if own else pa.nulls(len(bucket), pa.binary())})

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = joined(rows["id"]), joined(rows["text"])
        keys, whole, owner = _keys(texts, order)
        n = np.bincount(owner, minlength=len(texts))
        told = answers.sort_by("bucket")["counts"].to_pylist()  # in the order of the slice's keys
        found = np.concatenate([np.zeros(0, np.uint64), *[_unpack(x) for x in told]])
        log = np.bincount(owner, _values(keys, whole, found, total), len(texts)) if len(owner) else np.zeros(len(texts))
        mean = pa.array(np.round(log / np.maximum(n, 1), 9), mask=n == 0)
        return pa.table({"doc_id": ids, "n_words": pa.array(n.astype(np.int64)), "score": mean})

    packets = table.groupBy("slice").applyInArrow(ask, "bucket long, slice long, keys binary, counts binary")
    # the corpus itself sends its n-grams once, to be counted and to ask
    answers = _answers(packets if own else packets.unionByName(model.counts.withColumn("slice", F.lit(None).cast("long"))))
    return table.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(scored, f"doc_id {kind}, n_words long, score double")
