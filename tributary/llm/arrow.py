"""Bounded pieces of Arrow batches, and words of whole texts as numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.session import ship

SLICE_BYTES = 1 << 20


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) alone, null texts as empty ones: other columns never reach Python, whatever their names."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def as_row(docs: DataFrame) -> Column:
    """All columns as one, so that no name meets another beside it; ``row.*`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in pieces of about ``limit`` bytes of ``column``; a longer value is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = offsets_of(batch.column(column))[1:]
        at = 0
        while at < batch.num_rows:
            start = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, start + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def offsets_of(values: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array, from 0; a null takes no bytes."""
    if values.null_count:
        values = values.fill_null("" if "string" in str(values.type) else b"")
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(values.buffers()[1], kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    return raw - raw[0]


def bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array without nulls, and where each value starts, with the end."""
    ends = offsets_of(values)
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    first = int(np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)[values.offset])
    data = values.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[first : first + int(ends[-1])] if data is not None else np.zeros(0, np.uint8)
    return flat, ends


BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20

#: What modules keep between the tasks of a worker process: how to let go of it.
_kept: dict[str, Callable[[], None]] = {}


def keeps(module: str, release: Callable[[], None]) -> None:
    """Names a module that keeps results in worker processes; it lets go of them when another one's task starts."""
    _kept[module] = release


def release_others(module: str) -> None:
    for name, release in _kept.items():
        if name != module:
            release()
    give_back()


def give_back() -> None:
    """Free pages go back to the system, where the C library can do that; a worker process outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over the batches of each partition, with this package at hand."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))  # texts are long: a few MB of them make a batch
    module = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tributary.llm.arrow import give_back, release_others  # the worker's own module, not a copy of the driver's

        release_others(module)
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit words (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers: dict[str, np.ndarray] = {}
keeps(__name__, _powers.clear)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the odd base modulo 2**64, and of its inverse."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["up"], _powers["down"]


def words_in(flat: np.ndarray, ends: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of consecutive texts: a 64-bit hash, the text's number and the first byte of each.

    ``lower`` folds A-Z. No byte of a longer UTF-8 character is in those ranges, so bytes will do.
    """
    if lower:
        flat = np.where((flat >= 65) & (flat <= 90), flat | 32, flat)
    space = (flat == 32) | ((flat >= 9) & (flat <= 13))
    inside = np.ones(len(flat) + 1, bool)
    inside[:-1] = ~space
    inside[-1] = False
    border = np.zeros(len(flat) + 1, bool)
    border[ends] = True  # a word never crosses two texts
    before = np.empty(len(flat) + 1, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | border))
    stops = np.flatnonzero(before & (~inside | border))
    up, down = _power(len(flat))
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[: len(flat)], out=total[1:])
    raw = (total[stops] - total[starts]) * down[starts]
    owner = np.searchsorted(ends, starts, "right") - 1
    return mix(raw ^ (stops - starts).astype(np.uint64)), owner, starts


def bounded_sample(df: DataFrame, n: int, key: Column) -> DataFrame:
    """About ``n`` rows at most, the same ones however the table is partitioned: those with the smallest hashed keys.

    A count sets the hash limit, so no task and no sort sees more than the sample.
    """
    total = df.count()
    if total <= n:
        return df
    share = n / total
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))
