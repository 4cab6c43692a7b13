"""Packing of documents into few sequences without cutting those that fit into one."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm.arrow import keeps, mapped, slices, texts_of
from tributary.llm.bpe import PIECES, byte_alphabet
from tributary.llm.completion import Filling, complete
from tributary.session import materialize

SEQUENCE = 2048
END_ID = 0


class ByteIds:
    """Ids of whole texts by a tokenizer file.

    Byte-level BPE whose ids follow the order of its merges is run by tiktoken, from the vocabulary in the file and to the same
    ids; any other tokenizer by the tokenizers library.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.fast = _ranked(json.loads(self.library.to_str()))

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None:
            return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")


def _ranked(spec: dict) -> tiktoken.Encoding | None:
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not spec["normalizer"] and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    if not plain or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
        return None
    back = {c: b for b, c in enumerate(byte_alphabet())}
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"]):
        return None
    added = {x["content"]: x["id"] for x in spec["added_tokens"]}
    merged = [a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    made = [model["vocab"][t] for t in merged]
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
    if sorted(made) != made or len(set(made)) < len(made) or made[0] < 256 or len(vocabulary) != 256 + len(made):
        return None
    ranks = {bytes(back[c] for c in t): i for t, i in vocabulary.items()}
    return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=added)


_encoders: dict[str, ByteIds] = {}
keeps(__name__, _encoders.clear)


def byte_ids(path: str) -> ByteIds:
    if path not in _encoders:
        _encoders[path] = ByteIds(path)
    return _encoders[path]


def pieces_of(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth, ids): documents with their end id, the longer ones cut.

    A document above ``size`` makes pieces of ``size`` ids, the first of which may be shorter. ``nth`` numbers the pieces of one
    length in a task from 0, ``part`` is the task; the table is written once, so they stay.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen = byte_ids(path), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        end = np.array([end_id], np.uint32)
        for some in slices(batches):
            which, rows, bodies = [], [], []
            for row, text in enumerate(some.column("text").to_pylist()):
                ids = np.append(own.encode(text), end).astype("<u4")
                at = 0
                for piece in range(-(-len(ids) // size)):
                    to = at + (size if piece else (len(ids) - 1) % size + 1)
                    raw = ids[at:to].tobytes()
                    which.append(row)
                    rows.append((piece, at, to - at, zlib.crc32(raw), seen[to - at]))
                    seen[to - at] += 1
                    if with_ids:
                        bodies.append(raw)
                    at = to
            table = np.array(rows, np.int64).reshape(-1, 5)
            columns = [some.column("id").take(pa.array(which, pa.int64())), pa.array(table[:, 0].astype(np.int32)), *(pa.array(c) for c in table[:, 1:4].T)]
            columns += [pa.array(np.full(len(table), part, np.int64)), pa.array(table[:, 4])] + ([pa.array(bodies, pa.binary())] if with_ids else [])
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long, part long, nth long" + ", ids binary" * with_ids
    return materialize(mapped(texts_of(docs, id_col, text_col), encode, schema), "pieces")


class Places:
    """Where the pieces of each length go, by their number among those of that length."""

    def __init__(self, fillings: list[Filling], counts: list[int]):
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)  # pieces of smaller lengths
        taken, first, rows = self.before.copy(), 0, []
        for times, items in fillings:
            at = 0
            for length, k in items:
                rows.append((taken[length], first, k, at))
                taken[length] += times * k
                at += k * length
            first += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.starts, self.first, self.each, self.at = (np.ascontiguousarray(c) for c in table.T)

    def find(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets."""
        place = self.before[lengths] + numbers
        row = np.searchsorted(self.starts, place, "right") - 1
        within = place - self.starts[row]
        return self.first[row] + within // self.each[row], self.at[row] + within % self.each[row] * lengths


def pack_whole(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids): a row for each piece of a document.

    Documents with ``end_id`` behind them are packed into as few sequences of ``size`` ids as bin completion finds; only longer ones are
    cut. The search sees how many pieces have each length, a row for each of at most ``size`` lengths, whatever the size of the table.
    Its fillings give each length ranges of piece numbers, and every task places its pieces by their numbers. ``ids`` holds
    a piece's ids as little-endian unsigned 32-bit integers, unless ``with_ids`` is false.

    A null or empty text is its end id alone; repeated rows are packed each; an empty table gives no pieces; other columns are ignored.
    """
    pieces = pieces_of(docs, path, id_col, text_col, size, end_id, with_ids)
    totals = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = [0] * (size + 1)
    for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most a row for each length
        counts[r["length"]] = r["n"]
    places = Places(complete(counts, size), counts)
    # a group of this window has a row for each task
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, ["part", "length"]).withColumn("number", F.col("base") + F.col("nth"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    sent = docs.sparkSession.sparkContext.broadcast(places)  # some rows for each filling; the search bounds their number

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = sent.value.find(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            bodies = [batch.column("ids")] if with_ids else []
            columns = [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset), *bodies]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"] + ["ids"] * with_ids)

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    chosen = numbered.select(*names, "number", *["ids"] * with_ids)
    return mapped(chosen, place, schema + ", ids binary" * with_ids)
