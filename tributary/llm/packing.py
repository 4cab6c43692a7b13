"""Packing of documents into sequences of equal length: concatenate, number, cut."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm.arrow import keeps, mapped, slices, texts_of
from tributary.session import materialize

SEQUENCE = 2048
END_ID = 1
#: So many words are kept with their ids, unless one of them has more bytes than this.
CACHED_WORDS, LONGEST_CACHED = 600_000, 1 << 16
#: Words that are encoded as one text.
TOGETHER = 1000
#: Bytes of text that are encoded at a time.
PIECE_BYTES = 4 << 20


#: Words of letters that no normal form changes, alone or before a full stop or comma.
LETTERS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+$"
STOPPED = LETTERS.replace("$", "[.,]$")

#: How the tokenizer must cut a text for its words to be encoded one by one (a fixed value).
WORDWISE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Ids of whole texts by a tokenizer file.

    Where the tokenizer cuts by ``WORDWISE``, no id spans white space, or a letter and a full stop or comma behind it. Then Arrow
    cuts texts into words and numbers the different ones; ids are made once for each of these, a word before such a mark not
    again, and gathered by number. Any other tokenizer encodes texts as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        spec = json.loads(self.tokenizer.to_str())
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.wordwise = any(x.get("pattern") == {"Regex": WORDWISE} and x.get("invert") for x in cuts)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        suffix = spec["model"].get("end_of_word_suffix")
        self.closing = np.zeros(self.size, bool) if suffix else None
        for token, i in self.tokenizer.get_vocab().items() if suffix else ():
            self.closing[i] = token.endswith(suffix)
        self.stops = {c: np.array(self.tokenizer.encode(c, add_special_tokens=False).ids, self.kind) for c in ".,"}

        # letters in lower case need neither normal forms nor cuts, only what stands for their bytes
        self.folds = {"type": "Lowercase"} in (spec["normalizer"] or {}).get("normalizers", [])
        steps = [{"type": "WhitespaceSplit"}, *(x for x in cuts if x["type"] == "ByteLevel")]
        self.letters = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}))
        self.special = [x["content"] for x in spec["added_tokens"]]

        # a mark that is one id wherever it stands alone, so that many words can be encoded as one text
        marks = ((c, self.tokenizer.encode(c, add_special_tokens=False).ids) for c in "^~|")
        self.mark, self.mark_id = next(((c, ids[0]) for c, ids in marks if len(ids) == 1), (None, None))
        self._forget()

    def _forget(self) -> None:
        """Known words have a number, their place in ``words``; it gives the place of their ids in ``store`` and how many there are."""
        self.words = pa.array([""], pa.string())
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.store, self.used = np.zeros(1 << 20, self.kind), 0

    def _add(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words with their ids, which stand one behind the other."""
        if self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store[: self.used], np.zeros(max(self.used, len(ids)) + len(ids), self.kind)])
        self.store[self.used : self.used + len(ids)] = ids
        self.starts = np.append(self.starts, self.used + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.used += len(ids)
        self.words = pa.concat_arrays([self.words, words])

    def _known(self, words: pa.Array) -> np.ndarray:
        """Numbers of words, -1 without one."""
        return pc.fill_null(pc.index_in(words, self.words), -1).to_numpy()

    def _together(self, words: pa.Array, tokenizer: Tokenizer, between: str, is_end: np.ndarray, keep_end: int) -> None:
        """Encodes many words as one text and cuts the ids where ``is_end`` says so."""
        found, sizes, all_words = [], [], words.to_numpy(zero_copy_only=False)
        for at in range(0, len(words), TOGETHER):
            some = between.join([*all_words[at : at + TOGETHER], ""])
            ids = np.array(tokenizer.encode_batch_fast([some.lower() if keep_end and self.folds else some], add_special_tokens=False)[0].ids, self.kind)
            end = is_end[ids]
            sizes.append(np.diff(np.flatnonzero(end), prepend=-1) - 1 + keep_end)
            found.append(ids if keep_end else ids[~end])
        self._add(words, np.concatenate(found), np.concatenate(sizes))

    def _alone(self, words: pa.Array) -> None:
        ids = [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        self._add(words, np.concatenate(ids), np.array([len(x) for x in ids]))

    def _learn(self, words: pa.Array) -> None:
        """Ids for words that have none yet; those of a word before a full stop or comma are its own and the mark's."""
        stopped = pc.match_substring_regex(words, STOPPED)
        ended, others = words.filter(stopped), words.filter(pc.invert(stopped))
        stems = pc.utf8_slice_codeunits(ended, 0, -1)
        others = pc.unique(pa.concat_arrays([others, stems.filter(pa.array(self._known(stems) < 0))]))
        if self.closing is not None:  # a plain word is one piece, whose last id says so
            plain = pc.match_substring_regex(others, LETTERS)
            if some := others.filter(plain):
                self._together(some, self.letters, " ", self.closing, 1)
            others = others.filter(pc.invert(plain))
        if self.mark is not None:
            marked = pc.match_substring(others, self.mark)
            if some := others.filter(pc.invert(marked)):
                self._together(some, self.tokenizer, f" {self.mark} ", np.arange(self.size) == self.mark_id, 0)
            others = others.filter(marked)
        if others:
            self._alone(others)
        for mark, ids in self.stops.items():
            here = pc.ends_with(ended, mark)
            if not (some := ended.filter(here)):
                continue
            at = self._known(stems.filter(here))
            sizes = self.sizes[at] + len(ids)
            ends = np.cumsum(sizes)
            flat, own = np.empty(int(ends[-1]), self.kind), np.ones(int(ends[-1]), bool)
            for k, i in enumerate(ids):
                flat[ends - len(ids) + k] = i
                own[ends - len(ids) + k] = False
            flat[own] = self._gathered(at)[0]
            self._add(some, flat, sizes)

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words by number, one behind the other, and how many each has."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        return self.store[shift + np.arange(len(shift))], sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and how many each text has."""
        if not self.wordwise:
            ids = [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, self.kind), *ids]), np.array([len(x) for x in ids], np.int64)
        if self.folds:  # fewer different words; a special token is one in its own case alone
            low = pc.ascii_lower(texts)
            for x in self.special:
                low = pc.if_else(pc.match_substring(texts, x, ignore_case=True), texts, low) if pc.any(pc.match_substring(low, x.lower())).as_py() else low
            texts = low
        cut = pc.ascii_split_whitespace(texts)
        numbered = cut.flatten().dictionary_encode()
        words = numbered.dictionary
        if len(self.words) + len(words) > CACHED_WORDS:
            self._forget()
        at = self._known(words)
        if (at < 0).any():
            self._learn(words.filter(pa.array(at < 0)))
            at = self._known(words)
        ids, sizes = self._gathered(at[numbered.indices.to_numpy()])
        if len(words) and pc.max(pc.binary_length(words)).as_py() > LONGEST_CACHED:
            self._forget()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(pc.list_value_length(cut).to_numpy())]
        return ids, np.diff(ends, prepend=0)


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and sizes with ``end_id`` behind each text's own."""
    ends = np.cumsum(sizes + 1)
    out = np.full(len(ids) + len(sizes), end_id, ids.dtype)
    own = np.ones(len(out), bool)
    own[ends - 1] = False
    out[own] = ids
    return out, sizes + 1


def packed(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ids as a binary value for each text."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * ids.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.tobytes())])


_tokenizers: dict[str, WordIds] = {}
keeps(__name__, _tokenizers.clear)


def word_ids(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """(doc_id, part, before, n, ids): first pass. ``before`` counts the ids of earlier rows of the same task, ``part`` its number.

    Written once, so that a repeated task can't renumber what others have read; ids are packed integers.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, at = word_ids(path), TaskContext.get().partitionId(), 0
        for piece in slices(batches, limit=PIECE_BYTES):
            ids, n = with_end(*words.encode(piece.column("text")), end_id)
            before = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(np.full(len(n), part, np.int64)), pa.array(before), pa.array(n), packed(ids, n).cast(pa.binary())],
                names=["doc_id", "part", "before", "n", "ids"],
            )

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, part long, before long, n long, ids binary"
    return materialize(mapped(texts_of(docs, id_col, text_col), encode, schema), "tokens")


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids): a row for each piece of a document.

    All documents, each with ``end_id`` behind it, form one stream that is cut every ``size`` ids; only the last sequence is
    shorter. The first pass leaves totals by task; their running sum, a row for each task, gives every document its place in
    the stream, and the second pass cuts. ``ids`` holds a piece's ids as little-endian unsigned 32-bit integers; it is left
    out unless ``with_ids``.

    A null or empty text is its end id alone; repeated rows are packed each; an empty table gives no pieces; other columns
    are ignored. The order of documents is that of the table's partitions.
    """
    rows = tokenized(docs, path, id_col, text_col, end_id)
    totals = rows.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    # a row for each task of the first pass
    placed = rows.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    kind = word_ids(path).kind

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "ids"):
            which, starts, lengths, sums, wholes, sequences, offsets, cuts = [], [], [], [], [], [], [], []
            columns = (piece.column(c).to_pylist() for c in ("at", "n", "ids"))
            for row, (at, n, raw) in enumerate(zip(*columns, strict=True)):
                ids = np.frombuffer(raw, kind).astype("<u4")
                start = 0
                while start < n:
                    place = at + start
                    length = min(n - start, size - place % size)
                    part = ids[start : start + length].tobytes()
                    which.append(row)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(part))
                    wholes.append(n)
                    sequences.append(place // size)
                    offsets.append(place % size)
                    if with_ids:
                        cuts.append(part)
                    start += length
            longs = [pa.array(x, pa.int64()) for x in (starts, lengths, sums, wholes, sequences, offsets)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            bodies = [pa.array(cuts, pa.binary())] if with_ids else []
            doc_ids = piece.column("doc_id").take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays([doc_ids, *longs, *bodies], names=names + ["ids"] * with_ids)

    doc_kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {doc_kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return mapped(placed, cut, schema + ", ids binary" * with_ids)
