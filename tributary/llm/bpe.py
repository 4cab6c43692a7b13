"""Byte-level BPE by dynamic programming over prefixes, exact to the ids of the merge loop.

Every prefix of a piece has exactly one encoding, so exactly one last token. Tokens that end at a place are found by an
automaton over the vocabulary's suffixes; one of them is the last token if it fits behind the last token of the prefix before
it. Two tokens fit if the merge loop, run over both, never joins symbols across their border.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tributary.llm.arrow import keeps, mapped, slices, texts_of

# fixed values: how byte-level BPE cuts a text before it merges, and the bytes that stand for themselves
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = (("!", "~"), ("¡", "¬"), ("®", "ÿ"))

#: Ids are kept for pieces and words up to this length, and verdicts on pairs, for so many of each.
LONGEST_CACHED = 48
CACHED_PIECES, CACHED_WORDS, CACHED_PAIRS = 250_000, 700_000, 400_000

#: Blanks other than space and line break, and the mark put before words.
OTHER_BLANK = re.compile("[\\0\\t\\x0b-\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def _uneven(text: str) -> bool:
    """Whether some blank is no space or line break, or doesn't stand before something visible."""
    pairs = "  " in text or "\n\n" in text or " \n" in text or "\n " in text
    return pairs or text[-1:] in " \n" or OTHER_BLANK.search(text) is not None


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: plain bytes for themselves, the others from 256 up."""
    plain = {b for a, z in PLAIN_BYTES for b in range(ord(a), ord(z) + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encodes and decodes with the vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] or not spec["pre_tokenizer"]["use_regex"] or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without normalizer and prefix space")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()}
        alphabet = byte_alphabet()
        self.to_chars = {b: c for b, c in enumerate(alphabet)}
        back = {c: b for b, c in enumerate(alphabet)}
        self.raw = {i: bytes(back[c] for c in t) for i, t in self.names.items()}
        self.raw.update({i: t.encode() for t, i in self.special.items()})
        self.rank = dict.fromkeys(self.names, -1)  # when a token is made; single bytes are there from the start
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (self.ids[a], self.ids[b]), self.ids[a + b]
            if whole in self.halves:
                raise ValueError("a token with two merges")
            self.joined[pair], self.rank[whole], self.halves[whole] = rank, rank, pair
        self.fits: dict[tuple[int, int], bool] = {}
        self.sound: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            if (i in self.halves or len(token) == 1) and self.is_sound(i):
                self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self.cut = regex.compile(PIECES)
        self.code = "H" if max(self.raw) < 1 << 16 else "I"
        self.listed = {i: str(i) for i in self.raw}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def is_sound(self, token: int) -> bool:
        """Whether the merge loop makes this token from its own bytes."""
        found = self.sound.get(token)
        if found is None:
            pair = self.halves.get(token)
            found = pair is None or (self.is_sound(pair[0]) and self.is_sound(pair[1]) and self.compatible(*pair, self.rank[token]))
            self.sound[token] = found
        return found

    def compatible(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether no merge (of a rank less than ``below``) joins symbols across the border of two tokens.

        The symbols at the border are undone from the latest merge back. While a pair of them stands, it would be joined if
        its own merge comes before the one that ends either symbol; of equal merges the one further left comes first.
        """
        key = (left, right)
        if below is None and (found := self.fits.get(key)) is not None:
            return found
        rank, until, fit = self.rank, (1 << 60) if below is None else below, True
        while True:
            joins = self.joined.get((left, right))
            if joins is not None and joins < until:
                fit = False
                break
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                break
            if a > b:
                until, left = a, self.halves[left][1]
            else:
                until, right = b + 1, self.halves[right][0]
        if below is None:
            if len(self.fits) >= CACHED_PAIRS:
                self.fits.clear()
            self.fits[key] = fit
        return fit

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece, given in the byte alphabet."""
        n = len(piece)
        last, start = [0] * (n + 1), [-1] * (n + 1)
        start[0] = 0
        compatible, fits = self.compatible, self.fits
        for end, (size, token) in self.automaton.iter(piece):
            to = end + 1
            if start[to] >= 0:
                continue  # found: there is only one
            at = to - size
            if at:
                fit = fits.get((last[at], token))
                if not (compatible(last[at], token) if fit is None else fit):
                    continue
            last[to], start[to] = token, at
        out = []
        while n:
            out.append(last[n])
            n = start[n]
        out.reverse()
        return out

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = array(self.code, self.encode_piece(piece.encode().decode("latin-1").translate(self.to_chars))).tobytes()
            _keep(self.pieces, piece, found, CACHED_PIECES)
        return found

    def _word(self, word: str) -> bytes:
        found = b"".join(map(self._piece, self.cut.findall(word)))
        _keep(self.words, word, found, CACHED_WORDS)
        return found

    def _found(self, text: str) -> bytes:
        """Ids of the text, from parts that are cut alike when they stand alone.

        Where every blank is a space or line break before something visible, a cut is before each blank, and the parts
        are words whose ids are kept.
        """
        if self.specials is not None and self.specials.search(text):
            parts = [x for x in self.specials.split(text) if x]
            return b"".join(array(self.code, [self.special[x]]).tobytes() if x in self.special else self._found(x) for x in parts)
        if _uneven(text):
            return b"".join(map(self._piece, self.cut.findall(text)))
        words = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._word(w) if x is None else x for w, x in zip(words, found, strict=True)]
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return array(self.code, self._found(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and hashes of the listed ids and of the text decoded from them."""
        ids = self.encode(text)
        listed = ",".join(map(self.listed.__getitem__, ids)).encode()
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()


def _keep(kept: dict[str, bytes], key: str, found: bytes, most: int) -> None:
    if len(key) <= LONGEST_CACHED:
        if len(kept) >= most:
            kept.clear()
        kept[key] = found


_encoders: dict[str, Encoder] = {}
keeps(__name__, _encoders.clear)


def encoder(path: str) -> Encoder:
    """One encoder per process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per row of ``docs``.

    ``path``: a byte-level tokenizer file that every executor can open. Null texts count as empty and have no ids; repeated
    rows get a row each; an empty table gives none. A text of any length is encoded whole, in time linear in its length.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for piece in slices(batches):
            found = [enc.digest(x) for x in piece.column("text").to_pylist()]
            n, ids, decoded = zip(*found, strict=True)
            yield pa.RecordBatch.from_pydict({
                "doc_id": piece.column("id"), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string()),
            })

    kind = dict(docs.dtypes)[id_col]
    return mapped(texts_of(docs, id_col, text_col), encode, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids themselves, one row per row of ``docs``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for piece in slices(batches):
            ids = [np.array(enc.encode(x), np.int32) for x in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return mapped(texts_of(docs, id_col, text_col), encode, f"doc_id {dict(docs.dtypes)[id_col]}, ids array<int>")


def decode_ids(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [enc.decode(x or []) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return mapped(rows.select(id_col, ids_col), decode, f"doc_id {dict(rows.dtypes)[id_col]}, text string")
