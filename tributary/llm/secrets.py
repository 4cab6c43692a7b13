"""Secret scans: Boolean trigram queries from regular expressions, postings per shard, verification of candidates."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.arrow import bytes_of, mapped, slices, texts_of

#: More alternatives than this are not spelled out.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Query:
    """Trigrams that any matching text must hold: a trigram, all or any of some parts; ``every`` holds for every text."""

    kind: str
    parts: tuple = ()

    def trigrams(self) -> set[bytes]:
        if self.kind == "gram":
            return {self.parts[0]}
        return set().union(*(p.trigrams() for p in self.parts)) if self.parts else set()


EVERY = Query("every")


def _all(parts: Sequence[Query]) -> Query:
    needed = tuple(dict.fromkeys(p for p in parts if p != EVERY))
    return EVERY if not needed else needed[0] if len(needed) == 1 else Query("all", needed)


def _any(parts: Sequence[Query]) -> Query:
    if EVERY in parts:
        return EVERY
    needed = tuple(dict.fromkeys(parts))
    return needed[0] if len(needed) == 1 else Query("any", needed)


def _spelled(strings: frozenset[str]) -> Query:
    """What a text that holds one of ``strings`` must hold."""
    folded = [x.encode().lower() for x in sorted(strings)]
    return _any([_all([Query("gram", (x[i : i + 3],)) for i in range(len(x) - 2)]) for x in folded]) if folded else EVERY


def _walk(items, flags: int) -> tuple[frozenset[str] | None, Query]:
    """The strings an expression spells, if they are few, and the query of its parts otherwise."""
    strings: frozenset[str] | None = frozenset({""})
    whole, needed = True, []
    for op, arg in items:
        spelled, query = _node(str(op), arg, flags)
        joined = frozenset(a + b for a in strings for b in spelled) if spelled is not None else frozenset()
        if spelled is not None and len(joined) <= MOST_STRINGS:
            strings = joined
            continue
        whole = False
        needed += [_spelled(strings), query if spelled is None else EVERY]
        strings = frozenset({""}) if spelled is None else spelled
    return (strings, EVERY) if whole else (None, _all([*needed, _spelled(strings)]))


def _folds_widely(char: str, flags: int) -> bool:
    """Whether a character in any case may stand for others than A-Z folding tells: k and s have such, and all beyond ASCII may."""
    return bool(flags & re.IGNORECASE) and (not char.isascii() or (not flags & re.ASCII and char in "kKsS"))


def _node(op: str, arg, flags: int) -> tuple[frozenset[str] | None, Query]:
    if op == "LITERAL":
        return (None, EVERY) if _folds_widely(chr(arg), flags) else (frozenset({chr(arg)}), EVERY)
    if op == "IN" and all(str(o) == "LITERAL" and not _folds_widely(chr(c), flags) for o, c in arg):
        return frozenset(chr(c) for _, c in arg), EVERY
    if op == "SUBPATTERN":
        return _walk(arg[3], flags)
    if op == "BRANCH":
        found = [_walk(b, flags) for b in arg[1]]
        if all(s is not None for s, _ in found):
            return frozenset().union(*(s for s, _ in found)), EVERY
        return None, _any([q if s is None else _spelled(s) for s, q in found])
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, inner = arg
        spelled, query = _walk(inner, flags)
        if spelled is not None and int(low) == 0 and int(high) == 1:
            return spelled | {""}, EVERY
        if spelled is not None and int(low) == int(high) == 1:
            return spelled, EVERY
        if int(low) == 0:
            return None, EVERY
        return None, query if spelled is None else _spelled(spelled)
    return (frozenset({""}), EVERY) if op == "AT" else (None, EVERY)


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """The query of a regular expression, on UTF-8 bytes with A-Z folded."""
    spelled, query = _walk(re._parser.parse(pattern, flags), flags)
    return query if spelled is None else _spelled(spelled)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = 0

    @cached_property
    def query(self) -> Query:
        return trigram_query(self.pattern, self.flags)

    @cached_property
    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, self.flags)

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.compiled.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


ANY_CASE = re.IGNORECASE | re.ASCII
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, ANY_CASE),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # a run of a class is a match as a whole: asking for 16 characters at once drops the same ones
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
MORE_RULES = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


class Postings:
    """Inverted index of one shard: for every wanted trigram the numbers of the texts that hold it, in order."""

    def __init__(self, flat: np.ndarray, ends: np.ndarray, wanted: np.ndarray):
        self.texts = len(ends) - 1
        lower = np.where((flat >= 65) & (flat <= 90), flat | 32, flat).astype(np.uint32)
        codes = lower[:-2] << 16 | lower[1:-1] << 8 | lower[2:] if len(flat) > 2 else np.zeros(0, np.uint32)
        at = np.flatnonzero(wanted[codes])
        owner = np.searchsorted(ends, at, "right") - 1
        inside = at + 3 <= ends[owner + 1]
        pairs = np.unique(codes[at[inside]].astype(np.int64) << 32 | owner[inside])
        self.codes, self.owners = pairs >> 32, pairs & 0xFFFFFFFF

    def of(self, gram: bytes) -> np.ndarray:
        code = int.from_bytes(gram, "big")
        return self.owners[np.searchsorted(self.codes, code) : np.searchsorted(self.codes, code, "right")]

    def answer(self, query: Query) -> np.ndarray:
        """Numbers of the texts that satisfy a query, in order."""
        if query.kind == "every":
            return np.arange(self.texts)
        if query.kind == "gram":
            return self.of(query.parts[0])
        found = [self.answer(p) for p in query.parts]
        if query.kind == "any":
            return np.unique(np.concatenate(found))
        found.sort(key=len)  # the shortest list first
        out = found[0]
        for x in found[1:]:
            out = np.intersect1d(out, x, assume_unique=True)
        return out


def wanted_trigrams(rules: Sequence[Rule]) -> np.ndarray:
    wanted = np.zeros(1 << 24, bool)
    for rule in rules:
        for gram in rule.query.trigrams():
            wanted[int.from_bytes(gram, "big")] = True
    return wanted


def scan_shard(values: pa.Array, rules: Sequence[Rule], wanted: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, rule, end) of all secrets of each text: postings answer a rule's query, its texts are searched."""
    index = Postings(*bytes_of(values), wanted)
    texts = values.to_pylist()
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, rule in enumerate(rules):
        for i in index.answer(rule.query).tolist():
            found[i] += [(a, k, b) for a, b in rule.spans(texts[i])]
    for x in found:
        x.sort()
    return found


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): the secrets of every row of ``docs`` as (kind, start, end) in code points, by start and then rule.

    The rows of a task are indexed in shards of a few MB: postings of the trigrams that some rule asks for. A rule's query
    is answered by merging postings and only the texts it returns are searched with the expression; a rule without a
    mandatory trigram searches them all. A shard needs nothing from others, so nothing is shuffled.

    Null texts count as empty and have no secrets; repeated rows get a row each; an empty table gives none; columns
    beside the two named are ignored.
    """
    listed = tuple(rules)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = wanted_trigrams(listed)
        for piece in slices(batches):
            found = scan_shard(piece.column("text"), listed, wanted)
            spans = [[{"kind": listed[k].kind, "start": a, "end": b} for a, k, b in x] for x in found]
            yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(spans, pa.list_(span))], names=["doc_id", "found"])

    kind = dict(docs.dtypes)[id_col]
    return mapped(texts_of(docs, id_col, text_col), scan, f"doc_id {kind}, found array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every secret's characters replaced by ``mark``; overlapping secrets make one mark, null texts stay null."""
    listed = tuple(rules)

    def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for start, _, end in spans:
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = wanted_trigrams(listed)
        for piece in slices(batches, text_col):
            values = piece.column(text_col)
            found = scan_shard(values.fill_null(""), listed, wanted)
            texts = [x if not f else clean(x, f) for x, f in zip(values.to_pylist(), found, strict=True)]
            at = piece.schema.get_field_index(text_col)
            yield piece.set_column(at, piece.schema.field(at), pa.array(texts, values.type))

    return mapped(docs, scan, docs.schema)
