"""Removal of long repeated strings, exact over all documents, by suffix arrays of the places that can hold repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.anchors import GRAM, pieces
from tributary.llm.anchors import segments as segments_of
from tributary.llm.arrow import as_row, bytes_of, mapped, mix, slices
from tributary.llm.suffixes import equal_windows
from tributary.session import discard, materialize

WINDOW = 100
#: Bytes in a suffix array shard, and the most different parts under one key that share a shard.
SHARD, GROUP = 1 << 19, 4096
#: Bytes of text whose segments are compared before they are sent.
TOGETHER = 8 << 20
#: Where a document stands: its id (rows without one come last), a hash of its text, and a byte.
AT = ("ord", "print", "start")
LAST_ID = (1 << 63) - 1


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, ord, print, text) with null texts as empty ones; ``print`` tells apart rows that share an id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("ord"),
        F.xxhash64(text).alias("print"), text.alias("text"),
    )


def _segment_rows(batch: pa.RecordBatch, window: int) -> dict[str, np.ndarray]:
    """Segments of all texts of a batch, in the order of their places."""
    flat, ends = bytes_of(batch.column("text"))
    found: dict[str, list[np.ndarray]] = {k: [] for k in ("gram", "content", "ord", "print", "start", "n")}
    ids, prints = batch.column("ord").to_numpy(), batch.column("print").to_numpy()
    for first, own in pieces(ends, window):
        gram, content, start, n = segments_of(flat[first : first + int(own[-1])], own, window)
        text = np.searchsorted(ends, start + first, "right") - 1
        for k, x in zip(found, (gram, content, ids[text], prints[text], start + first - ends[text], n), strict=True):
            found[k].append(x)
    out = {k: np.concatenate(x) if x else np.zeros(0, np.int64) for k, x in found.items()}
    order = np.lexsort((out["start"], out["print"], out["ord"], out["content"], out["gram"]))
    return {k: x[order].view(np.int64) for k, x in out.items()}


def _same_as_before(rows: dict[str, np.ndarray], names: tuple[str, ...]) -> np.ndarray:
    same = np.ones(len(rows[names[0]]), bool)
    same[:1] = False
    for k in names:
        same[1:] &= rows[k][1:] == rows[k][:-1]
    return same


def _spans(rows: dict[str, np.ndarray], keep: np.ndarray, window: int) -> pa.RecordBatch:
    """(ord, print, begin, end) of chosen rows, those that touch in a document merged."""
    order = np.flatnonzero(keep)
    order = order[np.lexsort((rows["start"][order], rows["print"][order], rows["ord"][order]))]
    a, p, s = rows["ord"][order], rows["print"][order], rows["start"][order]
    e = s + rows["n"][order] + window - 1
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1]) | (s[1:] > e[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a))[: len(first)] - 1
    columns = [a[first], p[first], s[first], e[last]] if len(a) else [np.zeros(0, np.int64)] * 4
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["ord", "print", "begin", "end"])


SPAN = "ord long, print long, begin long, end long"


def _segments(texts: DataFrame, window: int) -> DataFrame:
    """Segments of all texts, the first of equal ones in some MB; and, marked ``repeated``, the spans of the others there.

    This is what keeps copies and common passages from meeting in one task: of equal segments only one is sent. Both kinds are
    from one scan and written together: another scan may cut the texts into other batches and miss what this one left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, limit=TOGETHER):
            rows = _segment_rows(piece, window)
            again = _same_as_before(rows, ("gram", "content"))
            # a row that is itself repeated has its places twice; those don't repeat each other
            first = np.maximum.accumulate(np.where(again, 0, np.arange(len(again)))) if len(again) else again
            moved = np.zeros(len(again), bool)
            for k in AT:
                moved |= rows[k] != rows[k][first]
            spans = _spans(rows, again & moved, window)
            count = spans.num_rows
            yield pa.RecordBatch.from_pydict({**{k: pa.array(x[~again]) for k, x in rows.items()}, "repeated": pa.array(np.zeros(int((~again).sum()), bool))})
            begin, end = (spans.column(k).to_numpy() for k in ("begin", "end"))
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.nulls(count, pa.int64()), "content": pa.nulls(count, pa.int64()), "ord": spans.column("ord"), "print": spans.column("print"),
                    "start": pa.array(begin), "n": pa.array(end - begin - (window - 1)), "repeated": pa.array(np.ones(count, bool)),
                }
            )

    schema = "gram long, content long, ord long, print long, start long, n long, repeated boolean"
    return materialize(mapped(texts.select("ord", "print", "text"), cut, schema), "segments")


def _place() -> Column:
    return F.struct(*AT)


def _judged(rows: DataFrame, key: str) -> DataFrame:
    """Rows of keys with several rows: ``later`` if an equal ``content`` stands earlier, ``several`` contents under the key or not.

    A sort within hash partitions. The two windows without order hold a key's rows, spilling beyond memory; of equal rows in 8 MB
    of text only one comes here.
    """
    whole = Window.partitionBy(key)
    inside = Window.partitionBy(key).orderBy("content", *AT)
    before = [F.lag(c).over(inside).alias(f"_{c}") for c in ("content", *AT)]
    marked = rows.select("*", F.min("content").over(whole).alias("_lo"), F.max("content").over(whole).alias("_hi"), *before)
    follows = F.col("_content").eqNullSafe(F.col("content"))
    same = follows & (F.col("_ord") == F.col("ord")) & (F.col("_print") == F.col("print")) & (F.col("_start") == F.col("start"))
    kept = marked.where(follows | (F.col("_lo") != F.col("_hi")))
    # the place twice over, once from each of two equal rows, is no repeat unless something earlier is: then both rows follow it
    return kept.withColumn("several", F.col("_lo") != F.col("_hi")).withColumn("later", follows & ~same).drop("_lo", "_hi", *[f"_{c}" for c in ("content", *AT)])


def _parts(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(key, content, ord, print, start, n, body): the bytes of wanted segments, halved by where the anchor stands in a window.

    In one half of a segment's windows the anchor has half of the other bytes before it, in the other half behind it. A key
    is the anchor with those bytes, so that parts under one key have much in common and most keys have one part.
    """
    half = (window - GRAM + 1) // 2
    # a set: copies under one id want the same segments, and each copy is cut for itself
    by_doc = wanted.groupBy("ord", "print").agg(F.collect_set(F.struct("gram", "start", "n")).alias("wanted"))
    joined = texts.join(by_doc, ["ord", "print"]).select("ord", "print", "text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            flat, ends = bytes_of(piece.column("text"))
            raw = flat.tobytes()
            lists = piece.column("wanted")
            owner = np.repeat(np.arange(piece.num_rows), np.diff(offsets_of_list(lists)))
            inner = lists.flatten()
            gram, begin, n = (inner.field(k).to_numpy() for k in ("gram", "start", "n"))
            begin = begin + ends[owner]
            anchor = _anchors(flat, begin, n, gram, window)
            lists_out: dict[str, list] = {"key": [], "row": [], "start": [], "n": [], "body": []}
            # offsets of the anchor in the segment's windows go from its place in the first one down
            most, least = anchor - begin, anchor - begin - n + 1
            for side, top, low in (("left", most, np.maximum(least, half)), ("right", np.minimum(most, half - 1), least)):
                some = np.flatnonzero(top >= low)
                a = anchor[some]
                start, count = a - top[some], (top - low + 1)[some]
                context = (a - half, a + GRAM) if side == "left" else (a, a + GRAM + window - GRAM - half + 1)
                lists_out["key"] += [side[:1].encode() + raw[x:y] for x, y in zip(*(c.tolist() for c in context), strict=True)]
                lists_out["body"] += [raw[x:y] for x, y in zip(start.tolist(), (start + count + window - 1).tolist(), strict=True)]
                lists_out["row"] += owner[some].tolist()
                lists_out["start"] += (start - ends[owner[some]]).tolist()
                lists_out["n"] += count.tolist()
            row = np.array(lists_out["row"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_hash(x) for x in lists_out["key"]], pa.int64()), pa.array([_hash(x) for x in lists_out["body"]], pa.int64()),
                    piece.column("ord").take(pa.array(row)), piece.column("print").take(pa.array(row)),
                    pa.array(lists_out["start"], pa.int64()), pa.array(lists_out["n"], pa.int64()), pa.array(lists_out["body"], pa.binary()),
                ],
                names=["key", "content", "ord", "print", "start", "n", "body"],
            )

    return mapped(joined, cut, "key long, content long, ord long, print long, start long, n long, body binary")


def offsets_of_list(values: pa.ListArray) -> np.ndarray:
    raw = values.offsets.to_numpy()
    return raw - raw[0]


def _hash(x: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)


def _anchors(flat: np.ndarray, begin: np.ndarray, n: np.ndarray, gram: np.ndarray, window: int) -> np.ndarray:
    """Where the anchor of each segment stands: the first place from its last window on with the anchor's hash."""
    scale, size = np.uint64(0x9E3779B97F4A7C15), 1
    h = flat.astype(np.uint64) + np.uint64(1)
    while size < GRAM:
        h = h[:-size] * scale + h[size:]
        with np.errstate(over="ignore"):
            scale = scale * scale
        size *= 2
    h = mix(h).view(np.int64)
    out, left, step = np.full(len(begin), -1, np.int64), np.arange(len(begin)), 0
    while len(left):
        at = begin[left] + n[left] - 1 + step
        hit = h[at] == gram[left]
        out[left[hit]] = at[hit]
        left, step = left[~hit], step + 1
    return out


def _repeats_in_shards(parts: DataFrame, window: int) -> DataFrame:
    """Spans of windows that stand earlier in another part under their key: a suffix array for each shard of whole keys."""

    def judge(rows: list[tuple]) -> pa.RecordBatch:
        group, part, place = equal_windows([r[-1] for r in rows], window)
        at = {k: np.array([r[i] for r in rows], np.int64)[part] for i, k in ((1, "ord"), (2, "print"), (3, "start"))}
        at["start"] = at["start"] + place
        at["n"] = np.ones(len(part), np.int64)
        valid = place < np.array([r[4] for r in rows], np.int64)[part] if len(rows) else np.zeros(0, bool)
        at, group = {k: x[valid] for k, x in at.items()}, group[valid]
        order = np.lexsort((at["start"], at["print"], at["ord"], group))
        at, group = {k: x[order] for k, x in at.items()}, group[order]
        new = np.ones(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(group)), 0)) if len(group) else new
        moved = np.zeros(len(group), bool)
        for k in AT:
            moved |= at[k] != at[k][first]
        return _spans(at, moved, window)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # whole keys
        open_rows: list[tuple] = []
        size = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "ord", "print", "start", "n", "body")]
            for row in zip(*columns, strict=True):
                if open_rows and open_rows[0][0] != row[0]:
                    if len(open_rows) > 1:
                        held += open_rows
                        size += sum(len(r[-1]) for r in open_rows)
                        if size >= SHARD:
                            yield judge(held)
                            held, size = [], 0
                    open_rows = []
                open_rows.append(row)
        if len(open_rows) > 1:
            held += open_rows
        if held:
            yield judge(held)

    keyed = parts.select("key", "ord", "print", "start", "n", "body")
    return mapped(keyed.repartition("key").sortWithinPartitions("key", *AT), shards, SPAN)


def _repeats_of_windows(parts: DataFrame, window: int) -> DataFrame:
    """The same for keys with more parts than a shard takes: their windows one by one, joined with the first of equal ones."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(iter([batch]), "body", 1 << 18):
                n = piece.column("n").to_numpy()
                row = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                bodies = piece.column("body").to_pylist()
                prints = [hashlib.blake2b(bodies[r][k : k + window], digest_size=16).digest() for r, k in zip(row.tolist(), place.tolist(), strict=True)]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints, pa.binary()), piece.column("ord").take(take), piece.column("print").take(take), pa.array(piece.column("start").to_numpy()[row] + place)],
                    names=["window", "ord", "print", "start"],
                )

    windows = materialize(mapped(parts.select("ord", "print", "start", "n", "body"), cut, "window binary, ord long, print long, start long"), "windows")
    first = windows.groupBy("window").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    later = windows.join(first, "window").where(_place() != F.col("first"))
    return later.select("ord", "print", F.col("start").alias("begin"), (F.col("start") + window).alias("end"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ord, print, begin, end): byte spans of each document that strings of ``window`` bytes with an earlier start cover.

    Spans of one document may touch or overlap. Every window is named by one of its short strings, by content alone, so equal
    windows have equal names. Runs of windows with one name are compared as wholes first; of those that differ under a
    shared name, shards of whole names get a suffix array each, by induced sorting, and windows that share
    ``window`` bytes with their neighbours in it are repeats of the earliest among them.
    """
    if window < 2 * GRAM:
        raise ValueError(f"windows must have {2 * GRAM} bytes or more")
    texts = _numbered(docs, id_col, text_col)
    long = texts.where(F.octet_length("text") >= window)
    segments = _segments(long, window)
    found = materialize(_judged(segments.where(~F.col("repeated")).drop("repeated"), "gram"), "shared")
    tail = F.col("start") + F.col("n") + (window - 1)
    spans = found.where("later").select("ord", "print", F.col("start").alias("begin"), tail.alias("end"))
    again = segments.where("repeated").select("ord", "print", F.col("start").alias("begin"), tail.alias("end"))
    spans = spans.unionByName(materialize(again, "repeated-spans"))
    discard(segments)  # the largest table; what is left of it is written
    parts = _parts(long, found.where("several and not later"), window)
    parts = materialize(parts, "parts")
    # of equal parts the first goes on; the others repeat it
    judged = materialize(_judged(parts.drop("body"), "key"), "judged")
    spans = spans.unionByName(judged.where("later").select("ord", "print", F.col("start").alias("begin"), tail.alias("end")))
    open_parts = judged.where("several and not later").select("key", *AT, "n")
    crowded = open_parts.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > GROUP).select("key")
    bodies = parts.join(open_parts, ["key", *AT, "n"], "left_semi")
    crowded = materialize(crowded, "crowded")
    if crowded.isEmpty():
        return spans.unionByName(_repeats_in_shards(bodies, window))
    spans = spans.unionByName(_repeats_in_shards(bodies.join(crowded, "key", "left_anti"), window))
    return spans.unionByName(_repeats_of_windows(bodies.join(crowded, "key", "left_semi"), window))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["begin"], x["end"]) for x in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _with_spans(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(row, text, spans): the other columns of each row of ``docs``, its text and what to take out of it."""
    spans = repeated_spans(docs, window, id_col, text_col)
    by_doc = spans.groupBy("ord", "print").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        as_row(docs.drop(text_col)), F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("ord"), F.xxhash64(text).alias("print")
    )
    return keyed.join(by_doc, ["ord", "print"], "left").select("row", "text", "spans")


def repeat_digests(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    Texts are UTF-8 bytes. A byte goes if a string of ``window`` bytes over it also starts earlier: in a document with a smaller
    id, or earlier in its own. Ids are integers; rows without id come after all others, in the order of a hash of their
    texts, as do different texts under one id. A repeated row is the same document and doesn't repeat itself. Null texts
    count as empty and keep their nothing; an empty table gives no rows; other columns are ignored.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = _with_spans(named, window, "doc_id", "text")
    rows = rows.select(F.col("row.doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "spans")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found = []
            for text, spans in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist(), strict=True):
                raw, gone, at, kept = (text or "").encode(), _merged(spans or []), 0, hashlib.sha256()
                for a, b in gone:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                found.append((len(raw), sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
            n, removed, count, kept_hash = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n, removed, count)], pa.array(kept_hash, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = dict(docs.dtypes)[id_col]
    return mapped(rows, digest, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated bytes taken out of their texts; a character that loses a byte goes as a whole. Nulls stay null."""
    rows = _with_spans(docs, window, id_col, text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            texts = []
            for text, spans in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist(), strict=True):
                if text is not None and spans:
                    raw, out, at = text.encode(), [], 0
                    for a, b in _merged(spans):
                        out.append(raw[at:a].decode("utf-8", "ignore"))
                        at = b
                    text = "".join([*out, raw[at:].decode("utf-8", "ignore")])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    kind = rows.schema["row"].dataType.simpleString()
    done = mapped(rows, clean, f"row {kind}, text string")
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
