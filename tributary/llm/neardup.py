"""Near-duplicates by MinHash: one permutation, optimal densification, banded buckets, star-shaped candidate edges."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrow import as_row, bytes_of, keeps, mapped, mix, slices, texts_of, words_in
from tributary.llm.graph import components
from tributary.session import materialize

#: Bins in a band. There are as many bands as it takes to miss a pair at the threshold less often than MISSED.
ROWS, MISSED = 5, 1e-8
#: Star rounds before what is left is compared directly, and classes of hashes that are told apart by their size then.
STARS, CLASSES, PARITIES = 2, 1 << 18, 512


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** ROWS)))


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct ``size``-word shingles, A-Z in lower case; of fewer words, one of them all."""
    flat, ends = bytes_of(texts)
    words, owner, _ = words_in(flat, ends, lower=True)
    h = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        h = mix(h + words[k : k + len(h)] + np.uint64(0x9E3779B97F4A7C15))
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(h[a : b - size + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix(whole * np.uint64(3) + words[k : k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_probes: dict[int, np.ndarray] = {}
keeps(__name__, _probes.clear)


def _probe(bins: int, attempt: int) -> np.ndarray:
    """Where each bin looks in its ``attempt``-th try: the same for all documents."""
    key = bins << 20 | attempt
    if key not in _probes:
        with np.errstate(over="ignore"):
            mixed = mix(np.arange(bins, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(attempt + 1) * np.uint64(0xA0761D6478BD642F))
        _probes[key] = (mixed % np.uint64(bins)).astype(np.int64)
    return _probes[key]


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One permutation cut into ``bins``: the least hash of each; an empty bin takes that of the first full bin its probes meet."""
    values = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    at = (values % np.uint64(bins)).astype(np.int64)
    out = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(out, at, values)
    full = np.zeros(bins, bool)
    full[at] = True
    empty, attempt, filled = np.flatnonzero(~full), 0, out.copy()
    while len(empty):
        target = _probe(bins, attempt)[empty]
        hit = full[target]
        filled[empty[hit]] = out[target[hit]]
        empty, attempt = empty[~hit], attempt + 1
        if attempt == 4 * bins:  # few full bins: take the next one, counted from the bin
            order = np.flatnonzero(full)
            filled[empty] = out[order[np.searchsorted(order, empty) % len(order)]]
            break
    return filled


def _bands(sig: np.ndarray, bands: int) -> np.ndarray:
    h = np.arange(bands, dtype=np.uint64)
    for k in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig.reshape(bands, ROWS)[:, k])
    return h.view(np.int64)


def _print_of(hashes: np.ndarray) -> bytes:
    """128 bits of a set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, size: int, bands: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, print, n_shingles, f1, f2, bands): a hash of the text, the set's size, its fingerprint and its band keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            sets = shingle_sets(piece.column("text"), size)
            prints = np.frombuffer(b"".join(map(_print_of, sets)), np.int64).reshape(-1, 2)
            keys = [_bands(signature(s, bands * ROWS), bands) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"), piece.column("print"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "print", "n_shingles", "f1", "f2", "bands"],
            )

    kind = dict(docs.dtypes)[id_col]
    texts = texts_of(docs, id_col, text_col).withColumn("print", F.xxhash64("text"))
    return mapped(texts, sketch, f"doc_id {kind}, print long, n_shingles long, f1 long, f2 long, bands array<bigint>")


def _sets_of(docs: DataFrame, nodes: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(node, set) of ``nodes``: recomputed from the text of one document each, so that sets are kept for candidates alone."""
    texts = texts_of(docs, id_col, text_col).withColumn("print", F.xxhash64("text"))
    # the hash of the text as well: of the rows without id, only those with the node's own text meet it
    wanted = texts.join(nodes.select("node", "label", F.col("print").alias("own"), "f1", "f2"), F.col("id").eqNullSafe(F.col("label")) & (F.col("print") == F.col("own")))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            sets = shingle_sets(piece.column("text"), size)
            prints = np.frombuffer(b"".join(map(_print_of, sets)), np.int64).reshape(-1, 2)
            # rows that share an id may have other texts
            own = (prints[:, 0] == piece.column("f1").to_numpy()) & (prints[:, 1] == piece.column("f2").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [piece.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "set"]
            ).filter(pa.array(own))

    found = mapped(wanted.select("node", "f1", "f2", "text"), compute, "node long, set binary")
    return materialize(found.dropDuplicates(["node"]), "sets")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "right"):
            keep = []
            for x, y in zip(piece.column("left").to_pylist(), piece.column("right").to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(s) + len(t) - len(np.union1d(s, t))
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            yield piece.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return mapped(both, check, "a long, b long")


def _prefixes(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, component, keys, b0, b1, ...): of each set its first hashes in an order from rare to frequent, as many as it
    can't do without, and the parities of its hashes in ``PARITIES`` classes as bits.

    Two sets at the threshold lack less than so many of each other's hashes, so they share one of these, whatever the order is.
    Hashes are ordered by the size of their class, of ``CLASSES``, over all sets; a passage that many share comes last.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column("set").to_pylist()), np.uint64)
            total += np.bincount((flat % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["class", "n"])

    here = materialize(nodes.join(sets, "node"), "unsettled-sets")
    sizes = np.zeros(CLASSES, np.int64)  # as many rows as classes at most
    found = mapped(here.select("set"), count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    sizes[found["class"].to_numpy()] = found["n"].to_numpy()
    sent = nodes.sparkSession.sparkContext.broadcast(sizes)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size_of = sent.value
        for piece in slices(batches, "set"):
            keys, bits = [], []
            for raw in piece.column("set").to_pylist():
                h = np.frombuffer(raw, np.uint64)
                order = np.lexsort((h, size_of[(h % np.uint64(CLASSES)).astype(np.int64)]))
                keys.append(h[order[: len(h) - -(-percent * len(h) // 100) + 1]].view(np.int64))
                odd = np.bincount((h >> np.uint64(40)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            out = piece.select(["node", "n", "component"]).append_column("keys", pa.array(keys, pa.list_(pa.int64())))
            for k, column in enumerate(np.array(bits).reshape(-1, PARITIES // 64).T):
                out = out.append_column(f"b{k}", pa.array(column))
            yield out

    parities = ", ".join(f"b{k} long" for k in range(PARITIES // 64))
    return materialize(mapped(here, first, f"node long, n long, component long, keys array<bigint>, {parities}"), "prefixes")


def _rest(joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, y, n, m): nodes of unsettled buckets that may still be linked with a node of another component.

    Under each key of the sets' prefixes, all but the members of its largest component are paired with those of others, if
    their sizes and the parities of their hashes allow the similarity: of two sets, no more parities differ than hashes.
    """
    told = _prefixes(joined.select("node", "n", "component").distinct(), sets, percent)
    keyed = told.select(F.explode("keys").alias("key"), "node", "component")
    sizes = keyed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top"), F.count(F.lit(1)).alias("of")).where("of > 1")
    open_ = materialize(keyed.join(main.select("key", F.col("top.component").alias("main")), "key"), "open")
    words = [f"b{k}" for k in range(PARITIES // 64)]
    full = told.select("node", "n", *words)
    minor = open_.where("component != main").join(full, "node").select("key", F.col("node").alias("x"), "component", "n", *words)
    other = open_.select("key", "node", F.col("component").alias("its")).join(full, "node")
    other = other.select("key", F.col("node").alias("y"), "its", F.col("n").alias("m"), *[F.col(w).alias("o" + w) for w in words])
    differ = sum((F.bit_count(F.col(w).bitwiseXOR(F.col("o" + w))) for w in words), F.lit(0))
    total = F.col("n") + F.col("m")
    near = (F.col("component") != F.col("its")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    near = near & (differ * (100 + percent) <= total * (100 - percent)) & (minor["key"] == other["key"])
    return minor.join(other, near).select("x", "y", "n", "m")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Two documents are linked if 100 * common shingles >= ``percent`` * all their shingles; ``component_id`` is the smallest id
    that links reach, ``kept`` whether it is the row's own.

    1. Documents with one set become one node, so copies cost nothing further.
    2. Band keys put nodes into buckets. In each bucket every member is paired with one centre only. Pairs are confirmed on
       full sets; confirmed links make components. A second round takes other centres where a bucket still has several.
    3. Members of buckets that still have several components are compared exactly: sets at the threshold share one of their
       rarest hashes, so only nodes that do are paired, and no link is lost to a badly chosen centre.

    A pair at the threshold shares no bucket with a chance below ``MISSED``. Null and empty texts have no shingles and are linked
    with nothing; rows with one id and one text share a verdict; rows without id are kept if their component has no id at
    all; an empty table gives no rows; other columns are ignored.
    """
    return _verdicts(docs, size, percent, id_col, text_col).drop("print")


def without_near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns; of rows with one id and one text, one."""
    kept = materialize(_verdicts(docs, size, percent, id_col, text_col).where("kept").select("doc_id", "print"), "kept")
    keys = kept.select(F.col("doc_id").alias("_id"), F.col("print").alias("_p")).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.select(as_row(docs), F.col(id_col).alias("id"), F.xxhash64(text).alias("print"))
    out = marked.join(keys, F.col("id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_p")), "left_semi")
    again = kept.groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    if not again.isEmpty():
        out = out.dropDuplicates(["id", "print"])
    return out.select("row.*")


def _verdicts(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` with ``print``."""
    bands = bands_for(percent)
    rows = materialize(sketches(docs, size, bands, id_col, text_col), "sketches")
    nodes = rows.where("n_shingles > 0").groupBy("f1", "f2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "print")).alias("least"), F.max("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
    ).select("f1", "f2", F.col("least.doc_id").alias("label"), F.col("least.print").alias("print"), "n", "bands")
    # numbered once, in a written table
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    members = materialize(members.join(shared, "key"), "members")
    in_play = members.select("node").distinct()
    sets = _sets_of(docs, nodes.join(in_play, "node", "left_semi"), size, id_col, text_col)

    def possible(pairs: DataFrame) -> DataFrame:
        """Distinct pairs with a < b whose sizes allow the similarity."""
        fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
        return pairs.where(fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    links = tested = None
    joined = members.withColumn("component", F.col("node"))
    for turn in range(STARS + 1):
        if turn < STARS:
            # the centre is the least node, in later rounds under a mask of the bucket's own
            mask = F.xxhash64("key", F.lit(turn)) if turn else F.lit(0).cast("long")
            centres = joined.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(mask)).alias("low"))
            centres = centres.select("key", F.col("low").bitwiseXOR(mask).alias("y"))
            found = joined.join(centres, "key").select(F.col("node").alias("x"), "y", "n", "key", "component")
            other = joined.select("key", F.col("node").alias("y"), F.col("n").alias("m"), F.col("component").alias("its"))
            pairs = found.where("x != y").join(other, ["key", "y"]).where("component != its")
        else:
            pairs = _rest(joined, sets, percent)
        pairs = possible(pairs)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = materialize(_linked(pairs, sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        of = components(links)
        if turn < STARS:
            placed = members.join(of, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
            several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
            joined = materialize(placed.join(several, "key"), "unsettled")
    named = nodes.select("node", "label", "f1", "f2").join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("label").alias("component_id"))
    verdict = named.join(least, "component").select("f1", "f2", "component_id")
    full = rows.where("n_shingles > 0").join(verdict, ["f1", "f2"]).select("doc_id", "print", "n_shingles", "component_id")
    empty = rows.where("n_shingles = 0").select("doc_id", "print", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
