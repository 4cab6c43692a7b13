"""Brute-force versions and small tables."""

import collections
import hashlib
import math
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def odd_rows():
    """(doc_id, text): nulls, empty, blank, a very long text, copies, near copies, repeated rows and repeated ids."""
    rng = random.Random(5)
    words = ["alpha", "Béta", "gamma", "delta", "omega", "zeta", "eta", "theta", "iota", "kappa", "漢字", "ß", "x1", "y,"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    base, passage = prose(120), prose(40)
    near = base.split(" ")
    near[60] = "changed"
    rows = [(7, base), (3, base), (9, " ".join(near)), (4, prose(60) + " " + passage + "\n" + prose(30)), (11, prose(20) + passage)]
    rows += [(20 + i, prose(rng.randrange(1, 90))) for i in range(15)]
    rows += [(50, None), (51, ""), (52, " \n\t "), (None, base), (None, prose(50)), (None, None), (60, "one"), (61, "One"), (62, "one two")]
    rows += [(70, "la " * 4000), (71, prose(6000)), (4, prose(45)), (7, base), (80, passage + passage)]
    return rows


def table(spark, rows, schema="doc_id bigint, text string", parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def clashing(docs):
    """Extra columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = ["id", "kept", "spans", "score", "ord", "print", "row", "found", "n", "key", "node", "toxic", "host", "part", "ids", "gram", "_id", "start"]
    return docs.withColumns({x: F.lit(f"own {x}") for x in names})


def shingles(text, size):
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def components(rows, size, percent):
    """Smallest id reachable by links, by (id, text)."""
    keys = sorted({(i is None, i or 0, t or "") for i, t in rows})
    sets = [shingles(k[2], size) for k in keys]
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    lowest = {}
    for k, key in enumerate(keys):
        if not key[0]:
            root = find(k)
            lowest[root] = min(lowest.get(root, key[1]), key[1])
    return {(None if k[0] else k[1], k[2]): (len(sets[i]), lowest.get(find(i))) for i, k in enumerate(keys)}


def removed(documents, window):
    """Per document (given in order): bytes covered by a string of ``window`` bytes that starts earlier."""
    seen, out = set(), []
    for text in documents:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - window + 1):
            w = raw[p : p + window]
            if w in seen:
                gone[p : p + window] = b"\1" * window
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def backoff_scores(rows, order, least, backoff):
    docs = [(i, WORD.findall((t or "").translate(FOLD))) for i, t in rows]
    single = collections.Counter(w for _, ws in docs for w in ws)
    total = sum(single.values())
    seen = [None] + [collections.Counter(tuple(ws[k : k + n]) for _, ws in docs for k in range(len(ws) - n + 1)) for n in range(1, order + 1)]

    def score(g):
        if len(g) == 1:
            return math.log10(seen[1][g] / total)
        if seen[len(g)][g] >= least:
            return math.log10(seen[len(g)][g] / seen[len(g) - 1][g[:-1]])
        return math.log10(backoff) + score(g[1:])

    return [
        (i, len(ws), sum(score(tuple(ws[max(0, k - order + 1) : k + 1])) for k in range(len(ws))) / len(ws) if ws else None) for i, ws in docs
    ]
