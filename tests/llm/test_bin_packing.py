"""Best-fit packing: the search on counts, the placing of pieces, and ids against the library."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import clashing, odd_rows, table
from tributary.llm import binpack, completion

PATH = public_tokenizers.path("byte_bpe_50k.json")


def counted(lengths, size):
    return [lengths.count(x) for x in range(size + 1)]


def filled(fillings, size):
    """Counts by length of what the fillings hold; each fits."""
    out = [0] * (size + 1)
    for times, items in fillings:
        assert times > 0 and 0 < sum(x * k for x, k in items) <= size and len({x for x, _ in items}) == len(items)
        for x, k in items:
            out[x] += times * k
    return out


def fewest_bins(lengths, size):
    """By all ways to split the items into bins."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, rooms[:j] + (rooms[j] - lengths[i],) + rooms[j + 1 :])
        place(i + 1, rooms + (size - lengths[i],))

    lengths = sorted(lengths, reverse=True)
    place(0, ())
    return best


def plain_best_fit(lengths, size):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= x]
        if fitting:
            rooms.remove(min(fitting))
        rooms.append((min(fitting) if fitting else size) - x)
    return len(rooms)


def test_search_against_all_solutions():
    rng = random.Random(5)
    for _ in range(150):
        size = rng.choice([7, 10, 20])
        lengths = [rng.randrange(1, size + 1) for _ in range(rng.randrange(9))]
        left = counted(lengths, size)
        found = completion.complete(left, size)
        assert filled(found, size) == left and completion.bins_of(found) == fewest_bins(lengths, size)
        assert completion.lower_bound(left, size) <= fewest_bins(lengths, size)


def test_best_fit_is_the_incumbent_and_never_beaten_by():
    rng = random.Random(6)
    for spread in [(1, 60), (20, 45), (30, 61), (5, 9)]:
        for n in (30, 200):
            lengths = [rng.randrange(*spread) for _ in range(n)]
            left = counted(lengths, 60)
            by_fit, found = completion.best_fit(left, 60), completion.complete(left, 60, nodes=200)
            assert filled(by_fit, 60) == left == filled(found, 60)
            assert completion.bins_of(by_fit) == plain_best_fit(lengths, 60)
            assert completion.lower_bound(left, 60) <= completion.bins_of(found) <= completion.bins_of(by_fit)


def test_search_beats_best_fit():
    lengths = [44] * 10 + [24, 23] * 20 + [12, 11, 9] * 30  # 44+24+12+11+9 and 44+23+... fill bins of 100
    found = completion.complete(counted(lengths, 100), 100)
    assert completion.bins_of(found) <= plain_best_fit(lengths, 100)
    hard = [6] * 3 + [5] * 2 + [4, 4] * 2  # best fit leaves gaps
    assert completion.bins_of(completion.complete(counted(hard, 13), 13)) == fewest_bins(hard, 13)


def test_dominance():
    assert completion.dominates(((10, 1),), ((6, 1), (4, 1))) and completion.dominates(((5, 2),), ((5, 1), (3, 1)))
    assert not completion.dominates(((6, 1), (4, 1)), ((10, 1),)) and not completion.dominates(((5, 2),), ((4, 2), (2, 1)))


@pytest.mark.parametrize("counts", [[0, 10**12, 0, 3, 10**11, 5], [0] * 6, [0, 0, 0, 0, 0, 7], [0, 4, 0, 0, 0, 0]])
def test_huge_counts_and_places(counts):
    fillings = completion.complete(counts, 5)
    assert filled(fillings, 5) == counts
    places = binpack.Places(fillings, counts)
    seen = {}
    for length, n in enumerate(counts):
        some = np.array(sorted({*range(min(n, 4)), *range(max(n - 4, 0), n), *range(n // 2, min(n // 2 + 3, n))}), np.int64)
        if len(some):
            for s, o in zip(*(x.tolist() for x in places.find(np.full(len(some), length), some)), strict=True):
                assert 0 <= s < completion.bins_of(fillings) and o + length <= 5
                for at in range(o, o + length):
                    assert (s, at) not in seen
                    seen[s, at] = length


def test_ids_equal_the_library():
    library, own, rng = Tokenizer.from_file(PATH), binpack.ByteIds(PATH), random.Random(2)
    assert own.fast is not None and binpack.ByteIds(public_tokenizers.path("word_bpe_49k.json")).fast is None
    letters = " \n\t aeinot's'll.,0123ÉßΣİ́漢\x1c\x85<|endoftext|>^"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)] + ["ab" * 4000, " " * 900, "<|endoftext|>a <|endoftext|>"]
    for text in texts + [t for _, t in odd_rows() if t]:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("size", [64, 2048])
def test_packing_of_whole_documents(spark, size):
    library = Tokenizer.from_file(PATH)
    rows = odd_rows() + [(900, "x " * 600_000), (901, None)]  # 1.2 MB
    got = [r.asDict() for r in binpack.pack_whole(clashing(table(spark, rows, parts=4)), PATH, size=size).collect()]
    for _, some in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in some:
            assert r["offset"] == at and zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
            at += r["length"]
        assert 0 < at <= size
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % size + 1
        cuts = [0, *range(first, len(ids) + 1, size)]
        want += [(i, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()) for k, (a, b) in enumerate(itertools.pairwise(cuts))]
    assert sorted(map(str, ((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got))) == sorted(map(str, want))
    lengths = [w[3] for w in want]
    assert len({r["sequence_id"] for r in got}) <= plain_best_fit(lengths, size)
    assert not binpack.pack_whole(table(spark, rows).limit(0), PATH).count()
