"""Suffix arrays by induced sorting, and permuted common prefixes, on one shard of bytes in numpy."""

from __future__ import annotations

import numpy as np

from tributary.llm.arrow import _power, mix


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last character is the unique least."""
    n = len(t)
    differs = np.ones(n, bool)
    differs[:-1] = t[:-1] != t[1:]
    smaller = np.ones(n, bool)
    smaller[:-1] = t[:-1] < t[1:]
    # a run of equal characters has the type of its end
    at = np.where(differs, np.arange(n), n)
    return smaller[np.minimum.accumulate(at[::-1])[::-1]]


def _ranks(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by character, and each one's place among its equals."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    new = np.ones(len(c), bool)
    new[1:] = c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return order, np.arange(len(c)) - np.repeat(first, np.diff(np.append(first, len(c))))


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """All suffixes in order from the leftmost-smaller ones among them, which are ``seeds`` in their order within buckets.

    Larger-type suffixes are appended to the front of their buckets, buckets in ascending order; then smaller-type ones to the
    back, in descending order. What a bucket holds is moved at once; what it adds to itself is moved in further turns.
    """
    n, size = len(t), len(buckets) - 1
    sa = np.full(n, -1, np.int64)
    head, tail = buckets[:-1].copy(), buckets[1:].copy()
    order, rank = _ranks(t[seeds])
    counts = np.bincount(t[seeds], minlength=size)
    sa[(tail - counts)[t[seeds][order]] + rank] = seeds[order]

    def push(found: np.ndarray, larger: bool) -> None:
        before = found[found > 0] - 1
        before = before[small[before] != larger]
        if not len(before):
            return
        chars = t[before]
        order, rank = _ranks(chars)
        c = chars[order]
        if larger:
            sa[head[c] + rank] = before[order]
            np.add.at(head, c, 1) if len(c) < 64 else head.__iadd__(np.bincount(c, minlength=size))
        else:
            sa[tail[c] - 1 - rank] = before[order]
            np.subtract.at(tail, c, 1) if len(c) < 64 else tail.__isub__(np.bincount(c, minlength=size))

    used = np.flatnonzero(np.diff(buckets))
    for c in used:
        done = buckets[c]
        while done < head[c]:
            stop = head[c]
            push(sa[done:stop], True)
            done = stop
        if counts[c]:
            push(sa[buckets[c + 1] - counts[c] : buckets[c + 1]], True)
    # the seeds are found again on the way down, but for the last suffix
    for c in used:
        if counts[c]:
            sa[buckets[c + 1] - counts[c] : buckets[c + 1]] = -1
    sa[0], tail[t[n - 1]] = n - 1, 0
    for c in used[::-1]:
        done = buckets[c + 1]
        while done > tail[c] and c != t[n - 1]:
            stop = tail[c]
            push(sa[stop:done][::-1], False)
            done = stop
        if head[c] > buckets[c]:
            push(sa[buckets[c] : head[c]][::-1], False)
        if c == t[n - 1]:
            push(sa[:1], False)
    return sa


def _induce_few(t: list[int], small: list[bool], seeds: list[int], size: int) -> list[int]:
    """The same one by one, for the many small buckets of a shortened text."""
    counts = [0] * size
    for c in t:
        counts[c] += 1
    heads, at = [], 0
    for k in counts:
        heads.append(at)
        at += k
    tails = [a + k for a, k in zip(heads, counts, strict=True)]
    sa, end = [-1] * len(t), tails[:]
    for i in reversed(seeds):
        end[t[i]] -= 1
        sa[end[t[i]]] = i
    head = heads[:]
    for k in range(len(t)):
        j = sa[k] - 1
        if j >= 0 and not small[j]:
            c = t[j]
            sa[head[c]] = j
            head[c] += 1
    tail = tails[:]
    for k in range(len(t) - 1, -1, -1):
        j = sa[k] - 1
        if j >= 0 and small[j]:
            c = t[j]
            tail[c] -= 1
            sa[tail[c]] = j
    return sa


def suffix_array(t: np.ndarray, size: int, wide: bool = True) -> np.ndarray:
    """The order of all suffixes of integers below ``size``, of which the last is the unique least.

    Suffixes are smaller or larger than the next one; the substrings between leftmost smaller ones are sorted by inducing,
    named by their ranks and sorted as suffixes of the shortened text, recursively; inducing again gives all others.
    """
    n = len(t)
    if n < 3:
        return np.argsort(t, kind="stable")
    small = _types(t)
    left = np.zeros(n, bool)
    left[1:] = small[1:] & ~small[:-1]
    starts = np.flatnonzero(left)
    buckets = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=size))])
    plain = (t.tolist(), small.tolist()) if not wide else None

    def induce(seeds: np.ndarray) -> np.ndarray:
        return _induce(t, small, seeds, buckets) if wide else np.array(_induce_few(*plain, seeds.tolist(), size))

    ordered = induce(starts)
    ordered = ordered[left[ordered]]
    # a substring runs to the next leftmost smaller place, included; equal ones have equal hashes and lengths
    stop = np.append(starts[1:] + 1, n)
    up, down = _power(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((t.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    content = mix((total[stop] - total[starts]) * down[starts] ^ (stop - starts).astype(np.uint64))
    number = np.zeros(n, np.int64)
    number[starts] = np.arange(len(starts))
    by_rank = number[ordered]
    new = np.ones(len(ordered), bool)
    new[1:] = content[by_rank[1:]] != content[by_rank[:-1]]
    names = np.empty(len(starts), np.int64)
    names[by_rank] = np.cumsum(new) - 1
    top = int(new.sum())
    order = by_rank if top == len(starts) else suffix_array(names, top, False)
    return induce(starts[order])


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix and the one before it in the array, in text order.

    Where the characters before both are equal, it is one less than at the place before; only the others are compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    places = np.arange(n)
    fresh = (before <= 0) | (places == 0)
    fresh |= t[places - 1] != t[before - 1]
    at = np.flatnonzero(fresh & (before >= 0))
    length = np.zeros(len(at), np.int64)
    padded = np.concatenate([t, [-1]])
    active = np.arange(len(at))
    while len(active):
        i, j = at[active] + length[active], before[at[active]] + length[active]
        same = (i < n) & (j < n)
        same &= padded[np.minimum(i, n)] == padded[np.minimum(j, n)]
        active = active[same]
        length[active] += 1
    out = np.zeros(n, np.int64)
    out[at] = length
    last = np.maximum.accumulate(np.where(fresh, places, 0))
    return np.maximum(out[last] - (places - last), 0)


def equal_windows(parts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal strings of ``window`` bytes within ``parts``: (group, part, place in the part) for groups of two or more."""
    sizes = np.array([len(p) for p in parts], np.int64)
    t = np.frombuffer(b"\x00".join([*parts, b""]), np.uint8).astype(np.int64) + 2
    starts = np.cumsum(sizes + 1) - sizes - 1
    t[starts + sizes] = 1
    t = np.append(t, 0)
    sa = suffix_array(t, 258)
    shared = common_prefixes(t, sa)[sa]
    group = np.cumsum(shared < window)
    part = np.searchsorted(starts, sa, "right") - 1
    place = sa - starts[part]
    whole = (place + window <= sizes[part]) & (sa < len(t) - 1)
    group, part, place = group[whole], part[whole], place[whole]
    several = np.bincount(group, minlength=1)[group] > 1
    return group[several], part[several], place[several]
