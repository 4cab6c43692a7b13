"""Anchors of long windows: every window of a fixed number of bytes names one of its short strings, by content alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tributary.llm.arrow import _power, mix

GRAM = 32
#: Texts longer than this are cut into pieces that share one byte less than a window.
PIECE = 1 << 19
_INDEX_BITS = 28


def pieces(ends: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts (first byte, ends of texts relative to it) of consecutive texts; each window lies in exactly one."""
    at, texts = 0, len(ends) - 1
    while at < texts:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE, "right")) - 1)
        if stop > at + 1 or ends[at + 1] - ends[at] <= PIECE:
            yield int(ends[at]), ends[at : stop + 1] - ends[at]
        else:
            for first in range(int(ends[at]), max(int(ends[at + 1]) - window + 1, int(ends[at]) + 1), PIECE):
                size = min(PIECE + window - 1, int(ends[at + 1]) - first)
                yield first, np.array([0, size])
        at = stop


def segments(flat: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: the anchor's hash, a hash of the run's bytes, where it starts and how many windows it has.

    The anchor of a window is its string of ``GRAM`` bytes with the least hash, the leftmost of equals, so equal windows have
    equal anchors at the same place. A run of n windows spans n + window - 1 bytes.
    """
    n = len(flat)
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < window:
        return none
    h = flat.astype(np.uint64) + np.uint64(1)
    scale, size = np.uint64(0x9E3779B97F4A7C15), 1
    base = h
    while size < GRAM:
        h = h[:-size] * scale + h[size:]
        with np.errstate(over="ignore"):
            scale = scale * scale
        size *= 2
    h = mix(h)
    key = (h >> np.uint64(_INDEX_BITS) << np.uint64(_INDEX_BITS)) | np.arange(len(h), dtype=np.uint64)
    grams, size = window - GRAM + 1, 1
    while 2 * size <= grams:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < grams:
        key = np.minimum(key[: len(key) - (grams - size)], key[grams - size :])
    anchor = (key & np.uint64((1 << _INDEX_BITS) - 1)).astype(np.int64)
    # windows that lie in one text
    inside = np.zeros(n + 1, np.int64)
    whole = np.flatnonzero(np.diff(ends) >= window)
    np.add.at(inside, ends[whole], 1)
    np.add.at(inside, ends[whole + 1] - window + 1, -1)
    inside = np.cumsum(inside)[: len(anchor)] > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    starts_text = np.zeros(n + 1, bool)
    starts_text[ends] = True
    first |= inside & starts_text[: len(anchor)]
    starts = np.flatnonzero(first)
    if not len(starts):
        return none
    ordinal = np.flatnonzero(inside)
    place = np.searchsorted(ordinal, starts)
    lengths = np.diff(np.append(place, len(ordinal)))
    up, down = _power(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(base * up[:n], out=total[1:])
    stops = starts + lengths + window - 1
    content = mix(((total[stops] - total[starts]) * down[starts]) ^ (lengths.astype(np.uint64) << np.uint64(32)) ^ (anchor[starts] - starts).astype(np.uint64))
    return h[anchor[starts]], content, starts, lengths
