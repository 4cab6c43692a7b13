"""Few bins for very many items: bin completion over counts by length.

Items of one length are alike, so a problem of any size is a table of counts, with no more rows than a bin has places, and a
solution a list of fillings, each with the number of bins that are filled so.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np

#: Lengths with their numbers in one bin, longest first, and how many bins are filled so.
Filling = tuple[int, tuple[tuple[int, int], ...]]

#: Nodes of the search tree at most, fillings that are tried at a node, and nodes between two best-fit completions.
NODES, WIDTH, EVERY = 3000, 6, 32
#: Fillings of more items are not compared with others.
COMPARED = 10


def lower_bound(left: list[int], size: int) -> int:
    """Bins that are needed at least: by the sum, and by the items that no two of fit together, for every least length looked at."""
    counts = np.array(left, float)
    lengths = np.arange(size + 1)
    n, s = np.cumsum(counts), np.cumsum(counts * lengths)
    best = -(-int(sum(k * x for k, x in enumerate(left))) // size)
    half = size // 2
    for least in range(1, half + 1):
        large, middle = n[size] - n[size - least], n[size - least] - n[half]
        small = s[half] - s[least - 1]
        room = middle * size - (s[size - least] - s[half])
        best = max(best, int(large + middle + max(0, np.ceil((small - room) / size - 1e-9))))
    return best


def best_fit(left: list[int], size: int) -> list[Filling]:
    """Longest items first, each into the fullest bin that has room."""
    groups: dict[int, list[Filling]] = {}
    open_rooms = 0  # bit r: some bin has room r left

    def put(room: int, times: int, items: tuple) -> None:
        nonlocal open_rooms
        if times:
            groups.setdefault(room, []).append((times, items))
            open_rooms |= 1 << room

    for length in range(size, 0, -1):
        n = left[length]
        while n:
            fitting = open_rooms >> length
            if not fitting:
                k = size // length
                put(size - k * length, n // k, ((length, k),))
                put(size - n % k * length, int(n % k > 0), ((length, n % k),))
                break
            room = length + (fitting & -fitting).bit_length() - 1
            times, items = groups[room].pop()
            if not groups[room]:
                open_rooms &= ~(1 << room)
            k = room // length
            whole = min(times, n // k)
            put(room - k * length, whole, (*items, (length, k)))
            n -= whole * k
            if whole < times and n:
                put(room - n * length, 1, (*items, (length, n)))
                put(room, times - whole - 1, items)
                n = 0
            else:
                put(room, times - whole, items)
    return [f for found in groups.values() for f in found]


def bins_of(fillings: list[Filling]) -> int:
    return sum(times for times, _ in fillings)


def _reach(lengths: list[int], most: list[int], room: int) -> list[int]:
    """For the first 0, 1, … of some lengths the sums up to ``room`` that they make, a bit for each."""
    out, mask = [1], (1 << room + 1) - 1
    for length, n in zip(lengths, most, strict=True):
        sums, step = out[-1], 1
        while n:
            step = min(step, n)
            sums |= sums << step * length
            n -= step
            step *= 2
        out.append(sums & mask)
    return out


def _exact(lengths: list[int], most: list[int], reach: list[int], last: int, rest: int) -> Iterator[tuple[tuple[int, int], ...]]:
    """Fillings of the first ``last`` lengths that add up to ``rest``, those with the longest items first."""
    if not rest:
        yield ()
        return
    for i in range(last - 1, -1, -1):
        if not reach[i + 1] >> rest & 1:
            return  # nor can shorter ones make it
        for k in range(min(most[i], rest // lengths[i]), 0, -1):
            if reach[i] >> rest - k * lengths[i] & 1:
                for more in _exact(lengths, most, reach, i, rest - k * lengths[i]):
                    yield ((lengths[i], k), *more)


def dominates(a: tuple[tuple[int, int], ...], b: tuple[tuple[int, int], ...]) -> bool:
    """Whether the items of ``b`` fit into those of ``a``, so that ``a`` in its place leaves a problem that is no harder."""
    places = [x for x, k in a for _ in range(k)] if sum(k for _, k in a) <= COMPARED else []
    items = [x for x, k in b for _ in range(k)] if sum(k for _, k in b) <= COMPARED else [1 << 60]

    def fits(i: int) -> bool:
        if i == len(items):
            return True
        for j in {p: j for j, p in enumerate(places)}.values():
            if places[j] >= items[i]:
                places[j] -= items[i]
                if fits(i + 1):
                    return True
                places[j] += items[i]
        return False

    return fits(0)


def fillings_around(left: list[int], size: int, slack: int) -> Iterator[Filling]:
    """Undominated fillings of a bin with the longest item left, the fullest first, and how many bins to fill so.

    A filling is taken for as many bins as its items last and as ``slack``, the waste that is still allowed, permits.
    """
    longest = next(x for x in range(size, 0, -1) if left[x])
    room = size - longest
    lengths = [x for x in range(1, min(room, longest) + 1) if left[x] > (x == longest)]
    most = [min(left[x] - (x == longest), room // x) for x in lengths]
    reach = _reach(lengths, most, room)
    sums, kept = reach[-1], []
    while sums:
        full = sums.bit_length() - 1
        sums ^= 1 << full
        waste = room - full
        if waste > slack:
            return
        for items in islice(_exact(lengths, most, reach, len(lengths), full), WIDTH):
            if any(dominates(before, items) for before in kept):
                continue
            kept.append(items)
            own = items[0][1] if items and items[0][0] == longest else 0
            whole = ((longest, own + 1), *items[own > 0 :])
            times = min(left[x] // k for x, k in whole)
            yield min(times, slack // waste) if waste else times, whole
            if len(kept) == WIDTH:
                return


def complete(left: list[int], size: int, nodes: int | None = None) -> list[Filling]:
    """Fillings of as few bins of ``size`` as the search finds for ``left[n]`` items of each length n from 1 to ``size``.

    The best-fit solution is the first incumbent. A node fills bins around the longest item left; what its fillings waste may not
    exceed what the incumbent wastes in all, and once the search has an end of its own, what one bin fewer would. Now and then the rest
    is completed by best fit, which may make a new incumbent. The search ends when it reaches the lower bound, with a proof, or after
    ``nodes`` nodes, with the best so far; it depends on the counts alone.
    """
    left, nodes = list(left), NODES if nodes is None else nodes
    total, least = sum(k * n for k, n in enumerate(left)), lower_bound(left, size)
    best = best_fit(left, size)
    fewest, own, wasted, used, path = bins_of(best), False, 0, 0, []

    def slack() -> int:
        return (fewest - own) * size - total - wasted

    stack = [fillings_around(left, size, slack())] if total else []
    while stack and (fewest > least or not own) and nodes > 0:
        choice = next(stack[-1], None)
        if choice is None:
            stack.pop()
            if path:
                times, items = path.pop()
                used -= times
                wasted -= times * (size - sum(x * k for x, k in items))
                for x, k in items:
                    left[x] += times * k
            continue
        times, items = choice
        waste = times * (size - sum(x * k for x, k in items))
        if not times or waste > slack():
            continue
        nodes -= 1
        path.append(choice)
        used, wasted = used + times, wasted + waste
        for x, k in items:
            left[x] -= times * k
        if not any(left):
            best, fewest, own = list(path), used, True
        elif fewest > least and len(path) % EVERY == 1:
            rest = best_fit(left, size)
            if used + bins_of(rest) < fewest:
                best, fewest, own = [*path, *rest], used + bins_of(rest), False
        stack.append(fillings_around(left, size, slack()) if any(left) else iter(()))
    return best
