"""Suffix arrays with common prefixes by external induced sorting.

Sorting starts from the leftmost-S suffixes, whose order comes from the same algorithm on the string of their names.
From them the L suffixes are induced bucket by bucket upwards, and from those the S suffixes downwards. Suffixes that
wait for their bucket are tuples (position, common prefix with the one before) in a priority queue by first symbol;
the queue keeps what fits and holds the rest on disk. All work on a bucket is numpy on whole runs of it.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Tuples that a queue keeps in memory; most symbols of a string that is sorted by induction, beyond them by doubling.
IN_MEMORY, SYMBOLS = 1 << 24, 1 << 12


class BucketQueue:
    """A priority queue of (position, prefix) tuples by bucket; first come, first served within a bucket."""

    def __init__(self, limit: int) -> None:
        self.limit, self.held, self.parts, self.files, self.folder = limit, 0, {}, {}, None

    def push(self, bucket: int, position: np.ndarray, prefix: np.ndarray) -> None:
        self.parts.setdefault(bucket, []).append(np.stack((position, prefix)))
        self.held += len(position)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.folder = self.folder or tempfile.TemporaryDirectory(prefix="queue-")
        for bucket, parts in self.parts.items():
            with open(os.path.join(self.folder.name, str(bucket)), "ab") as out:
                for p in parts:
                    out.write(np.ascontiguousarray(p.T).tobytes())
            self.files[bucket] = True
        self.parts, self.held = {}, 0

    def pop(self, bucket: int) -> np.ndarray | None:
        """All tuples of a bucket, oldest first, as a 2-row array; None if there are none."""
        out = []
        if self.files.pop(bucket, None):
            name = os.path.join(self.folder.name, str(bucket))
            out.append(np.fromfile(name, dtype=np.int64).reshape(-1, 2).T)
            os.unlink(name)
        if parts := self.parts.pop(bucket, None):
            self.held -= sum(p.shape[1] for p in parts)
            out += parts
        return np.concatenate(out, axis=1) if out else None

    def close(self) -> None:
        if self.folder:
            self.folder.cleanup()


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S (smaller than the next); the last, a unique smallest symbol, is."""
    n = len(t)
    step = np.sign(np.diff(t))
    at = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]  # the next place where the symbol changes
    out = np.ones(n, dtype=bool)
    out[:-1] = step[np.minimum(following, n - 2)] > 0
    out[:-1][following == n] = True
    return out


def _runs(t: np.ndarray) -> np.ndarray:
    """How often the symbol at each place is repeated from there on."""
    n = len(t)
    change = np.concatenate((np.flatnonzero(np.diff(t)) + 1, [n]))
    return change[np.searchsorted(change, np.arange(n), side="right")] - np.arange(n)


def _sweep(t: np.ndarray, mine: np.ndarray, seeds: dict[int, np.ndarray], runs: np.ndarray, limit: int, down: bool) -> dict[int, np.ndarray]:
    """One induction: by bucket the suffixes that `mine` marks, each with its prefix, in the order of the sweep.

    seeds: (position, prefix) of the suffixes of the other type, in that order; a bucket's seeds come after its own
    suffixes, upwards since L sorts before S, and downwards likewise. A prefix is shared with the one before.
    """
    size, queue, out = int(t.max()) + 1, BucketQueue(limit), {}
    lowest = np.full(size, -1, dtype=np.int64)  # of each bucket, the least prefix since its last push; -1 before the first

    def induce(position: np.ndarray, prefix: np.ndarray) -> None:
        before = position - 1
        at = np.flatnonzero((before >= 0) & mine[before])
        symbol = t[before[at]]
        order = np.argsort(symbol.astype(np.uint16), kind="stable")  # SYMBOLS fit, and 16 bits sort by radix
        at, symbol = at[order], symbol[order]
        cuts = np.flatnonzero(np.concatenate(([len(at) > 0], symbol[1:] != symbol[:-1])))
        pushed = {}
        for lo, hi in zip(cuts, [*cuts[1:], len(at)], strict=False):
            d, own = int(symbol[lo]), at[lo:hi]
            least = np.minimum.reduceat(prefix[: own[-1] + 1], np.concatenate(([0], own[:-1] + 1)))
            least[0] = min(int(least[0]), int(lowest[d]))
            queue.push(d, before[own], least + 1)
            rest = prefix[own[-1] + 1 :]
            pushed[d] = rest.min() if len(rest) else _FAR
        np.minimum(lowest, prefix.min(), out=lowest)
        for d, low in pushed.items():
            lowest[d] = low

    for c in range(size - 1, -1, -1) if down else range(size):
        got = []
        while (batch := queue.pop(c)) is not None:
            got.append(batch)
            induce(batch[0], batch[1])
        if got:
            out[c] = np.concatenate(got, axis=1)
        if c in seeds:
            position, prefix = seeds[c][0], seeds[c][1].copy()
            # both types begin with a run of c, and of runs of equal length one goes on below c, the other above
            prefix[0] = min(int(runs[out[c][0, -1]]), int(runs[position[0]])) if got else 0
            induce(position, prefix)
    queue.close()
    return out


def _by_bucket(t: np.ndarray, position: np.ndarray, prefix: np.ndarray) -> dict[int, np.ndarray]:
    """Sorted suffixes split by their first symbols."""
    first = t[position]
    cuts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
    return {int(first[a]): np.stack((position[a:b], prefix[a:b])) for a, b in zip(cuts, [*cuts[1:], len(first)], strict=True)}


def _turned(parts: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The same suffixes in the other direction: each prefix goes to the other one of its two."""
    return {c: np.stack((p[0, ::-1], np.concatenate(([0], p[1, :0:-1])))) for c, p in parts.items()}


def _induce(t: np.ndarray, small: np.ndarray, runs: np.ndarray, stars: np.ndarray, prefix: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order and their prefixes, from the leftmost-S ones."""
    large = _sweep(t, ~small, _by_bucket(t, stars, prefix), runs, limit, down=False)
    smalls = _turned(_sweep(t, small, _turned(large), runs, limit, down=True))
    order, common = [np.array([len(t) - 1])], [np.zeros(1, dtype=np.int64)]
    for c in sorted({*large, *smalls}):
        own, other = large.get(c), smalls.get(c)
        if own is not None:
            own[1, 0] = 0
            order.append(own[0])
            common.append(own[1])
        if other is not None:
            other[1, 0] = min(int(runs[own[0, -1]]), int(runs[other[0, 0]])) if own is not None else 0
            order.append(other[0])
            common.append(other[1])
    return np.concatenate(order), np.concatenate(common)


def _doubled(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and prefixes by prefix doubling: ranks of 1, 2, 4 ... symbols, kept to read the prefixes from them."""
    n, wide, ranks = len(t), 1, [np.unique(t, return_inverse=True)[1].astype(np.int64)]
    while ranks[-1].max() < n - 1:
        rank = ranks[-1]
        second = np.concatenate((rank[wide:] + 1, np.zeros(min(wide, n), dtype=np.int64)))[:n]
        ranks.append(np.unique(rank * (n + 1) + second, return_inverse=True)[1].astype(np.int64))
        wide *= 2
    order = np.argsort(ranks[-1], kind="stable")
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(n, dtype=np.int64)
    for k in range(len(ranks) - 2, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, dtype=bool)
        same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
        common[1:][same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, common


def suffix_array(t: np.ndarray, limit: int = IN_MEMORY, symbols: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of t in order, and of each the number of symbols that it shares with the one before.

    t: non-negative symbols, the last a unique 0. limit: tuples that a queue keeps in memory. Strings of more than
    `symbols` different symbols, which come up in the recursion, are sorted by doubling.
    """
    t = t.astype(np.int64)
    n = len(t)
    if n < 3 or int(t.max()) >= min(symbols, 1 << 16):
        return _doubled(t)
    small, runs = _types(t), _runs(t)
    star = np.flatnonzero(small & np.concatenate(([False], ~small[:-1])))
    zeros = np.zeros(len(star), dtype=np.int64)
    rough = star[np.argsort(t[star].astype(np.uint16), kind="stable")]
    order = _induce(t, small, runs, rough, zeros, limit)[0]  # sorts the pieces from one star to the next
    is_star = np.zeros(n, dtype=bool)
    is_star[star] = True
    pieces = order[is_star[order]]
    place = np.zeros(n, dtype=np.int64)
    place[star] = np.arange(len(star))
    ends = np.concatenate((star[1:], [n - 1]))[place[pieces]]
    fresh = np.concatenate(([True], ~_equal(t, pieces[:-1], ends[:-1] + 1, pieces[1:], ends[1:] + 1)))
    names = np.zeros(len(star), dtype=np.int64)
    names[place[pieces]] = np.cumsum(fresh) - 1
    if fresh.all():
        ranked, shared = place[pieces], np.zeros(len(star), dtype=np.int64)
    else:
        ranked, shared = suffix_array(names, limit, symbols)
    stars = star[ranked]
    common = np.zeros(len(stars), dtype=np.int64)  # the pieces in common, and then what the next two share
    common[1:] = star[ranked[1:] + shared[1:]] - stars[1:]
    common[1:] += _extend(t, stars[:-1] + common[1:], stars[1:] + common[1:])
    return _induce(t, small, runs, stars, common, limit)


def _equal(t: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether t[a:a_end] and t[b:b_end] are the same, for each pair."""
    out = a_end - a == b_end - b
    left, k = np.flatnonzero(out), 0
    while len(left):
        left = left[a[left] + k < a_end[left]]
        differ = t[a[left] + k] != t[b[left] + k]
        out[left[differ]] = False
        left, k = left[~differ], k + 1
    return out


def _extend(t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols t has in common from each a and b on; suffixes differ, so that ends before t does."""
    out, left, k = np.zeros(len(a), dtype=np.int64), np.arange(len(a)), 0
    while len(left):
        inside = np.maximum(a[left], b[left]) + k < len(t)
        left = left[inside]
        left = left[t[a[left] + k] == t[b[left] + k]]
        k += 1
        out[left] = k
    return out


_FAR = np.iinfo(np.int64).max // 2
