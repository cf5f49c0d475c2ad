"""Word-shingle sets as 64-bit hashes, in numpy, a block of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_NEXT = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: By number of bytes, the mask of so many low bytes of a 64-bit word.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Bytes of a word that are hashed in numpy, eight at a time; longer words are hashed one by one.
SHORT_WORD = 64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Bytes that one numpy pass takes; a longer text is a block of its own.
BLOCK = 1 << 19


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit hangs on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of a byte array: runs without ASCII white space, A-Z lower-cased."""
    gap = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    lower = np.concatenate((_LOWER[data], np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=lower, strides=(1,))  # the eight bytes from each place on
    length = end - start
    h = length.astype(np.uint64) * _NEXT
    for k in range(0, min(int(length.max(initial=0)), SHORT_WORD), 8):
        left = np.flatnonzero(length > k)
        h[left] = mixed(h[left] ^ (eight[start[left] + k] & _MASK[np.minimum(length[left] - k, 8)]))
    for i in np.flatnonzero(length > SHORT_WORD):
        h[i] = xxhash.xxh3_64_intdigest(lower[start[i] : end[i]].tobytes())
    return start, h


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK bytes together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def shingle_sets(texts: list[bytes], words: int = 2) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of `words` words.

    A text of fewer words, but not none, has its whole sequence as the only one; without words the set is empty.
    """
    for a, b in blocks(texts):
        part = texts[a:b]
        data = np.frombuffer(b"\n".join(part), dtype=np.uint8)
        start, h = word_hashes(data)
        bounds = np.cumsum([0, *(len(t) + 1 for t in part)])
        cuts = np.searchsorted(start, bounds)
        joined = h.copy()
        for k in range(1, words):
            joined[: len(h) - k] = joined[: len(h) - k] * _NEXT + h[k:] if len(h) > k else joined[: len(h) - k]
        joined = mixed(joined + np.uint64(words))
        for i in range(len(part)):
            lo, hi = cuts[i], cuts[i + 1]
            if hi - lo >= words:
                yield np.unique(joined[lo : hi - words + 1])
            elif hi > lo:
                one = h[lo]
                for k in range(lo + 1, hi):
                    one = one * _NEXT + h[k]
                yield mixed(np.array([one + np.uint64(hi - lo)]))
            else:
                yield np.zeros(0, dtype=np.uint64)
