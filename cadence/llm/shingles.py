"""Word shingles as 64-bit hashes, for batches of texts at once.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text's set holds the
distinct shingles of five words, or its whole word sequence as one shingle when
it has fewer, or nothing without words. Everything is vectorised over the bytes
of a group of texts: a word's hash is a sum of byte codes times position
factors, a shingle's hash mixes its words' hashes in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
GROUP_BYTES = 1 << 18
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that scatters all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit words."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))


_BYTE = numbered(256, 1)
_PLACE = numbered(64, 2) | np.uint64(1)
_ORDER = numbered(WORDS, 3) | np.uint64(1)
_SHORT = numbered(WORDS + 1, 4)


def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


_IS_SPACE = _space()


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of every word in ``data``."""
    first, _, hashes = word_spans(data)
    return first, hashes


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, hash) of every word in ``data``."""
    inside = ~_IS_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return first, stop, np.empty(0, np.uint64)
    length = stop - first
    letters = np.flatnonzero(inside)
    begin = np.cumsum(length) - length
    place = np.arange(len(letters)) - np.repeat(begin, length)
    longest = int(length.max())
    factor = _PLACE if longest <= len(_PLACE) else numbered(longest, 2) | np.uint64(1)
    sums = np.add.reduceat(_BYTE[data[letters]] * factor[place], begin)
    return first, stop, mix(sums + length.astype(np.uint64))


def rolled_hashes(words: np.ndarray) -> np.ndarray:
    """The hash of the shingle that starts at each word, for all with WORDS words."""
    rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for j in range(WORDS):
        rolled += words[j:len(words) - WORDS + 1 + j] * _ORDER[j]
    return mix(rolled)


def shingle_lists(texts: list[str]) -> Iterator[np.ndarray]:
    """The shingle hashes of each text in reading order, repeats included."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass").translate(LOWER)
        if group and size + len(data) > GROUP_BYTES:
            yield from _group_lists(group)
            group, size = [], 0
        group.append(data)
        size += len(data) + 1
    if group:
        yield from _group_lists(group)


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    return map(np.unique, shingle_lists(texts))


def _group_lists(group: list[bytes]) -> Iterator[np.ndarray]:
    first, words = word_hashes(np.frombuffer(b" ".join(group) + b" ", np.uint8))
    ends = np.cumsum([len(g) + 1 for g in group])
    cut = np.searchsorted(first, ends)
    rolled = rolled_hashes(words)
    at = 0
    for stop in cut.tolist():
        n = stop - at
        if n >= WORDS:
            yield rolled[at:stop - WORDS + 1]
        elif n:
            short = (words[at:stop] * _ORDER[:n]).sum(dtype=np.uint64, keepdims=True) + _SHORT[n:n + 1]
            yield mix(short)
        else:
            yield np.empty(0, np.uint64)
        at = stop


_KEY_A, _KEY_B = np.uint64(0x632BE59BD9B4E019), np.uint64(0xD1B54A32D192ED03)


def key_terms(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each member adds to the two halves of a set's key."""
    return mix(shingles + _KEY_A), mix(shingles ^ _KEY_B)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: two sums of scattered members."""
    a, b = (t.sum(dtype=np.uint64) for t in key_terms(shingles))
    return int(a.astype(np.int64)), int(b.astype(np.int64))
