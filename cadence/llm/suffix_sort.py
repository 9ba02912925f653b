"""Deep-shallow sorting of byte strings, and the match lengths it gives.

``deep_shallow_order`` sorts with a multikey quicksort (three-way partitions on
eight bytes at a time) to a shallow depth; strings that still share their
prefix there go into a blind trie, which stores branching depths and bytes only
and orders a group with one full comparison per string.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 96
STEP = 8


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of equal length."""
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (x.bit_length() + 7) // 8


class BlindTrie:
    """Strings of equal length; inner nodes are [depth, {byte: node}], leaves
    [-1, string numbers]."""

    def __init__(self, keys: list[bytes]):
        self.keys = keys
        self.root: list | None = None

    def insert(self, k: int) -> None:
        key = self.keys[k]
        if self.root is None:
            self.root = [-1, [k]]
            return
        node = self.root
        while node[0] >= 0:  # blind: only the branching bytes are looked at
            node = node[1].get(key[node[0]]) or next(iter(node[1].values()))
        other = self.keys[node[1][0]]
        shared = common_prefix(key, other)
        if shared == len(key):
            node[1].append(k)
            return
        parent, node = None, self.root
        while 0 <= node[0] < shared:
            parent, node = node, node[1][other[node[0]]]
        if node[0] == shared:
            node[1][key[shared]] = [-1, [k]]
            return
        split = [shared, {other[shared]: node, key[shared]: [-1, [k]]}]
        if parent is None:
            self.root = split
        else:
            parent[1][other[parent[0]]] = split

    def in_order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            depth, below = stack.pop()
            if depth < 0:
                out.extend(below)
            else:
                stack.extend(below[c] for c in sorted(below, reverse=True))
        return out


def deep_shallow_order(keys: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """The numbers of ``keys`` (strings of equal length) in sorted order."""
    out: list[int] = []
    stack = [(list(range(len(keys))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out.append(group[0])
        elif depth >= shallow:
            trie = BlindTrie(keys)
            for k in group:
                trie.insert(k)
            out.extend(trie.in_order())
        else:
            end = depth + STEP
            pivot = keys[group[len(group) // 2]][depth:end]
            below, same, above = [], [], []
            for k in group:
                part = keys[k][depth:end]
                (same if part == pivot else below if part < pivot else above).append(k)
            if above:
                stack.append((above, depth))
            stack.append((same, end))
            if below:
                stack.append((below, depth))
    return out


def sorted_with_lcp(keys: list[bytes]) -> tuple[list[int], list[int]]:
    """The order, and for each place the common prefix with the place before."""
    order = deep_shallow_order(keys)
    return order, [0, *(common_prefix(keys[a], keys[b]) for a, b in zip(order, order[1:]))]


def shared_offsets(lefts: list[bytes], rights: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For strings around one anchor each, the offsets i (bytes before the
    anchor) at which a window of ``length`` bytes equals another string's: some
    other string shares i bytes to the left and length - i to the right.

    ``lefts`` are read away from the anchor. Sorting them gives a tree of
    groups that share the most; within a group sharing ``depth`` bytes, the
    best partner to the right is a neighbour in the order of ``rights``. Every
    pair's largest shared group is a node, so the ranges found are exact."""
    found: list[list[tuple[int, int]]] = [[] for _ in lefts]
    if len(lefts) == 2:
        before, after = common_prefix(*lefts), common_prefix(*rights)
        if before + after >= length:
            found = [[(length - after, before)], [(length - after, before)]]
        return found
    left_order, left_lcp = sorted_with_lcp(lefts)
    right_order, right_lcp = sorted_with_lcp(rights)
    rank = np.empty(len(rights), np.int64)
    rank[right_order] = np.arange(len(rights))
    right_lcp = np.array([*right_lcp, 0])
    left_at, lcp = np.array(left_order), np.array(left_lcp)
    stack = [(0, len(left_at))]
    while stack:
        a, b = stack.pop()
        inner = lcp[a + 1:b]
        depth = int(inner.min())
        members = left_at[a:b]
        by_right = members[np.argsort(rank[members])]
        places = rank[by_right]
        # Common prefix to the right of neighbours: smallest value in between.
        best = np.minimum.reduceat(right_lcp, places + 1)[:-1]
        reach = np.maximum(np.append(best, 0), np.insert(best, 0, 0))
        for m, r in zip(by_right[reach + depth >= length].tolist(), reach[reach + depth >= length].tolist()):
            found[m].append((length - r, depth))
        cuts = [a, *(np.flatnonzero(inner == depth) + a + 1).tolist(), b]
        stack.extend((x, y) for x, y in zip(cuts, cuts[1:]) if y - x > 1)
    return found
