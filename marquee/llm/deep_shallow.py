"""Sorted order of strings with long common prefixes, in two phases.

Multikey quicksort orders the strings by their first ``SHALLOW`` bytes, eight at
a time. Strings that still agree go into a blind trie: its inner nodes know only
a depth and one byte per branch, a string is led to some leaf by these bytes
alone, compared with that leaf once, and hung in where they part. So long common
prefixes are compared once per string instead of once per comparison.
"""

from __future__ import annotations

SHALLOW = 96
STEP = 8


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def sort(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Places of the strings in order, and the common prefix of each with the one before it (0 for the first)."""
    order: list[int] = []
    prefix: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        some, depth = stack.pop()
        if not some:
            continue
        if len(some) == 1 or depth >= shallow:
            found, inner = _blind_trie(strings, some, depth)
            prefix.append(common_prefix(strings[order[-1]], strings[found[0]]) if order else 0)
            prefix.extend(inner)
            order.extend(found)
            continue
        pivot = strings[some[len(some) // 2]][depth : depth + STEP]
        less, same, more, ended = [], [], [], []
        for i in some:
            part = strings[i][depth : depth + STEP]
            if part == pivot:
                (same if len(part) == STEP else ended).append(i)
            else:
                (less if part < pivot else more).append(i)
        # A short last part equal to the pivot's means equal strings.
        stack.extend(((more, depth), (same, depth + STEP), (ended, shallow), (less, depth)))
    return order, prefix


class _Node:
    __slots__ = ("depth", "branches")

    def __init__(self, depth: int):
        self.depth, self.branches = depth, {}


def _blind_trie(strings: list[bytes], some: list[int], known: int) -> tuple[list[int], list[int]]:
    """Order of ``some`` strings and the common prefixes of neighbours. A leaf is
    a list of equal strings; the end of a string is byte -1."""
    if len(some) == 1:
        return some, []
    at = lambda s, d: s[d] if d < len(s) else -1
    root: _Node | list[int] = [some[0]]
    for i in some[1:]:
        string = strings[i]
        node = root
        while type(node) is _Node:
            node = node.branches.get(at(string, node.depth)) or next(iter(node.branches.values()))
        other = strings[node[0]]
        common = common_prefix(string, other)
        if common == len(string) == len(other):
            node.append(i)
            continue
        above, byte, node = None, None, root
        while type(node) is _Node and node.depth < common:
            above, byte = node, at(string, node.depth)
            node = node.branches[byte]
        if type(node) is _Node and node.depth == common:
            node.branches[at(string, common)] = [i]
            continue
        split = _Node(common)
        split.branches[at(other, common)] = node
        split.branches[at(string, common)] = [i]
        if above is None:
            root = split
        else:
            above.branches[byte] = split
    order: list[int] = []
    prefix: list[int] = []
    stack: list[tuple[_Node | list[int], int]] = [(root, 0)]
    while stack:
        node, common = stack.pop()
        if type(node) is _Node:
            below = sorted(node.branches.items(), reverse=True)
            stack.extend((child, node.depth) for _, child in below[:-1])
            stack.append((below[-1][1], common))
        else:
            if order:
                prefix.append(common)
            order.extend(node)
            prefix.extend([len(strings[node[0]])] * (len(node) - 1))
    return order, prefix
