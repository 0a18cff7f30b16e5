"""An adaptive radix tree over byte strings.

An inner node holds the bytes that all its keys share beyond its parent (path compression) and
its children by their next byte, in the smallest of four layouts that fits: up to 4 or 16
children as a sorted run of bytes beside a list, up to 48 as a table of 256 places into a list,
beyond that as a table of 256 children.  A node grows into the next layout when it is full.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

LAYOUTS = (4, 16, 48, 256)
EMPTY = 255


class Node:
    """``prefix``: the bytes between the parent's branching byte and this node's own; ``value``:
    that of the key which ends here (None: none does)."""

    __slots__ = ("prefix", "value", "size", "keys", "children")

    def __init__(self, prefix: bytes, value: Any = None):
        self.prefix, self.value = prefix, value
        self.size, self.keys, self.children = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.size <= 16:
            at = self.keys.find(byte)
            return self.children[at] if at >= 0 else None
        if self.size == 48:
            at = self.keys[byte]
            return self.children[at] if at != EMPTY else None
        return self.children[byte]

    def grow(self) -> None:
        """The next layout."""
        old, self.size = list(self.items()), LAYOUTS[LAYOUTS.index(self.size) + 1]
        if self.size == 48:
            self.keys, self.children = bytearray([EMPTY]) * 256, []
            for byte, node in old:
                self.keys[byte] = len(self.children)
                self.children.append(node)
        elif self.size == 256:
            self.keys, self.children = bytearray(), [None] * 256
            for byte, node in old:
                self.children[byte] = node

    def put(self, byte: int, node: Node) -> None:
        """A child at a byte that has none yet, or in the place of the one it has."""
        if self.size <= 16:
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.children[at] = node
            elif len(self.children) < self.size:
                self.keys.insert(at, byte)
                self.children.insert(at, node)
            else:
                self.grow()
                self.put(byte, node)
        elif self.size == 48:
            if self.keys[byte] != EMPTY:
                self.children[self.keys[byte]] = node
            elif len(self.children) < 48:
                self.keys[byte] = len(self.children)
                self.children.append(node)
            else:
                self.grow()
                self.put(byte, node)
        else:
            self.children[byte] = node

    def items(self) -> Iterator[tuple[int, Node]]:
        """The children by their byte."""
        if self.size <= 16:
            yield from zip(self.keys, self.children)
        elif self.size == 48:
            yield from ((b, self.children[at]) for b, at in enumerate(self.keys) if at != EMPTY)
        else:
            yield from ((b, node) for b, node in enumerate(self.children) if node is not None)


def common(a: bytes, b: bytes) -> int:
    """The length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] equal, a[:hi] not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class RadixTree:
    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, value: Any) -> None:
        """A key that isn't in the tree yet, with a value other than None."""
        if self.root is None:
            self.root = Node(key, value)
            return
        above, byte, node, at = None, 0, self.root, 0
        while True:
            rest = key[at:at + len(node.prefix)]
            same = common(node.prefix, rest)
            if same < len(node.prefix):  # the path splits inside the compressed prefix
                fork = Node(node.prefix[:same])
                fork.put(node.prefix[same], node)
                node.prefix = node.prefix[same + 1:]
                if above is None:
                    self.root = fork
                else:
                    above.put(byte, fork)
                node = fork
            at += same
            if at == len(key):
                node.value = value
                return
            below = node.child(key[at])
            if below is None:
                node.put(key[at], Node(key[at + 1:], value))
                return
            above, byte, node, at = node, key[at], below, at + 1

    def walk(self) -> Iterator[tuple[int, bytes, Any, bool]]:
        """The nodes in key order, each before those below it: (the depth in bytes where its own
        bytes begin, its bytes with the branching byte, its value, whether it has children)."""
        stack = [(0, b"", self.root)] if self.root is not None else []
        while stack:
            depth, lead, node = stack.pop()
            path = lead + node.prefix
            yield depth, path, node.value, bool(node.children)
            below = [(depth + len(path), bytes([byte]), child) for byte, child in node.items()]
            stack.extend(reversed(below))
