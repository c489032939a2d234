"""Adaptive radix tree over byte keys: inner nodes of 4, 16, 48 or 256 slots, with path compression.

An inner node stores the bytes that all keys below it share after the byte that led to it,
and one child for each next byte. Its layout grows with the number of children:

* 4 and 16 slots: the bytes in a bytearray, the children in a list at the same places;
* 48 slots: a table from all 256 bytes to the place of the child;
* 256 slots: a child for every byte.

A key may be the prefix of another one; it then ends at an inner node.
"""

from __future__ import annotations

from collections.abc import Iterator

# Children that each layout holds.
SMALL, MEDIUM, INDEXED, DIRECT = 4, 16, 48, 256
_NONE = 255


class Node:
    """path: the compressed bytes. value: that of the key which ends after them, or None."""

    __slots__ = ("children", "keys", "path", "room", "value")

    def __init__(self, path: bytes, value=None):
        self.path, self.value = path, value
        self.room = SMALL
        self.keys = bytearray()
        self.children: list = []

    def child(self, byte: int) -> Node | None:
        if self.room <= MEDIUM:
            at = self.keys.find(byte)
            return self.children[at] if at >= 0 else None
        if self.room == INDEXED:
            at = self.keys[byte]
            return self.children[at] if at != _NONE else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Set the child of a byte, old or new."""
        if self.room <= MEDIUM:
            at = self.keys.find(byte)
            if at >= 0:
                self.children[at] = child
                return
            if len(self.children) < self.room:
                self.keys.append(byte)
                self.children.append(child)
                return
        elif self.room == INDEXED:
            at = self.keys[byte]
            if at != _NONE:
                self.children[at] = child
                return
            if len(self.children) < self.room:
                self.keys[byte] = len(self.children)
                self.children.append(child)
                return
        else:
            self.children[byte] = child
            return
        self._grow()
        self.put(byte, child)

    def _grow(self) -> None:
        if self.room == SMALL:
            self.room = MEDIUM
        elif self.room == MEDIUM:
            table = bytearray([_NONE]) * 256
            for place, byte in enumerate(self.keys):
                table[byte] = place
            self.room, self.keys = INDEXED, table
        else:
            every: list = [None] * 256
            for byte, place in enumerate(self.keys):
                if place != _NONE:
                    every[byte] = self.children[place]
            self.room, self.keys, self.children = DIRECT, bytearray(), every

    def items(self) -> Iterator[tuple[int, Node]]:
        """(byte, child) in order of bytes."""
        if self.room <= MEDIUM:
            yield from sorted(zip(self.keys, self.children), key=lambda x: x[0])
        elif self.room == INDEXED:
            yield from ((b, self.children[p]) for b, p in enumerate(self.keys) if p != _NONE)
        else:
            yield from ((b, c) for b, c in enumerate(self.children) if c is not None)


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and of b from ``at`` on."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at: at + n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[at + low: at + middle]:
            low = middle
        else:
            high = middle
    return low


class Tree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        """Add a key, or replace its value."""
        node, at, above, byte = self.root, 0, None, 0
        while True:
            n = _shared(node.path, key, at)
            if n < len(node.path):
                # The key leaves the compressed path: split it there.
                upper = Node(node.path[:n])
                rest = node.path[n]
                node.path = node.path[n + 1:]
                upper.put(rest, node)
                if at + n == len(key):
                    upper.value = value
                else:
                    upper.put(key[at + n], Node(key[at + n + 1:], value))
                if above is None:
                    self.root = upper
                else:
                    above.put(byte, upper)
                return
            at += n
            if at == len(key):
                node.value = value
                return
            following = node.child(key[at])
            if following is None:
                node.put(key[at], Node(key[at + 1:], value))
                return
            above, byte, node, at = node, key[at], following, at + 1

    def walk(self) -> Iterator[tuple[int, bytes, object]]:
        """Every node in order of keys, parents first: (depth of its first byte, its bytes with the
        one that leads to it, value)."""
        stack = [(0, b"", self.root)]
        while stack:
            depth, lead, node = stack.pop()
            edge = lead + node.path
            yield depth, edge, node.value
            below = depth + len(edge)
            stack.extend((below, bytes((b,)), c) for b, c in reversed(list(node.items())))
