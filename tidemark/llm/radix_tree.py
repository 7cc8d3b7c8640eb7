"""Adaptive radix trees over byte strings: resizable node layouts and path compression."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Node:
    """A compressed path, then children by their first byte.

    ``count`` and ``low`` are the sum and the minimum over all keys below;
    ``end`` is what the key that ends here carries. Children lie in sorted byte
    and node lists of up to 4 or 16 entries, in an index of 256 bytes into 48
    slots, or in 256 slots; a full layout grows into the next one.
    """

    __slots__ = ("path", "count", "low", "end", "layout", "bytes", "slots")

    def __init__(self, path: bytes, count: int, low: int, end=None):
        self.path, self.count, self.low, self.end = path, count, low, end
        self.layout, self.bytes, self.slots = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = bisect_left(self.bytes, byte)
            return self.slots[at] if at < len(self.bytes) and self.bytes[at] == byte else None
        if self.layout == 48:
            at = self.bytes[byte]
            return self.slots[at - 1] if at else None
        return self.slots[byte]

    def put(self, byte: int, node: Node) -> None:
        """Adds or replaces the child of ``byte``."""
        if self.layout <= 16:
            at = bisect_left(self.bytes, byte)
            if at < len(self.bytes) and self.bytes[at] == byte:
                self.slots[at] = node
                return
            if len(self.bytes) < self.layout:
                self.bytes.insert(at, byte)
                self.slots.insert(at, node)
                return
            self._grow()
            self.put(byte, node)
        elif self.layout == 48:
            at = self.bytes[byte]
            if at:
                self.slots[at - 1] = node
            elif len(self.slots) < 48:
                self.slots.append(node)
                self.bytes[byte] = len(self.slots)
            else:
                self._grow()
                self.slots[byte] = node
        else:
            self.slots[byte] = node

    def _grow(self) -> None:
        held = list(self.children())
        self.layout = {4: 16, 16: 48, 48: 256}[self.layout]
        if self.layout == 48:
            self.bytes, self.slots = bytearray(256), [node for _, node in held]
            for at, (byte, _) in enumerate(held):
                self.bytes[byte] = at + 1
        elif self.layout == 256:
            self.bytes, self.slots = bytearray(), [None] * 256
            for byte, node in held:
                self.slots[byte] = node

    def children(self) -> Iterator[tuple[int, Node]]:
        """Children in the order of their bytes."""
        if self.layout <= 16:
            yield from zip(self.bytes, self.slots)
        elif self.layout == 48:
            yield from ((byte, self.slots[at - 1]) for byte, at in enumerate(self.bytes) if at)
        else:
            yield from ((byte, node) for byte, node in enumerate(self.slots) if node is not None)


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most  # the prefix of ``low`` bytes is common, that of ``high`` is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    """Keys with a count, a number whose minimum is kept, and an object."""

    def __init__(self):
        self.root = Node(b"", 0, 1 << 63)

    def insert(self, key: bytes, count: int, low: int, end) -> None:
        """Adds a key that is not in the tree yet."""
        node, at = self.root, 0
        node.count += count
        node.low = min(node.low, low)
        while at < len(key):
            child = node.child(key[at])
            if child is None:
                node.put(key[at], Node(key[at:], count, low, end))
                return
            same = shared(child.path, key[at : at + len(child.path)])
            if same < len(child.path):
                upper = Node(child.path[:same], child.count, child.low)
                child.path = child.path[same:]
                upper.put(child.path[0], child)
                node.put(key[at], upper)
                child = upper
            child.count += count
            child.low = min(child.low, low)
            node, at = child, at + same
        node.end = end
