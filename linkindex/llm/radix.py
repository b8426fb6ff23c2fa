"""An adaptive radix tree over byte strings.

Four node layouts, each of which grows into the next: sorted arrays of 4 and of 16 children, an index
of 256 slots into 48 children, and 256 children. A path without branches is one node's prefix. A key
may be the beginning of another: its value lies in the node where it ends.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


def common(a: bytes, b: bytes) -> int:
    """The length of the longest common beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # a[:low] is common, a[:high] is not
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Node4:
    """Up to 4 children, in arrays sorted by byte."""

    __slots__ = ("prefix", "value", "bytes", "children")
    capacity = 4

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value = prefix, value
        self.bytes, self.children = bytearray(), []

    def find(self, byte: int) -> Node4 | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.children[at]

    def replace(self, byte: int, child: Node4) -> None:
        self.children[self.bytes.find(byte)] = child

    def add(self, byte: int, child: Node4) -> Node4:
        """The node that has the new child: this one, or a larger one that takes its place."""
        if len(self.children) == self.capacity:
            return self.grown().add(byte, child)
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.children.insert(at, child)
        return self

    def grown(self) -> Node4:
        node = Node16(self.prefix, self.value)
        node.bytes, node.children = self.bytes, self.children
        return node

    def items(self) -> Iterator[Node4]:
        """The children in the order of their bytes."""
        return iter(self.children)


class Node16(Node4):
    """Up to 16 children, in arrays sorted by byte."""

    __slots__ = ()
    capacity = 16

    def grown(self) -> Node4:
        node = Node48(self.prefix, self.value)
        for byte, child in zip(self.bytes, self.children, strict=True):
            node.add(byte, child)
        return node


class Node48(Node4):
    """Up to 48 children, in the order of arrival; ``bytes`` holds each byte's place, counted from 1."""

    __slots__ = ()
    capacity = 48

    def __init__(self, prefix: bytes, value=None):
        super().__init__(prefix, value)
        self.bytes = bytearray(256)

    def find(self, byte: int) -> Node4 | None:
        at = self.bytes[byte]
        return self.children[at - 1] if at else None

    def replace(self, byte: int, child: Node4) -> None:
        self.children[self.bytes[byte] - 1] = child

    def add(self, byte: int, child: Node4) -> Node4:
        if len(self.children) == self.capacity:
            return self.grown().add(byte, child)
        self.children.append(child)
        self.bytes[byte] = len(self.children)
        return self

    def grown(self) -> Node4:
        node = Node256(self.prefix, self.value)
        for byte, at in enumerate(self.bytes):
            if at:
                node.children[byte] = self.children[at - 1]
        return node

    def items(self) -> Iterator[Node4]:
        return (self.children[at - 1] for at in self.bytes if at)


class Node256(Node4):
    """A place for each byte."""

    __slots__ = ()
    capacity = 256

    def __init__(self, prefix: bytes, value=None):
        super().__init__(prefix, value)
        self.children = [None] * 256

    def find(self, byte: int) -> Node4 | None:
        return self.children[byte]

    def replace(self, byte: int, child: Node4) -> None:
        self.children[byte] = child

    def add(self, byte: int, child: Node4) -> Node4:
        self.children[byte] = child
        return self

    def items(self) -> Iterator[Node4]:
        return (c for c in self.children if c is not None)


class Tree:
    """Keys with values that are not None."""

    def __init__(self) -> None:
        self.root: Node4 | None = None

    def __setitem__(self, key: bytes, value) -> None:
        if self.root is None:
            self.root = Node4(key, value)
            return
        above, edge, node, at = None, 0, self.root, 0

        def put(new: Node4) -> None:
            if above is None:
                self.root = new
            else:
                above.replace(edge, new)

        while True:
            rest = key[at:at + len(node.prefix)]
            same = common(node.prefix, rest)
            if same < len(node.prefix):  # the key leaves within the compressed path, or ends there
                fork = Node4(node.prefix[:same])
                put(fork)
                fork.add(node.prefix[same], node)
                node.prefix = node.prefix[same + 1:]
                if at + same == len(key):
                    fork.value = value
                else:
                    fork.add(key[at + same], Node4(key[at + same + 1:], value))
                return
            at += same
            if at == len(key):
                node.value = value
                return
            byte = key[at]
            child = node.find(byte)
            if child is None:
                larger = node.add(byte, Node4(key[at + 1:], value))
                if larger is not node:
                    put(larger)
                return
            above, edge, node, at = node, byte, child, at + 1

    def get(self, key: bytes, default=None):
        node, at = self.root, 0
        while node is not None:
            if key[at:at + len(node.prefix)] != node.prefix:
                return default
            at += len(node.prefix)
            if at == len(key):
                return default if node.value is None else node.value
            node, at = node.find(key[at]), at + 1
        return default
