"""Adaptive radix tree over byte strings: nodes of 4, 16, 48 and 256 children, with path compression.

A node's `path` holds all bytes between its parent and itself, the edge byte first. A key
may be a start of another key, so any node can hold values. `sample` is the number of one
key that runs through the node.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Small:
    """Up to `room` children: their edge bytes, sorted, beside them."""

    __slots__ = ("room", "edges", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.edges, self.nodes = room, bytearray(), []

    def get(self, edge: int):
        at = bisect_left(self.edges, edge)
        return self.nodes[at] if at < len(self.edges) and self.edges[at] == edge else None

    def put(self, edge: int, node) -> Small | Indexed:
        at = bisect_left(self.edges, edge)
        if at < len(self.edges) and self.edges[at] == edge:
            self.nodes[at] = node
            return self
        if len(self.edges) == self.room:
            larger = Small(16) if self.room == 4 else Indexed()
            for known, child in self:
                larger = larger.put(known, child)
            return larger.put(edge, node)
        self.edges.insert(at, edge)
        self.nodes.insert(at, node)
        return self

    def __iter__(self) -> Iterator:
        return zip(self.edges, self.nodes, strict=True)


class Indexed:
    """Up to 48 children behind an index of 256 places."""

    __slots__ = ("index", "nodes")
    NONE = 255

    def __init__(self):
        self.index, self.nodes = bytearray([self.NONE]) * 256, []

    def get(self, edge: int):
        at = self.index[edge]
        return None if at == self.NONE else self.nodes[at]

    def put(self, edge: int, node) -> Indexed | Direct:
        at = self.index[edge]
        if at != self.NONE:
            self.nodes[at] = node
            return self
        if len(self.nodes) == 48:
            larger = Direct()
            for known, child in self:
                larger.put(known, child)
            return larger.put(edge, node)
        self.index[edge] = len(self.nodes)
        self.nodes.append(node)
        return self

    def __iter__(self) -> Iterator:
        return ((edge, self.nodes[at]) for edge, at in enumerate(self.index) if at != self.NONE)


class Direct:
    """A place for each of the 256 edge bytes."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, edge: int):
        return self.nodes[edge]

    def put(self, edge: int, node) -> Direct:
        self.nodes[edge] = node
        return self

    def __iter__(self) -> Iterator:
        return ((edge, node) for edge, node in enumerate(self.nodes) if node is not None)


class Node:
    __slots__ = ("path", "children", "values", "sample")

    def __init__(self, path: bytes, sample: int):
        self.path, self.sample = path, sample
        self.children: Small | Indexed | Direct = Small()
        self.values: list[int] = []


def common_start(one: bytes, two: bytes) -> int:
    """How many leading bytes are equal."""
    n = min(len(one), len(two))
    if one[:n] == two[:n]:
        return n
    low, high = 0, n  # equal up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if one[:middle] == two[:middle] else (low, middle)
    return low


class RadixTree:
    def __init__(self):
        self.root: Node | None = None

    def add(self, key: bytes, value: int) -> None:
        """Store a value, also the number of its key, at the node of the key."""
        if self.root is None:
            self.root = Node(b"", value)
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                leaf = Node(key[at:], value)
                node.children = node.children.put(key[at], leaf)
                node = leaf
                break
            equal = common_start(child.path, key[at : at + len(child.path)])
            if equal < len(child.path):
                split = Node(child.path[:equal], child.sample)
                child.path = child.path[equal:]
                split.children = split.children.put(child.path[0], child)
                node.children = node.children.put(split.path[0], split)
                child = split
            node, at = child, at + equal
        node.values.append(value)
