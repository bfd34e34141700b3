"""A compressed radix trie over byte strings that keeps the smallest owner of each string."""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator
from typing import NamedTuple


# Bytes of a node and its place among its parent's children, and of an owner, beside their strings.
NODE_BYTES = 210
OWNER_BYTES = 190


class Owner(NamedTuple):
    """``row`` is whatever else the owner brings, as bytes."""

    identifier: int | None
    copies: int
    digest: bytes
    row: bytes | None

    def merge(self, other: Owner) -> Owner:
        """The smaller identifier owns the string; none at all is larger than any."""
        first = self
        if other.identifier is not None and (
            self.identifier is None or other.identifier < self.identifier
        ):
            first = other
        return first._replace(copies=self.copies + other.copies)

    def size(self) -> int:
        return OWNER_BYTES + len(self.row or b"")


class _Node:
    __slots__ = ("label", "children", "owner", "spilled")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, _Node] = {}
        self.owner: Owner | None = None
        self.spilled = None

    def size(self) -> int:
        return NODE_BYTES + len(self.label) + (self.owner.size() if self.owner else 0)

    def weight(self) -> int:
        """Bytes of the subtree: labels, owners and nodes."""
        total, stack = 0, [self]
        while stack:
            node = stack.pop()
            total += node.size()
            stack.extend(node.children.values())
        return total


def _shared(left: bytes, right: bytes, at: int) -> int:
    """How many bytes of ``left`` equal those of ``right`` from ``at``, by halving."""
    low, high = 0, min(len(left), len(right) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if left[low:middle] == right[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """``insert`` strings with owners, then iterate over ``owners``, one for each string.

    ``held`` estimates the memory of the whole trie, rows of owners included. Beyond ``budget`` bytes,
    the heaviest subtree that leaves less than half goes to a temporary file of the task, its node
    stays as a stub, and later strings under it are appended to the file. Each file is read back, on
    its own, at the end.
    """

    def __init__(self, budget: int):
        self.budget = budget
        self.held = 0
        self.spills = 0
        self.root = _Node(b"")

    def insert(self, key: bytes, owner: Owner) -> None:
        node, at = self.root, 0
        while True:
            if node.spilled is not None:
                pickle.dump((key[at:], owner), node.spilled)
                return
            if at == len(key):
                self.held -= node.owner.size() if node.owner else 0
                node.owner = owner if node.owner is None else node.owner.merge(owner)
                self.held += node.owner.size()
                break
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                child.owner = owner
                self.held += child.size()
                break
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            cut = _shared(child.label, key, at)
            upper = _Node(child.label[:cut])
            child.label = child.label[cut:]
            upper.children[child.label[0]] = child
            node.children[key[at]] = upper
            self.held += NODE_BYTES
            node, at = upper, at + cut
        if self.held > self.budget:
            self._spill()

    def _spill(self) -> None:
        """Write the heaviest subtree that holds at most half of all, or one leaf."""
        node = self.root
        while node.children:
            heaviest = max(node.children.values(), key=_Node.weight)
            node = heaviest
            if node.weight() * 2 <= self.held:
                break
        if node is self.root or node.spilled is not None:
            return
        file = tempfile.TemporaryFile()  # noqa: SIM115  unlinked already, gone with the task
        self.held -= node.weight()
        for tail, owner in self._walk(node, b""):
            pickle.dump((tail, owner), file)
        node.children, node.owner, node.spilled = {}, None, file
        self.held += node.size()
        self.spills += 1

    def _walk(self, node: _Node, path: bytes) -> Iterator[tuple[bytes, Owner]]:
        stack = [(node, path)]
        while stack:
            node, path = stack.pop()
            if node.owner is not None:
                yield path, node.owner
            if node.spilled is not None:
                yield from self._read_back(node.spilled, path)
            for child in node.children.values():
                stack.append((child, path + child.label))

    def _read_back(self, file, path: bytes) -> Iterator[tuple[bytes, Owner]]:
        inner = RadixTrie(self.budget)
        file.seek(0)
        while True:
            try:
                tail, owner = pickle.load(file)
            except EOFError:
                break
            inner.insert(tail, owner)
        file.close()
        for tail, owner in inner.owners():
            yield path + tail, owner

    def owners(self) -> Iterator[tuple[bytes, Owner]]:
        yield from self._walk(self.root, b"")
