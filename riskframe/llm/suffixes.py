"""Suffix sorting by the deep-shallow method: multikey quicksort to a shallow depth, then blind tries."""

from __future__ import annotations

from array import array

import numpy as np

#: Bytes that the quicksort looks at (whole 8-byte symbols); groups equal so far go to blind tries.
SHALLOW = 16
#: Groups of at most so many suffixes are sorted by their shallow bytes at once.
SMALL = 64


class BlindTrie:
    """Orders strings with a common start: inner nodes know a byte place only, leaves the strings.

    A string descends by the bytes at the nodes' places, unseen bytes in between; one comparison
    with the leaf reached tells the first difference, above which a new node is put.
    """

    def __init__(self, text: bytes, depth: int, length: int):
        self.text, self.depth, self.length = text, depth, length
        self.root: list | None = None  # leaf: [-1, starts]; inner: [place, {byte: node}]

    def add(self, start: int) -> None:
        if self.root is None:
            self.root = [-1, [start]]
            return
        text, node = self.text, self.root
        while node[0] >= 0:
            node = node[1].get(text[start + node[0]]) or next(iter(node[1].values()))
        a = text[start + self.depth : start + self.length]
        other = node[1][0]
        b = text[other + self.depth : other + self.length]
        if a == b:
            node[1].append(start)
            return
        differs = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
        place = self.depth + len(a) - (differs.bit_length() + 7) // 8
        above, node = None, self.root
        while 0 <= node[0] < place:
            above, node = node, node[1][text[start + node[0]]]
        if node[0] == place:
            node[1][text[start + place]] = [-1, [start]]
            return
        new = [place, {text[other + place]: node, text[start + place]: [-1, [start]]}]
        if above is None:
            self.root = new
        else:
            above[1][text[start + above[0]]] = new

    def leaves(self) -> list[list[int]]:
        """Starts of equal strings, in order of the strings."""
        out, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if node[0] < 0:
                out.append(node[1])
            else:
                todo.extend(node[1][b] for b in sorted(node[1], reverse=True))
        return out


def suffix_groups(text: bytes, starts: np.ndarray, length: int) -> list[list[int]]:
    """The groups of :func:`suffix_order`, one list each."""
    order, sizes = suffix_order(text, starts, length)
    ends = np.cumsum(sizes)
    return [order[a:z].tolist() for a, z in zip((ends - sizes).tolist(), ends.tolist())]


def suffix_order(text: bytes, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``text`` at ``starts``, compared to ``length`` bytes (at least ``SHALLOW``):
    (starts in order of the strings, sizes of the groups of equal strings). All strings lie within the text."""
    order, sizes = array("q"), array("q")
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    symbols = np.ndarray(len(text) - 7, ">u8", text, strides=(1,))
    todo = [(np.asarray(starts, np.int64), 0)]

    def deep(group: list[int]) -> None:
        if len(group) == 1:
            order.append(group[0])
            sizes.append(1)
            return
        trie = BlindTrie(text, SHALLOW, length)
        for s in group:
            trie.add(s)
        for leaf in trie.leaves():
            order.extend(leaf)
            sizes.append(len(leaf))

    while todo:
        part, depth = todo.pop()
        if depth >= SHALLOW:
            deep(part.tolist())
        elif len(part) <= SMALL:
            alike: dict[bytes, list[int]] = {}
            for s in part.tolist():
                alike.setdefault(text[s + depth : s + SHALLOW], []).append(s)
            for k in sorted(alike):
                deep(alike[k])
        else:
            symbol = symbols[part + depth].astype(np.uint64)
            pivot = np.sort(symbol[[0, len(part) // 2, -1]])[1]
            todo += [(x, d) for x, d in ((part[symbol > pivot], depth), (part[symbol == pivot], depth + 8), (part[symbol < pivot], depth)) if len(x)]
    return np.array(order, np.int64), np.array(sizes, np.int64)
