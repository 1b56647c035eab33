"""A minimal acyclic automaton from words to numbered outputs, read from mapped memory.

States that accept the same rest words are one state (shared suffixes). An edge carries how many
words come before those it leads to, so a walk adds up the number of a word, and the number finds
the word's ids. The automaton is one block of 32-bit integers.
"""

from __future__ import annotations

import mmap
from array import array

#: Places of the block's header: states, edges, words, ids.
HEADER = 4


class _State:
    __slots__ = ("edges", "final", "place")

    def __init__(self):
        self.edges: dict[int, _State] = {}
        self.final = False
        self.place = -1

    def signature(self) -> tuple:
        return (self.final, *((label, id(state)) for label, state in self.edges.items()))


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The block of a lexicon; words are added in order, and finished branches are shared."""
    root, register = _State(), {}
    path: list[tuple[_State, int, _State]] = []
    last = b""

    def share(down_to: int) -> None:
        while len(path) > down_to:
            parent, label, child = path.pop()
            parent.edges[label] = register.setdefault(child.signature(), child)

    words = sorted(word for word in entries if word)
    for word in words:
        common = 0
        while common < min(len(last), len(word)) and last[common] == word[common]:
            common += 1
        share(common)
        state = path[-1][2] if path else root
        for label in word[common:]:
            fresh = _State()
            state.edges[label] = fresh
            path.append((state, label, fresh))
            state = fresh
        state.final, last = True, word
    share(0)
    return _block(root, [entries[word] for word in words])


def _block(root: _State, outputs: list[list[int]]) -> bytes:
    order: list[_State] = []
    waiting = [root]
    while waiting:
        state = waiting.pop()
        if state.place < 0:
            state.place = len(order)
            order.append(state)
            waiting.extend(state.edges.values())
    # Words below each state, those of its edges first; a word may be too long to recurse along it.
    accepted: dict[int, int] = {}
    waiting = [root]
    while waiting:
        state = waiting[-1]
        below = [child for child in state.edges.values() if child.place not in accepted]
        if below:
            waiting.extend(below)
        else:
            accepted[state.place] = state.final + sum(accepted[child.place] for child in state.edges.values())
            waiting.pop()

    first, finals, labels, targets, skips = array("i"), array("i"), array("i"), array("i"), array("i")
    for state in order:
        first.append(len(labels))
        finals.append(state.final)
        passed = int(state.final)
        for label, child in sorted(state.edges.items()):
            labels.append(label)
            targets.append(child.place)
            skips.append(passed)
            passed += accepted[child.place]
    first.append(len(labels))
    ends, ids = array("i", [0]), array("i")
    for output in outputs:
        ids.extend(output)
        ends.append(len(ids))
    header = array("i", [len(order), len(labels), len(outputs), len(ids)])
    return b"".join(part.tobytes() for part in (header, first, finals, labels, targets, skips, ends, ids))


class Lexicon:
    """A compiled lexicon; ``get`` finds the ids of a word, None where it has none."""

    def __init__(self, block):
        view = memoryview(block).cast("i")
        states, edges, words, ids = view[:HEADER]
        at = HEADER
        parts = []
        for size in (states + 1, states, edges, edges, edges, words + 1, ids):
            parts.append(view[at : at + size])
            at += size
        self.first, self.finals, self.labels, self.targets, self.skips, self.ends, self.ids = parts
        self.words = words

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        """The lexicon of a file, shared in memory by all processes of a machine."""
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> list[int] | None:
        first, labels = self.first, self.labels
        state = number = 0
        for byte in word:
            low, end = first[state], first[state + 1]
            high = end
            while low < high:
                middle = (low + high) // 2
                if labels[middle] < byte:
                    low = middle + 1
                else:
                    high = middle
            if low == end or labels[low] != byte:
                return None
            number += self.skips[low]
            state = self.targets[low]
        if not self.finals[state] or not word:
            return None
        return self.ids[self.ends[number] : self.ends[number + 1]].tolist()
