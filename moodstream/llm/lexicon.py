"""A minimal acyclic transducer from words to rows of a table.

States with the same continuations are one state, so words share suffixes
as well as prefixes. Arcs carry whole numbers; their sum along a word's path is
the word's row (its place in sorted order), and the row leads to its token
ids. The automaton is a flat file of arrays that a process maps into memory;
all processes of a machine then share its pages.

``Transducer.rows`` walks many words at once: one binary search in the sorted
arc keys per byte position.
"""

from __future__ import annotations

import numpy as np


class _State:
    __slots__ = ("arcs", "final", "id", "words")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final, self.id, self.words = False, -1, 0

    def shape(self) -> tuple:
        return (self.final, *((b, id(s)) for b, s in self.arcs.items()))


def compile_words(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """The file for distinct words and their token ids."""
    order = sorted(range(len(words)), key=words.__getitem__)
    root, register, path = _State(), {}, []

    def freeze(depth: int) -> None:
        while len(path) > depth:
            parent, byte, state = path.pop()
            parent.arcs[byte] = register.setdefault(state.shape(), state)

    before = b""
    for k in order:
        word, same = words[k], 0
        while same < min(len(before), len(word)) and before[same] == word[same]:
            same += 1
        freeze(same)
        state = path[-1][2] if path else root
        for byte in word[same:]:
            nxt = _State()
            state.arcs[byte] = nxt
            path.append((state, byte, nxt))
            state = nxt
        state.final = True
        before = word
    freeze(0)

    states: list[_State] = []
    stack = [(root, False)]
    while stack:  # children first
        s, done = stack.pop()
        if done:
            if s.id < 0:
                s.id = len(states)
                s.words = s.final + sum(t.words for t in s.arcs.values())
                states.append(s)
        elif s.id < 0:
            stack.append((s, True))
            stack.extend((t, False) for t in s.arcs.values() if t.id < 0)
    arcs = []
    for s in states:
        passed = int(s.final)
        for byte in sorted(s.arcs):
            arcs.append((s.id * 256 + byte, s.arcs[byte].id, passed))
            passed += s.arcs[byte].words
    arcs.sort()
    flat = np.array(arcs, np.int64).reshape(-1, 3)
    lengths = np.array([len(ids[k]) for k in order], np.int64)
    table = np.concatenate([np.asarray(ids[k], np.int64) for k in order]) if order else np.empty(0, np.int64)
    head = np.array([len(states), len(flat), len(order), len(table), root.id], np.int64)
    final = np.array([s.final for s in states], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return b"".join(a.tobytes() for a in (head, flat[:, 0].copy(), flat[:, 1].copy(), flat[:, 2].copy(), final, offsets, table))


class Transducer:
    """A compiled lexicon, mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, np.int64, "r")
        states, arcs, words, ids, self.root = (int(x) for x in data[:5])
        parts, at = [], 5
        for n in (arcs, arcs, arcs, states, words + 1, ids):
            parts.append(data[at : at + n])
            at += n
        self.keys, self.target, self.out, self.final, self.offsets, self.ids = parts

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Each word's row, or -1."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        row = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not len(words):
            return row
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(lengths) - lengths
        live, state, total, at = np.flatnonzero(lengths > 0), None, None, 0
        state, total = np.full(len(live), self.root), np.zeros(len(live), np.int64)
        while len(live):
            key = state * 256 + flat[start[live] + at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[arc] == key
            live, arc, total = live[found], arc[found], total[found]
            state, total = np.asarray(self.target[arc]), total + self.out[arc]
            at += 1
            ended = lengths[live] == at
            hit = ended & (self.final[state] == 1)
            row[live[hit]] = total[hit]
            live, state, total = live[~ended], state[~ended], total[~ended]
        return row

    def token_ids(self, row: int) -> np.ndarray:
        return self.ids[self.offsets[row] : self.offsets[row + 1]]
