"""A minimal acyclic transducer from words to token ids, kept in flat arrays.

States that accept the same suffixes are one state. Each edge carries the number of
words that come before its own in sorted order, so the sum of a path's edges is the
word's ordinal, and the ordinal finds the word's ids. The arrays are one block of
bytes that can be memory-mapped and shared by all worker processes of a machine.
"""

from __future__ import annotations

import hashlib
import mmap
import os

import numpy as np

_HEAD = 8  # int64 sizes before the arrays


def build(words: dict[bytes, tuple[int, ...]]) -> bytes:
    """The automaton of words and their ids as one block of bytes."""
    order = sorted(words)
    # each state: final, then edges as [label, child]; children are frozen bottom-up
    root = [False, {}]
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    path: list[list] = [root]
    last = b""

    def freeze(state: list) -> int:
        key = (state[0], tuple(state[1].items()))
        if (n := register.get(key)) is None:
            n = register[key] = len(frozen)
            frozen.append(key)
        return n

    for word in [*order, None]:
        same = len(os.path.commonprefix([last, word])) if word is not None else 0
        for depth in range(len(path) - 1, same, -1):
            path[depth - 1][1][last[depth - 1]] = freeze(path.pop())
        if word is None:
            break
        for label in word[same:]:
            path.append([False, {}])
        path[-1][0] = True
        last = word
    start = freeze(root)

    total = np.zeros(len(frozen), np.int64)
    first = np.zeros(len(frozen) + 1, np.int64)
    labels, targets, before = [], [], []
    for n, (final, edges) in enumerate(frozen):  # children come before parents
        count = int(final)
        for label, child in edges:
            labels.append(label)
            targets.append(child)
            before.append(count)
            count += int(total[child])
        total[n] = count
        first[n + 1] = len(labels)
    lengths = [len(words[w]) for w in order]
    parts = [
        first.astype(np.int32), np.array([f for f, _ in frozen], np.int32), np.array(labels, np.int32),
        np.array(targets, np.int32), np.array(before, np.int32), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32),
        np.array([i for w in order for i in words[w]], np.int32),
    ]
    head = np.array([start, *(len(p) for p in parts)], np.int64)
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Looks words up in the bytes that build() made."""

    def __init__(self, block: bytes | mmap.mmap):
        head = np.frombuffer(block, np.int64, _HEAD)
        self.start, at, parts = int(head[0]), _HEAD * 8, []
        for size in head[1:]:
            parts.append(memoryview(block)[at : at + 4 * int(size)].cast("i"))
            at += 4 * int(size)
        self.first, self.final, self.labels, self.targets, self.before, self.offsets, self.ids = parts

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> tuple[int, ...] | None:
        """The ids of a word of the lexicon, else None."""
        state, ordinal = self.start, 0
        for label in word:
            for edge in range(self.first[state], self.first[state + 1]):
                if self.labels[edge] == label:
                    ordinal += self.before[edge]
                    state = self.targets[edge]
                    break
            else:
                return None
        if not self.final[state]:
            return None
        return tuple(self.ids[self.offsets[ordinal] : self.offsets[ordinal + 1]])


def name_of(block: bytes) -> str:
    return f"lexicon-{hashlib.sha256(block).hexdigest()[:24]}.bin"
