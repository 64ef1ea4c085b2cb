"""Weighted acyclic automata over word sequences: built from sorted n-grams, united with summed weights, composed.

A state is a sequence of words that was seen, its arc from the state one word shorter is labelled with the last
word, and its weight is how often the whole sequence occurred. States are held level by level in sorted order as flat
arrays, so building appends a level at a time, uniting merges sorted levels and adds weights, and composing
with a set of sequences reads the weights of all their beginnings off one path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa


@dataclass
class Transducer:
    """``words`` in ascending order; per level the parent state, the label and the weight of each state, ascending by (parent, label)."""

    words: np.ndarray  # of bytes objects
    parents: list[np.ndarray]
    labels: list[np.ndarray]
    weights: list[np.ndarray]

    def __len__(self) -> int:
        return sum(map(len, self.weights))

    def arrow(self) -> dict[str, list]:
        """Columns of one row: the words, and the levels one after another with their sizes."""
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return {"words": self.words.tolist(), "sizes": [len(w) for w in self.weights], "parents": flat(self.parents), "labels": flat(self.labels),
                "weights": flat(self.weights)}


ARROW = [("words", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("parents", pa.list_(pa.int32())), ("labels", pa.list_(pa.int32())),
         ("weights", pa.list_(pa.int64()))]
SCHEMA = "words array<binary>, sizes array<int>, parents array<int>, labels array<int>, weights array<bigint>"


def from_arrow(words, sizes, parents, labels, weights) -> Transducer:
    cuts = np.cumsum(sizes.values.to_numpy())[:-1]
    split = lambda x: np.split(x.values.to_numpy().astype(np.int64), cuts)
    return Transducer(objects(words.as_py()), split(parents), split(labels), split(weights))


def objects(words: list[bytes]) -> np.ndarray:
    out = np.empty(len(words), object)
    out[:] = words
    return out


def build(words: np.ndarray, line: np.ndarray, joined: np.ndarray, longest: int) -> Transducer:
    """All sequences of 1 to ``longest`` words of ``line``, numbers of ``words`` (ascending) or -1 for a break.

    ``joined`` tells of every place but the last whether the word goes on to the next. Each level takes the sequences of
    the one before that go on, sorts them by (state, next word) and appends one state for each run of equal ones.
    """
    at = np.flatnonzero(line >= 0)
    state, weights = np.unique(line[at], return_inverse=True)
    parents, labels, counts = [np.zeros(len(state), np.int64)], [state], [np.bincount(weights, minlength=len(state))]
    state = weights
    for length in range(2, longest + 1):
        end = at + length - 1
        goes_on = end < len(line)
        at, state = at[goes_on], state[goes_on]
        goes_on = joined[at + length - 2]
        at, state = at[goes_on], state[goes_on]
        if not len(at):
            break
        key, state, n = np.unique(state * len(words) + line[at + length - 1], return_inverse=True, return_counts=True)
        parents.append(key // len(words))
        labels.append(key % len(words))
        counts.append(n)
    return Transducer(words, parents, labels, counts)


def united(some: list[Transducer]) -> Transducer:
    """One transducer of all sequences, weights of equal ones added."""
    if len(some) == 1:
        return some[0]
    if not some:
        return Transducer(objects([]), [], [], [])
    words = objects(sorted(set().union(*(t.words.tolist() for t in some))))
    number = {w: i for i, w in enumerate(words.tolist())}
    renamed = [np.fromiter(map(number.__getitem__, t.words.tolist()), np.int64, len(t.words)) for t in some]
    state: list[np.ndarray] = [np.zeros(1, np.int64) for _ in some]
    parents, labels, weights = [], [], []
    for level in range(max(len(t.weights) for t in some)):
        with_it = [i for i, t in enumerate(some) if len(t.weights) > level]
        key = np.concatenate([state[i][some[i].parents[level]] * len(words) + renamed[i][some[i].labels[level]] for i in with_it])
        keys, place = np.unique(key, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, place, np.concatenate([some[i].weights[level] for i in with_it]))
        cuts = np.cumsum([len(some[i].weights[level]) for i in with_it])[:-1]
        for i, mine in zip(with_it, np.split(place, cuts), strict=True):
            state[i] = mine
        parents.append(keys // len(words))
        labels.append(keys % len(words))
        weights.append(total)
    return Transducer(words, parents, labels, weights)


def by_prefix(t: Transducer, range_of) -> dict[int, Transducer]:
    """``t`` cut into ranges of prefixes. ``range_of(first, second)`` gives a range per pair of words, -1 for second on the first level.

    It may answer with a range for a first word alone, or with -1 where the second word decides; then the state of the first word goes into
    every range in ``range_of.spread(first)``, so that each range holds the whole paths of its sequences.
    """
    out: dict[int, Transducer] = {}
    if not len(t):
        return out
    own = [range_of(t.words[t.labels[0]], None)]
    if len(t.weights) > 1:
        above = own[0][t.parents[1]]
        split = above < 0
        second = above.copy()
        if split.any():
            second[split] = range_of(t.words[t.labels[0][t.parents[1][split]]], t.words[t.labels[1][split]])
        own.append(second)
        for level in range(2, len(t.weights)):
            own.append(own[-1][t.parents[level]])
    spread = np.flatnonzero(own[0] < 0)
    wide = {int(i): range_of.spread(t.words[t.labels[0][i]]) for i in spread}
    numbers = set(np.unique(own[0][own[0] >= 0]).tolist()).union(*wide.values())
    for r in sorted(numbers):
        first = own[0] == r
        for i, where in wide.items():
            first[i] = r in where
        keep = [first] + [o == r for o in own[1:]]
        out[r] = _kept(t, keep)
    return out


def _kept(t: Transducer, keep: list[np.ndarray]) -> Transducer:
    parents, labels, weights, place = [], [], [], np.zeros(1, np.int64)
    for level, kept in enumerate(keep):
        if not kept.any():
            break
        parents.append(place[t.parents[level][kept]])
        labels.append(t.labels[level][kept])
        weights.append(t.weights[level][kept])
        place = np.cumsum(kept) - 1
    used = np.unique(np.concatenate(labels)) if labels else np.zeros(0, np.int64)
    renamed = np.zeros(len(t.words), np.int64)
    renamed[used] = np.arange(len(used))
    return Transducer(t.words[used], parents, [renamed[x] for x in labels], weights)


def paths(t: Transducer, level: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequences of ``level + 1`` words of at least ``least``: their labels and the weights of all their beginnings, a row each."""
    state = np.flatnonzero(t.weights[level] >= least)
    labels, weights = [], []
    for up in range(level, -1, -1):
        labels.append(t.labels[up][state])
        weights.append(t.weights[up][state])
        state = t.parents[up][state]
    return np.stack(labels[::-1], axis=1), np.stack(weights[::-1], axis=1)
