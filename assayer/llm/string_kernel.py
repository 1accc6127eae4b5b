"""A gap-weighted subsequence kernel of words, evaluated for many words at once.

The features of a word are its subsequences of three symbols. Each occurrence
counts `DECAY` to the power of the symbols it spans, six at most, so subsequences
with other characters in between still count, less with every one of them. The
symbols are a mark at the front of the word, its letters, and one for all other
characters, which no subsequence may hold but any may skip. The kernel of two
words is the cosine of their features.

Kernels with landmarks below `FLOOR` read as 0. An upper bound of a word's kernels
shows which words can reach it; only for these are the kernels computed.
"""

from __future__ import annotations

import numpy as np

DECAY, SPAN, FLOOR = 0.7, 6, 0.5
# Symbols: other characters, a to z, classes of further letters, the front mark.
LETTERS, FRONT, SYMBOLS = 26, 63, 64
# Blanks between words, so that no subsequence reaches over.
GAP = SPAN - 1
# Words worked on at once.
BLOCK = 20_000

_OFFSETS = [(i, j) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN)]
_FACTORS = [DECAY ** (j + 1) for _, j in _OFFSETS]


def _symbol_table() -> np.ndarray:
    points = np.arange(0x10000)
    table = np.zeros(0x10000, np.int32)
    letter = np.array([chr(p).isalpha() for p in points])
    table[letter] = LETTERS + 1 + points[letter] % (FRONT - LETTERS - 1)
    table[ord("a") : ord("z") + 1] = np.arange(1, LETTERS + 1)
    return table


_TABLE = _symbol_table()


def symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words in one row of symbols, and the number of the word at each place."""
    text = (" " * GAP).join([" " + w for w in words]) + " " * GAP
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    row = _TABLE[np.minimum(points, 0xFFFF)]
    size = np.fromiter((len(w) + 1 + GAP for w in words), np.int64, len(words))
    row[np.cumsum(size) - size] = FRONT
    return row, np.repeat(np.arange(len(words)), size)


def _triples(row: np.ndarray):
    """For each pair of offsets: the feature at each place, its weight, and where it counts."""
    n = len(row) - GAP
    first = row[:n] * (SYMBOLS * SYMBOLS)
    some = row[:n] > 0
    for (i, j), factor in zip(_OFFSETS, _FACTORS, strict=True):
        middle, last = row[i : n + i], row[j : n + j]
        yield first + middle * SYMBOLS + last, factor, some & (middle > 0) & (last > 0)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse feature vectors of length 1: word number, feature and value, sorted."""
    row, of = symbols(words)
    keys, values = [], []
    for feature, factor, counts in _triples(row):
        at = np.flatnonzero(counts)
        keys.append(of[at] * SYMBOLS**3 + feature[at])
        values.append(np.full(len(at), factor))
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    keys, back = np.unique(np.concatenate(keys), return_inverse=True)
    values = np.bincount(back, np.concatenate(values), len(keys))
    word, feature = keys // SYMBOLS**3, keys % SYMBOLS**3
    norm = np.sqrt(np.bincount(word, values * values, len(words)))
    return word, feature, values / norm[word]


def gram(one: list[str], two: list[str]) -> np.ndarray:
    """The kernels of all words of one list with those of another."""
    (word, feature, value), (other, other_feature, other_value) = features(one), features(two)
    kinds = np.unique(np.concatenate([feature, other_feature]))
    a = np.zeros((len(one), len(kinds)), np.float32)
    b = np.zeros((len(two), len(kinds)), np.float32)
    a[word, np.searchsorted(kinds, feature)] = value
    b[other, np.searchsorted(kinds, other_feature)] = other_value
    return a @ b.T


class Landmarks:
    """Landmark words, and the kernels of other words with them.

    Words that do not reach the floor with one of the first `gate` landmarks
    have no kernels.
    """

    def __init__(self, words: list[str], gate: int) -> None:
        self.gate = gate
        word, feature, value = features(words)
        self.words = words
        kinds, row = np.unique(feature, return_inverse=True)
        self.row_of = np.zeros(SYMBOLS**3, np.int32)
        self.row_of[kinds] = np.arange(1, len(kinds) + 1)
        self.weights = np.zeros((len(kinds) + 1, len(words)), np.float32)
        self.weights[row + 1, word] = value
        self.most = np.zeros(SYMBOLS**3, np.float32)
        self.most[kinds] = self.weights[1:, :gate].max(axis=1)

    def _reaching(self, words: list[str]) -> list[int]:
        """Words with a kernel that may reach the floor.

        The norm is at least that of features that are all different.
        """
        row, of = symbols(words)
        n = len(row) - GAP
        bound, square = np.zeros(n, np.float32), np.zeros(n, np.float32)
        for feature, factor, counts in _triples(row):
            bound += np.float32(factor) * np.where(counts, self.most[feature], 0)
            square += np.float32(factor * factor) * counts
        starts = np.flatnonzero(row[:n] == FRONT)
        bound, square = np.add.reduceat(bound, starts), np.add.reduceat(square, starts)
        return np.flatnonzero((bound > 0) & (bound >= 0.999 * FLOOR * np.sqrt(square))).tolist()

    def kernels(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of words that reach the floor, and their kernels with all landmarks."""
        positions, found = [], []
        for start in range(0, len(words), BLOCK):
            part = words[start : start + BLOCK]
            reach = self._reaching(part) if part else []
            if not reach:
                continue
            word, feature, value = features([part[i] for i in reach])
            known = np.flatnonzero(self.row_of[feature])
            total = np.zeros((len(reach), len(self.words)), np.float32)
            np.add.at(
                total,
                word[known],
                self.weights[self.row_of[feature[known]]] * value[known, None].astype(np.float32),
            )
            total[total < FLOOR] = 0
            some = np.flatnonzero(total[:, : self.gate].any(axis=1))
            positions.append(np.array(reach)[some] + start)
            found.append(total[some])
        if not found:
            return np.empty(0, np.int64), np.empty((0, len(self.words)), np.float32)
        return np.concatenate(positions), np.concatenate(found)
