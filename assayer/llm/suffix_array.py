"""Suffix order of a row of characters by difference covers.

Suffixes at places that leave 1 or 2 when divided by 3 are the sample. Their
first three characters are sorted and named; the names, those of the places
leaving 1 and then those leaving 2, are a string of two thirds of the length,
and its suffix order, found in the same way, is that of the sample. The other
suffixes are sorted by their character and the rank of the rest, and merged in:
the sample has the rank of what follows the first one or two characters on both
sides. Recursion ends when all names differ, or when names stand for as many
characters as are to be told apart.
"""

from __future__ import annotations

import numpy as np

# Names below this are packed by threes into a number.
_BITS = 21


def _sorted(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of triples, and which of the sorted ones differ from the one before."""
    new = np.ones(len(a), bool)
    if max(int(x.max(initial=0)) for x in (a, b, c)) < 1 << _BITS:
        key = (a << 2 * _BITS) | (b << _BITS) | c
        order = np.argsort(key)
        key = key[order]
        new[1:] = key[1:] != key[:-1]
        return order, new
    order = np.lexsort((c, b, a))
    a, b, c = a[order], b[order], c[order]
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
    return order, new


def suffix_order(text: np.ndarray, depth: int, stands_for: int = 1) -> np.ndarray:
    """Places of all suffixes of positive numbers, sorted.

    Suffixes equal in their first `depth` characters may come in any order.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    if int(text.max()) > max(n, 1 << _BITS):
        text = np.unique(text, return_inverse=True)[1] + 1
    t = np.concatenate([text, np.zeros(4, np.int64)])
    # More than any character and any rank.
    base = max(n + 4, int(text.max()) + 1)
    # A sample place behind the end keeps the two parts of the names apart.
    places = [np.arange(r, n + (n % 3 == 1), 3) for r in (1, 2)]
    sample = np.concatenate(places)
    order, new = _sorted(t[sample], t[sample + 1], t[sample + 2])
    if stands_for * 3 < depth and not new.all():
        names = np.empty(len(sample), np.int64)
        names[order] = np.cumsum(new)
        order = suffix_order(names, depth, stands_for * 3)
    ranked, is_one = sample[order], order < len(places[0])
    rank = np.zeros(n + 4, np.int64)
    rank[ranked] = np.arange(1, len(ranked) + 1)
    if n % 3 == 1:
        ranked, is_one = ranked[ranked < n], is_one[ranked < n]
    # The others by character and rest, then where they belong in the sample.
    other = np.arange(0, n, 3)
    other = other[np.argsort(t[other] * base + rank[other + 1])]
    ones, twos = ranked[is_one], ranked[~is_one]
    before = np.searchsorted(t[ones] * base + rank[ones + 1], t[other] * base + rank[other + 1])
    pairs = [t[x] * base + t[x + 1] for x in (twos, other)]
    if base > 1 << _BITS:
        names = np.unique(np.concatenate(pairs), return_inverse=True)[1]
        pairs = [names[: len(twos)], names[len(twos) :]]
    keys = (p * base + rank[x + 2] for p, x in zip(pairs, (twos, other), strict=True))
    before += np.searchsorted(*keys)
    # Where suffixes do not differ within the depth, ranks may cross: straighten them.
    at = np.maximum.accumulate(before) + np.arange(len(other))
    merged = np.empty(n, np.int64)
    merged[at] = other
    free = np.ones(n, bool)
    free[at] = False
    merged[free] = ranked
    return merged


def words_of_eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    packed = np.concatenate([data, np.zeros(7, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        packed = (packed[:-step] << np.uint64(8 * step)) | packed[step:]
    return packed


def equal_to_previous(data: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Whether the `size` bytes at each place are those at the place before in the row."""
    words = words_of_eight(data)
    equal = np.zeros(len(places), bool)
    equal[1:] = True
    for step in [*range(0, size - 8, 8), size - 8]:
        here = words[places + step]
        equal[1:] &= here[1:] == here[:-1]
    return equal
