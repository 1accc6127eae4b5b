"""Token ids of many texts by a table of their distinct chunks.

Texts are cut at places that no token crosses, each distinct chunk of a batch is
encoded once, and ids are put together by position. Everything but encoding the
distinct chunks runs in Arrow and numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Marks the cuts; texts that hold it are encoded whole.
CUT = "\x00"
# Words encoded by one call, so that the library's objects stay few.
CALL = 20_000


def flat(encoded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as the size of each and one row of ids."""
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    return sizes, np.fromiter((i for ids in encoded for i in ids), np.uint32, int(sizes.sum()))


def in_calls(
    words: list[str], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and ids of all words, encoded a bounded number at a time."""
    parts = [encode(words[i : i + CALL]) for i in range(0, len(words), CALL)]
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


class Known:
    """Ids of words met in earlier batches, of a bounded number of words.

    When there are too many, the words of the present batch are kept, which holds
    the frequent ones.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int) -> None:
        self.encode, self.most = encode, most
        self.place: dict[str, int] = {}
        self.sizes, self.values = np.empty(0, np.int64), np.empty(0, np.uint32)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of distinct words."""
        at = np.fromiter((self.place.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        unknown = [words[i] for i in new.tolist()]
        if unknown:
            sizes, values = in_calls(unknown, self.encode)
            at[new] = len(self.sizes) + np.arange(len(new))
            self.sizes = np.concatenate([self.sizes, sizes])
            self.values = np.concatenate([self.values, values])
        sizes = self.sizes[at]
        first = (np.cumsum(self.sizes) - self.sizes)[at]
        values = self.values[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        if len(self.sizes) > self.most:
            self.place = {w: i for i, w in enumerate(words)}
            self.sizes, self.values = sizes, values
        else:
            self.place.update(zip(unknown, at[new].tolist(), strict=True))
        return sizes, values


class Chunks:
    """The chunks of texts: a dictionary, and for each text the entries it is made of."""

    def __init__(self, texts: pa.Array, patterns: Sequence[tuple[str, str]]) -> None:
        for pattern, mark in patterns:
            texts = pc.replace_substring_regex(texts, pattern, mark)
        lists = pc.split_pattern(texts, CUT)
        coded = lists.flatten().dictionary_encode()
        self.ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        self.at = coded.indices.to_numpy()
        self.words: list[str] = coded.dictionary.to_pylist()

    def ids(self, sizes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one row, and where each text's ids begin; the end closes it.

        Given are the ids of all words in one row, and the number of each word's.
        """
        first = np.cumsum(sizes) - sizes
        size = sizes[self.at]
        ends = np.concatenate([[0], np.cumsum(size)])
        # A batch has far fewer ids than 32 bits count.
        place = np.repeat((first[self.at] - ends[:-1]).astype(np.int32), size)
        place += np.arange(len(place), dtype=np.int32)
        return values[place], ends[self.ends]

    def joined(self, texts: list[str]) -> pa.Array:
        """A text made of replacements for the words, for each text."""
        parts = pa.array(texts, pa.string()).take(pa.array(self.at))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), parts), "")


def close_each(values: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with an end id behind each text's."""
    closed = np.insert(values, ends[1:], np.uint32(end_id))
    return closed, ends + np.arange(len(ends))

