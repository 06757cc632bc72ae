"""Ids of texts from the ids of their words, without a Python step per word."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Characters of the texts that are cut up at a time.
CHARS = 1 << 21


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of about ``CHARS`` characters; a longer text is a run of its own."""
    taken, size = [], 0
    for text in texts:
        if taken and size + len(text) > CHARS:
            yield taken
            taken, size = [], 0
        taken.append(text)
        size += len(text)
    if taken:
        yield taken


class WordMemory:
    """Ids of words met lately: of those not met again while others came, they are forgotten.

    Long words are not kept, so the memory is bounded by the number of words.
    """

    def __init__(self, limit: int, longest: int = 64) -> None:
        self.limit, self.longest = limit, longest
        self.lately: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def ids(self, words: list[str], learn: Callable[[list[str]], dict[str, bytes]]) -> list[bytes]:
        """The ids of distinct words; ``learn`` gives those of words that are not remembered."""
        if len(self.lately) > self.limit:
            self.lately, self.before = {}, self.lately
        found = list(map(self.lately.get, words))
        if None not in found:
            return found
        missing = [w for w, ids in zip(words, found) if ids is None]
        known = {w: self.before[w] for w in missing if w in self.before}
        known |= learn([w for w in missing if w not in known])
        self.lately.update((w, ids) for w, ids in known.items() if len(w) <= self.longest)
        return [known[w] if ids is None else ids for w, ids in zip(words, found)]


def joined(
    words: list[list[str]], ids_of: Callable[[list[str]], list[bytes]]
) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`joined_coded`, from words as Python strings."""
    counts = np.array([len(w) for w in words], dtype=np.int64)
    return joined_coded(pa.array(list(itertools.chain.from_iterable(words)), pa.string()), counts, ids_of)


def joined_coded(
    flat: pa.Array, counts: np.ndarray, ids_of: Callable[[list[str]], list[bytes]]
) -> tuple[np.ndarray, np.ndarray]:
    """All ids of texts cut into words, one text after the other, and their number per text.

    ``flat`` has the words of all texts and ``counts`` how many each text has. ``ids_of`` gets the
    distinct words and returns the ids of each as little-endian integers.
    """
    coded = flat.dictionary_encode()
    found = ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.frombuffer(b"".join(found), dtype="<i4")
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
    ids = lists.take(coded.indices).flatten().to_numpy()
    before = np.concatenate(([0], np.cumsum(sizes[coded.indices.to_numpy()])))
    at = np.cumsum(counts)
    return ids, before[at] - before[at - counts]


def as_lists(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.ListArray:
    """The ids of consecutive runs of texts as one array of lists."""
    none = np.empty(0, dtype=np.int32)
    values = np.concatenate([none, *(ids for ids, _ in parts)])
    counts = np.concatenate([none, *(n for _, n in parts)])
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32, copy=False)))
