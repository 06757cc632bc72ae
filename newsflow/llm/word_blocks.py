"""Words of many texts at once, on the bytes of Arrow buffers, without a Python object per word."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

# Bytes of text in a block. A longer text is a block of its own.
BLOCK = 6 << 20


def byte_table(chars: bytes) -> np.ndarray:
    """A flag per byte value, set for the given ones."""
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


@dataclass(frozen=True)
class Words:
    """Words of a block: their bytes one after the other, where each ends, and its text."""

    data: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    def __len__(self) -> int:
        return len(self.ends)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1])).astype(np.int64)

    def array(self) -> pa.Array:
        """The words as an Arrow array over the same bytes."""
        offsets = np.concatenate(([0], self.ends)).astype(np.int64)
        return pa.Array.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.data)]
        )

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A number per word, equal for equal words alone, and the distinct words."""
        found = self.array().dictionary_encode()
        return found.indices.to_numpy(), found.dictionary

    def spaced(self) -> tuple[bytes, np.ndarray]:
        """All words joined by single spaces, and where each starts there (and one more)."""
        places = np.arange(len(self))
        out = np.full(len(self.data) + len(self), 0x20, dtype=np.uint8)
        at = np.arange(len(self.data)) + np.repeat(places, np.diff(self.ends, prepend=0))
        out[at] = self.data
        return out.tobytes(), np.concatenate(([0], self.ends + places + 1))


def words_of(texts: list[bytes], blanks: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of ``texts``: runs of bytes not flagged in ``blanks`` (line feed must be flagged).

    Also where each word starts in the texts joined by line feeds.
    """
    byte = np.frombuffer(b"\n".join(texts), np.uint8)
    solid = ~blanks[byte]
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    borders = np.cumsum(sizes + 1)
    text = np.searchsorted(borders, starts, side="right")
    return Words(byte[solid], np.cumsum(ends - starts), text), starts


def hashed(distinct: pa.Array) -> np.ndarray:
    """A 64-bit hash of each of some distinct words."""
    words = distinct.to_pylist()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Hashes whose every bit depends on every bit of ``values`` (64 bits, unsigned)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingled(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive values, in order; none where there are fewer."""
    n = max(0, len(values) - width + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + values[k : k + n]
    return mixed(total)


def blocks(frames: Iterable[pa.RecordBatch], size: int | None = None) -> Iterator[list[dict]]:
    """Rows in runs of about ``size`` bytes of their column ``text``, across Arrow batches."""
    held, total = [], 0
    size = BLOCK if size is None else size
    for frame in frames:
        for row in frame.to_pylist():
            more = len(row["text"])
            if held and total + more > size:
                yield held
                held, total = [], 0
            held.append(row)
            total += more
    if held:
        yield held


def by_part(frames: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Runs of rows with one ``part``; their lists are arrays, their other values Python's."""
    held, part = [], None
    for frame in frames:
        columns = dict(zip(frame.schema.names, frame.columns))
        for k, mine in enumerate(columns["part"].to_pylist()):
            if mine != part and held:
                yield held
                held = []
            part = mine
            held.append({
                name: c[k].values.to_numpy() if pa.types.is_list(c.type) else c[k].as_py()
                for name, c in columns.items()
            })
    if held:
        yield held


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where in sorted rows a new combination of keys begins."""
    n = len(keys[0])
    change = np.zeros(n, dtype=bool)
    change[:1] = True
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(change)


def span_places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the spans that begin at ``starts`` and have ``sizes`` places, in order."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - np.repeat(before - starts, sizes)


def pieces_of(data: bytes, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return list(itertools.starmap(lambda a, b: data[a:b], zip(starts.tolist(), ends.tolist())))
