"""Removal of passages that repeat across documents, by super-k-mers of words.

A window is ``window`` consecutive words. Its minimiser is the least hash of the ``gram`` consecutive
words inside it, so windows with equal words have equal minimisers and meet in one bucket, and
consecutive windows that share a minimiser travel there as one packed string instead of one by one.
In the bucket all windows are sorted and the smallest document of each run of equal windows is read
off; words decide about equality, not hashes alone.

What bounds skew: within a block of documents equal strings go off once, from the block's smallest
document, and the others are marked at once, so a passage costs a row per block however many
documents share it. Classes of minimisers with more windows than the bound are counted beforehand;
their windows are dealt out singly, by all their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm import word_blocks as B
from newsflow.operators.scratch import written

BLANKS = B.byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")
# Bytes of packed strings that a task holds, and the pieces in which it sorts them.
PART, PIECES = 32 << 20, 16
# Windows that a class of minimisers may have before its windows are dealt out singly, the windows
# that it should have, and the most classes (as a power of two).
HEAVY, CLASS, CLASS_BITS = 1 << 18, 1 << 13, 22
LAST = (1 << 63) - 1
PACKED = (
    "part int, ranks array<long>, ties array<long>, texts array<int>, starts array<int>, "
    "sizes array<int>, counts array<int>, bytes array<int>, words binary"
)
SPANS = "rank long, tie long, start int, n int"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values, reach = np.minimum(values[:-reach], values[reach:]), 2 * reach
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:])


def window_keys(words: B.Words, window: int, gram: int, heavy: np.ndarray | None):
    """Per window: whether it lies in one text, and its key (minimiser, or all words if heavy)."""
    n = max(0, len(words) - window + 1)
    if not n:
        return np.zeros(0, dtype=bool), np.zeros(0, dtype=np.uint64)
    codes, distinct = words.coded()
    hashes = B.hashed(distinct)[codes]
    inside = words.text[window - 1 :] == words.text[:n]
    keys = B.mixed(_least(B.shingled(hashes, gram), window - gram + 1) + np.uint64(1))
    if heavy is not None and heavy.any():
        bits = int(log2(len(heavy)))
        at = np.flatnonzero(inside & heavy[(keys >> np.uint64(64 - bits)).astype(np.int64)])
        single = np.zeros(len(at), dtype=np.uint64)
        for k in range(window):
            single = single * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k]
        keys[at] = B.mixed(single)
    return inside, keys


def _runs(inside: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First windows of runs of one key, and how many windows each has."""
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~(inside[:-1] & (keys[1:] == keys[:-1]))
    stop[:-1] &= ~inside[1:] | start[1:]
    first = np.flatnonzero(start)
    return first, np.flatnonzero(stop) - first + 1


def _load(window: int, gram: int, bits: int):
    """Windows per class of minimisers, counted per task."""

    def counts(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for rows in B.blocks(frames):
            words, _ = B.words_of([r["text"] for r in rows], BLANKS)
            inside, keys = window_keys(words, window, gram, None)
            found = (keys[inside] >> np.uint64(64 - bits)).astype(np.int64)
            total += np.bincount(found, minlength=len(total))
        some = np.flatnonzero(total)
        columns = [pa.array(some.astype(np.int32)), pa.array(total[some])]
        yield pa.RecordBatch.from_arrays(columns, ["class", "windows"])

    return counts


def heavy_classes(rows: DataFrame, window: int, gram: int, bits: int) -> np.ndarray:
    """A flag per class of minimisers: more than ``HEAVY`` windows and twice its share.

    Fewer than half of the classes can have twice their share, so what comes to the driver is bounded
    by the number of classes, which ``CLASS_BITS`` bounds.
    """
    loads = rows.select("text").mapInArrow(_load(window, gram, bits), "class int, windows long")
    loads = written(loads.groupBy("class").agg(F.sum("windows").alias("windows")), "loads")
    total = loads.agg(F.sum("windows")).first()[0] or 0
    large = loads.where(F.col("windows") > max(HEAVY, 2 * total >> bits)).select("class")
    flags = np.zeros(1 << bits, dtype=bool)
    flags[large.toArrow()["class"].to_numpy()] = True
    return flags


def _packer(window: int, gram: int, parts: int, heavy: np.ndarray):
    """Blocks of documents to packed strings, one row per part, and spans known from the block."""
    packed_flags, bits = np.packbits(heavy), int(log2(len(heavy)))

    def pack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(packed_flags, count=1 << bits).astype(bool)
        squeeze = zstandard.ZstdCompressor(level=6).compress
        for block in B.blocks(frames):
            # Rows repeated with one id and text are one document.
            rows = list({(r["rank"], r["tie"]): r for r in block}.values())
            ranks, ties = (np.array([r[c] for r in rows], np.int64) for c in ("rank", "tie"))
            words, _ = B.words_of([r["text"] for r in rows], BLANKS)
            inside, keys = window_keys(words, window, gram, flags)
            first, sizes = _runs(inside, keys)
            if not len(first):
                continue
            data, places = words.spaced()
            strings = B.pieces_of(data, places[first], places[first + sizes + window - 1])
            texts, keys = words.text[first], keys[first]
            starts = first - np.searchsorted(words.text, texts)
            # Equal strings go off from the smallest document of the block; the rest is decided.
            codes = pa.array(strings, pa.large_binary()).dictionary_encode().indices.to_numpy()
            least = np.full(codes.max() + 1, LAST, dtype=np.int64)
            np.minimum.at(least, codes, ranks[texts])
            late = ranks[texts] > least[codes]
            out = []
            if late.any():
                out.append((int(keys[0] % np.uint64(parts)), ranks, ties, texts[late], starts[late],
                            sizes[late] + window - 1, [], [], None))
            part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            piece = keys % np.uint64(PIECES)
            sent = np.flatnonzero(~late)
            sent = sent[np.lexsort((piece[sent], part[sent]))]
            cuts = B.run_starts(part[sent])
            for at in np.split(sent, cuts[1:]) if len(sent) else ():
                parts_of = np.searchsorted(piece[at], np.arange(PIECES + 1))
                mine = [strings[k] for k in at.tolist()]
                ends = np.concatenate(([0], np.cumsum([len(s) for s in mine])))[parts_of]
                known, place = np.unique(texts[at], return_inverse=True)
                out.append((int(part[at[0]]), ranks[known], ties[known], place, starts[at],
                            sizes[at], np.diff(parts_of), np.diff(ends), squeeze(b"".join(mine))))
            kinds = [pa.int32(), *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.int32())] * 5, pa.binary()]
            columns = [pa.array(list(c)).cast(k) if k == pa.int32() else pa.array(list(c), k)
                       for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PACKED.split(", ")])

    return pack


def repeats(
    texts: list[bytes], ranks: np.ndarray, sizes: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that a smaller document has, too: their string, first window and number.

    ``texts`` hold the strings one after the other, ``sizes`` the windows of each.
    """
    words, _ = B.words_of(texts, BLANKS)
    codes, distinct = words.coded()
    lengths = sizes + window - 1
    places = B.span_places(np.cumsum(lengths) - lengths, sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    hashes = B.shingled(B.mixed(codes.astype(np.uint64) + np.uint64(1)), window)[places]
    rank = ranks[owner]
    while True:
        order = np.lexsort((rank, hashes))
        starts = B.run_starts(hashes[order])
        counts = np.diff(starts, append=len(order))
        many = np.repeat(counts > 1, counts)
        mine, other = places[order[many]], places[np.repeat(order[starts], counts)[many]]
        if all(np.array_equal(codes[mine + k], codes[other + k]) for k in range(window)):
            break
        # Different windows of one hash: number them by their words.
        listed = codes[places[:, None] + np.arange(window)]
        hashes = np.unique(listed, axis=0, return_inverse=True)[1].reshape(-1).astype(np.uint64)
    late = np.zeros(len(order), dtype=bool)
    late[order] = rank[order] > np.repeat(rank[order[starts]], counts)
    first, n = _runs(late, owner)
    return owner[first], first - (np.cumsum(sizes) - sizes)[owner[first]], n


def _sorter(window: int):
    """Spans of one part: those known already and those that its sorted windows show."""

    def spans_of(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        pieces: list[list] = [[] for _ in range(PIECES)]
        read = zstandard.ZstdDecompressor().decompress
        for row in rows:
            docs, starts, sizes = row["texts"], row["starts"], row["sizes"]
            ranks, ties = row["ranks"][docs], row["ties"][docs]
            if row["words"] is None:
                yield batch(ranks, ties, starts, sizes)
                continue
            data, at, begin = read(row["words"]), 0, 0
            for piece, count, size in zip(pieces, row["counts"].tolist(), row["bytes"].tolist()):
                if count:
                    some = slice(at, at + count)
                    piece.append((data[begin : begin + size], ranks[some], ties[some], starts[some], sizes[some]))
                at, begin = at + count, begin + size
        for piece in filter(None, pieces):
            texts, *columns = zip(*piece)
            ranks, ties, starts, sizes = map(np.concatenate, columns)
            owner, first, n = repeats(list(texts), ranks, sizes, window)
            yield batch(ranks[owner], ties[owner], starts[owner] + first, n + window - 1)

    def batch(ranks, ties, starts, sizes) -> pa.RecordBatch:
        columns = [ranks, ties, starts.astype(np.int32), sizes.astype(np.int32)]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["rank", "tie", "start", "n"])

    def spans(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in B.by_part(frames):
            yield from spans_of(rows)

    return spans


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"),
        F.xxhash64(text).alias("tie"),
        text.cast("binary").alias("text"),
    )


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, gram: int = 3
) -> DataFrame:
    """Spans of words (rank, tie, start, n) covered by windows that also start in a smaller document.

    ``rank`` is the id (a NULL id counts as the largest), ``tie`` the hash of the text. Spans may
    overlap. See :func:`remove_repeats` for the rest.
    """
    rows = _keyed(docs, id_col, text_col).drop("doc_id")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About 3 packed bytes per byte of text, and about six bytes to a word.
    setting = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(setting, ceil(3 * size / PART))
    bits = min(CLASS_BITS, max(8, round(log2(max(1, size / 6 / CLASS)))))
    heavy = heavy_classes(rows, window, gram, bits)
    packed = rows.mapInArrow(_packer(window, gram, parts, heavy), PACKED)
    dealt = packed.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
    return dealt.mapInArrow(_sorter(window), SPANS)


def _remover(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "text"]
    for rows in B.blocks(frames):
        words, _ = B.words_of([r["text"] for r in rows], BLANKS)
        bounds = np.searchsorted(words.text, np.arange(len(rows) + 1))
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for base, row in zip(bounds.tolist(), rows):
            if row["spans"]:
                at = np.array([s["start"] for s in row["spans"]]) + base
                np.add.at(change, at, 1)
                np.add.at(change, at + np.array([s["n"] for s in row["spans"]]), -1)
        kept = np.cumsum(change)[:-1] == 0
        sizes = np.diff(words.ends, prepend=0)
        left = B.Words(words.data[np.repeat(kept, sizes)], np.cumsum(sizes[kept]), words.text[kept])
        data, places = left.spaced()
        edges = np.searchsorted(left.text, np.arange(len(rows) + 1))
        # Without the space after the last word.
        ends = np.maximum(places[edges[1:]] - 1, places[edges[:-1]])
        n_words = np.diff(bounds)
        columns = [
            pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array(n_words),
            pa.array(n_words - np.diff(edges)),
            pa.array(B.pieces_of(data, places[edges[:-1]], ends), pa.binary()).cast(pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, gram: int = 3
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and text, the words kept.

    Words are runs of what is no ASCII white space. A word goes if some window that covers it has
    words that also start in a document with a smaller id; kept words are joined by one space. NULL
    and empty texts have no words. A text shorter than a window loses nothing. Rows of one id do not
    make each other lose words; rows repeated with one id and text get the same result. A NULL id
    counts as the largest. Very long texts are taken whole, as blocks of their own. An empty table
    gives an empty table; other columns are not looked at.
    """
    spans = written(repeated_spans(docs, id_col, text_col, window, gram), "spans")
    # The spans of one document: no more than it has words.
    listed = spans.groupBy("rank", "tie").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    rows = _keyed(docs, id_col, text_col).join(listed, ["rank", "tie"], "left")
    schema = "doc_id long, n_words long, n_removed long, text string"
    return rows.select("doc_id", "text", "spans").mapInArrow(_remover, schema)
