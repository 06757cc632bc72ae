"""Near copies by SimHash fingerprints, linked by a self-join of their binary trie.

Equal fingerprints are one class. Two classes link when their fingerprints differ in at most
``bits`` bits. The 64 bits are cut into blocks; of any two linked fingerprints some choice of blocks
agrees in full, so fingerprints are dealt out by every such choice and only meet within a group.
In a group the binary trie is joined with itself: pairs of nodes descend together, add up the bits
in which they differ and are dropped when the error budget is exceeded. Each group returns no more
than a spanning forest of its links, and components are found on these.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.components import components
from newsflow.operators.scratch import written

SEED = 42
# Rows of a group that meet in one piece, rows searched at a time, node pairs held at a time.
PIECE, BATCH, PAIRS = 1024, 32768, 1 << 19


def fingerprint_of(text: str | None, words: int) -> int:
    """Signed 64-bit fingerprint: bits set in over half of the hashes of all word shingles."""
    found = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(itertools.accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    spans = zip(starts, ends[words - 1 :]) if len(found) > words else [(0, ends[-1])]
    digests = (xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in spans)
    total, ones = 0, np.zeros(64, dtype=np.int64)
    while len(part := np.fromiter(itertools.islice(digests, 1 << 15), dtype=">u8")):
        total += len(part)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int = 4) -> Column:
    """Fingerprint of the whole text as a long. NULL and blank texts have fingerprint zero."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return prints(text)


def _expanded(a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """All places (i, j) with i in a0..a1 and j in b0..b1, for arrays of such ranges."""
    width = b1 - b0
    sizes = (a1 - a0) * width
    pair = np.repeat(np.arange(len(sizes)), sizes)
    k = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return a0[pair] + k // width[pair], b0[pair] + k % width[pair]


def trie_links(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of values of one range that differ in at most ``bits`` bits.

    ``values`` are unsigned and ascending within each range ``starts[k]..ends[k]``, so every trie
    node is a range. The frontier of node pairs goes down bit by bit; a large one is halved and its
    halves are finished one after the other, so memory stays bounded.
    """
    one = np.uint64(1)
    stack = [(63, starts, ends, starts, ends, np.zeros(len(starts), dtype=np.int8))]
    while stack:
        bit, a0, a1, b0, b1, errors = stack.pop()
        small = (a1 - a0) * (b1 - b0) <= 64
        if bit < 0:
            small[:] = True
        if small.any():
            i, j = _expanded(a0[small], a1[small], b0[small], b1[small])
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= bits)
            yield i[near], j[near]
        rest = [x[~small] for x in (a0, a1, b0, b1, errors)]
        if len(rest[0]) > PAIRS:
            half = len(rest[0]) // 2
            stack.append((bit, *(x[half:] for x in rest)))
            rest = [x[:half] for x in rest]
        a0, a1, b0, b1, errors = rest
        if not len(a0):
            continue
        zeros = np.concatenate(([0], np.cumsum(((values >> np.uint64(bit)) & one) == 0)))
        a, b = a0 + zeros[a1] - zeros[a0], b0 + zeros[b1] - zeros[b0]
        other = a0 != b0
        none = np.zeros(len(a0), dtype=bool)
        children = (
            (a0, a, b0, b, errors, ~none), (a, a1, b, b1, errors, ~none),
            (a0, a, b, b1, errors + 1, ~none), (a, a1, b0, b, errors + 1, other),
        )
        joined = [np.concatenate(x) for x in zip(*children)]
        low, high, low2, high2, errors, wanted = joined
        alive = wanted & (high > low) & (high2 > low2) & (errors <= bits)
        alive &= ~((low == low2) & (high - low == 1))
        stack.append((bit - 1, *(x[alive] for x in (low, high, low2, high2, errors))))


def _merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked places one label, the least of their component."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        least = np.minimum(a, b)
        np.minimum.at(labels, a, least)
        np.minimum.at(labels, b, least)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _forest(group: np.ndarray, values: np.ndarray, bits: int) -> pd.DataFrame:
    """Links that connect what is linked within each group: value and least place's value."""
    order = np.lexsort((values, group))
    group, values = group[order], values[order]
    cuts = np.flatnonzero(np.diff(group)) + 1
    starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(group)]))
    many = ends - starts > 1
    labels = np.arange(len(values))
    for i, j in trie_links(values, starts[many], ends[many], bits):
        _merge(labels, i, j)
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    signed = values.view(np.int64)
    return pd.DataFrame({"u": signed[linked], "v": signed[labels[linked]]})


def _search(bits: int):
    columns = ["choice", "key", "low", "high"]

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole groups at a time; a group that a batch cuts waits for its rest."""
        held: list[pd.DataFrame] = []
        for frame in itertools.chain(frames, [None]):
            if frame is not None and len(frame):
                held.append(frame)
            if not held or frame is not None and sum(map(len, held)) < BATCH:
                continue
            rows = pd.concat(held, ignore_index=True)
            keys = rows[columns].to_numpy()
            changes = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
            whole = len(rows) if frame is None else np.flatnonzero(changes)[-1]
            held = [rows[whole:]] if whole < len(rows) else []
            if whole:
                group, values = np.cumsum(changes)[:whole], rows["print"].to_numpy()[:whole]
                yield _forest(group, values.view(np.uint64), bits)

    return pieces


def block_choices(bits: int, classes: int) -> list[int]:
    """Masks of the block choices of which one agrees wherever at most ``bits`` bits differ.

    With one block more than errors, one block agrees; with two more, two do, and so on. More agreeing
    blocks make longer keys and so smaller groups; as many are asked for as keep the average group
    of ``classes`` fingerprints within a piece. Every count gives the same links.
    """
    for agreeing in range(1, 5):
        blocks = bits + agreeing
        if classes >> (64 * agreeing // blocks) <= PIECE:
            break
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [sum(choice) for choice in itertools.combinations(masks, agreeing)]


def linked_classes(classes: DataFrame, bits: int) -> DataFrame:
    """Links ``u``, ``v`` between fingerprints (column ``print``, distinct) that connect the same
    fingerprints as all pairs that differ in at most ``bits`` bits."""
    masks = block_choices(bits, classes.count())
    value = F.col("print")
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = F.array(
        *[
            F.struct(F.lit(k).alias("choice"), value.bitwiseAND(F.lit(m)).alias("key"))
            for k, m in enumerate(signed)
        ]
    )
    rows = classes.select("print", F.inline(dealt))
    sizes = rows.groupBy("choice", "key").count().where(F.col("count") > PIECE)
    large = written(
        sizes.select("choice", "key", F.ceil(F.col("count") / PIECE).cast("int").alias("pieces")),
        "large",
    )
    # A large group is cut into pieces and every two pieces meet in a group of their own.
    rows = rows.join(large, ["choice", "key"], "left")
    own = F.pmod(F.xxhash64("print"), F.coalesce("pieces", F.lit(1))).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))
    rows = rows.select("choice", "key", "print", own.alias("own"), met.alias("met"))
    keys = ["choice", "key", "low", "high"]
    rows = rows.select(
        "choice", "key", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"),
        "print",
    )
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInPandas(_search(bits), "u long, v long").distinct()


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    bits: int = 4,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id.

    ``component_id`` is the smallest id that is reachable over links. NULL, empty and blank texts
    have fingerprint zero, linked like any other; a text of fewer words is one shingle. Rows with
    equal texts, repeated rows among them, share a class. A NULL id is never the smallest; a
    component of such rows alone has a NULL id. Other columns are not looked at. An empty table
    gives an empty table.
    """
    prints = written(
        docs.select(
            F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), words).alias("print")
        ),
        "prints",
    )
    classes = written(prints.groupBy("print").agg(F.min("doc_id").alias("least_id")), "classes")
    stars = components(linked_classes(classes.select("print"), bits))
    rooted = classes.join(stars, classes["print"] == stars["u"], "left").select(
        "print", "least_id", F.coalesce("v", "print").alias("root")
    )
    roots = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labelled = rooted.join(roots, "root").select("print", "component_id")
    return prints.join(labelled, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = 4
) -> DataFrame:
    """The rows of ``docs``, all columns, whose id is the smallest of its component.

    Rows repeated with that id all stay (an exact-copy step comes before), and so do rows without
    an id.
    """
    groups = near_groups(docs, id_col, text_col, words, bits)
    away = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    away = written(away.distinct(), "near")
    keyed = docs.select(F.struct("*").alias("whole"), F.col(id_col).alias("key_id"))
    kept = keyed.join(away, F.col("key_id") == F.col("doc_id"), "left_anti")
    return kept.select("whole.*")
