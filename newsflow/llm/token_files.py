"""Token ids in ORC files, in order of document id, and their reading.

Ids are stored as a list column, which ORC keeps as run-length encoded integers; every file has row
indexes and a Bloom filter on the document id, so a look-up skips files, stripes and row groups.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsflow.llm.word_ids import WordMemory, as_lists, joined, joined_coded

END_ID = 0
# Bytes of a stripe, rows of an index entry.
STRIPE, STRIDE = 16 << 20, 1000
FILE_COLUMNS = "doc_id long, part int, place long, n_tokens long, ids array<int>"


# Rules under which words are encoded on their own: no normalising, and words that take the one
# space before them along.
SEPARABLE = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
# The rules start a word at every space before a character that is no white space, wherever white
# space begins, at a mark (but the apostrophe) after a letter or digit, and after a lone line feed.
# Bytes that are surely no white space: all signs of ASCII, and those that begin a character of no
# block with white space in it.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
SIGN = np.zeros(256, dtype=bool)
SIGN[0x21:0x7F] = True
PLAIN = np.array([chr(b).isalnum() and b < 0x7F for b in range(256)])
MARK = SIGN & ~PLAIN
MARK[ord("'")] = False
SOLID = SIGN.copy()
SOLID[[*range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True
# A character that stands between words encoded together, and its sign in the vocabulary.
BETWEEN, BETWEEN_SIGN = "\0", "Ā"
# Words that a worker keeps before it forgets those not met again, new words encoded together, and
# bytes of text that are cut up at a time.
REMEMBERED, TOGETHER, RUN = 1 << 19, 1000, 6 << 20


def _signs() -> dict[int, int]:
    """The sign of every byte in byte-level vocabularies: printable ones stand for themselves, the
    rest for the characters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


SIGNS = _signs()


class Encoder:
    """Ids of texts, as little-endian 32-bit integers.

    Where the tokenizer's rules separate words, a text is cut at white space, on the bytes of the
    Arrow buffer: there the words on both sides never join. A text that holds the string of an added
    token is encoded whole, as the library gives it the token's id. Words not met lately are encoded
    in one call, the rest is looked up. Under other rules whole texts are encoded.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        words, pieces = rules.get("pre_tokenizer") or {}, self.tokenizer.get_vocab()
        # Added tokens are found in whole texts, before any cutting.
        added = [x["content"] for x in rules.get("added_tokens") or () if x["content"]]
        self.added = [x.encode() for x in added]
        self.between = pieces.get(BETWEEN_SIGN)
        self.separable = (
            not rules.get("normalizer")
            and all(words.get(k) == v for k, v in SEPARABLE.items())
            and [p for p in pieces if BETWEEN_SIGN in p] == [BETWEEN_SIGN]
        )
        if self.separable:
            # The same merges over words that are already cut, in signs for bytes.
            cut = {"type": "Split", "pattern": {"String": BETWEEN_SIGN}, "behavior": "Isolated",
                   "invert": False}
            rules |= {"pre_tokenizer": cut, "added_tokens": [], "decoder": None}
            self.merger = Tokenizer.from_str(json.dumps(rules))
        self.memory = WordMemory(REMEMBERED)

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<i4").tobytes() for x in found]

    def _holds_added(self, text: bytes) -> bool:
        return any(x in text for x in self.added)

    def _between(self, words: list[str], encoded) -> dict[str, bytes]:
        """Ids of words that were encoded as one text, cut at the ids between them."""
        ids = np.array(encoded.ids, dtype="<i4")
        cuts = np.flatnonzero(ids == self.between).tolist()
        data = ids.tobytes()
        starts, ends = [0, *(4 * c + 4 for c in cuts)], [*(4 * c for c in cuts), len(data)]
        return {w: data[a:b] for w, a, b in zip(words, starts, ends, strict=True)}

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words. Words of letters alone are one word to the tokenizer's rules as well and
        only need merging; others go through all its rules, alone where a word after them would
        change them."""
        letters = [w for w in words if w.lstrip(" ").isalpha()]
        others = list(set(words).difference(letters))
        odd = [w for w in others if not w or BETWEEN in w or w[0] == "'" or w[-1].isspace() and w != "\n"
               or self._holds_added(w.encode())]
        plain = list(set(others).difference(odd))
        out = dict(zip(odd, self.whole(odd)))
        # In short texts: the library takes longer per word in a long one.
        for k in range(0, len(letters), TOGETHER):
            some = letters[k : k + TOGETHER]
            signs = BETWEEN.join(some).encode().decode("latin-1").translate(SIGNS)
            out |= self._between(some, self.merger.encode_batch_fast([signs])[0])
        if plain:
            joint = self.tokenizer.encode_batch_fast([BETWEEN.join(plain)], add_special_tokens=False)
            out |= self._between(plain, joint[0])
        return out

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, an empty one after each text's, and their number per text."""
        ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
        data = texts.buffers()[2] or pa.py_buffer(b"")
        first, last = int(ends[0]), int(ends[-1])
        byte = np.frombuffer(data, np.uint8, last)[first:]
        starts, ends = ends[:-1] - first, ends[1:] - first
        cuts = np.zeros(len(byte), dtype=bool)
        if len(byte):
            white = WHITE[byte]
            cuts[:-1] = (byte[:-1] == 0x20) & SOLID[byte[1:]]
            cuts[1:] |= white[1:] & SIGN[byte[:-1]] | MARK[byte[1:]] & PLAIN[byte[:-1]]
            lone = (byte[1:-1] == 0x0A) & SIGN[byte[:-2]]
            cuts[2:] |= lone & PLAIN[byte[2:]]
            cuts[starts[starts < len(byte)]] = False
            if self._holds_added(joined_text := byte.tobytes()):
                for a, b in zip(starts.tolist(), ends.tolist()):
                    if self._holds_added(joined_text[a:b]):
                        cuts[a:b] = False
        at = np.flatnonzero(cuts)
        filled = ends > starts
        edges = np.sort(np.concatenate((starts[filled], at, ends, ends[-1:])), kind="stable")
        words = pa.Array.from_buffers(
            pa.string(), len(edges) - 1, [None, pa.py_buffer((edges + first).astype(np.int32)), data]
        )
        inside = np.searchsorted(at, ends) - np.searchsorted(at, starts)
        return words, inside + filled + 1

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and their number per text."""
        end = np.array([END_ID], dtype="<i4").tobytes()
        if not self.separable:
            return joined(
                [[t] for t in texts.to_pylist()], lambda some: [x + end for x in self.whole(some)]
            )
        # The end id stands for an empty word, of which a text has none.
        words, counts = self._cut(texts)
        return joined_coded(words, counts, lambda w: [x or end for x in self.memory.ids(w, self._words)])


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Places of runs of texts of about ``RUN`` bytes; a longer text is a run of its own."""
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset))
    at, size = 0, 0
    for k, more in enumerate(sizes.tolist()):
        if k > at and size + more > RUN:
            yield at, k
            at, size = k, 0
        size += more
    if at < len(texts):
        yield at, len(texts)


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _encoded(path: str):
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for frame in frames:
            texts = pc.fill_null(frame.column("text"), "")
            for at, end in _runs(texts):
                ids = as_lists([encoder.encode(texts.slice(at, end - at))])
                keys = frame.column("doc_id").slice(at, end - at)
                yield pa.RecordBatch.from_arrays([keys, ids], ["doc_id", "ids"])

    return batches


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text, append the end id and write ORC files in ascending id order.

    NULL texts count as empty: their list holds the end id alone. A NULL id comes first. Rows of
    one id are in the order of their texts' hashes; repeated rows are written as often as they are.
    An empty table writes a table without rows. ``files`` is the number of files (by default the
    number of shuffle partitions). Other columns are not looked at.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    keys = ["doc_id", "tie"]
    dealt = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    ids = (
        dealt.sortWithinPartitions(*keys)
        .select("doc_id", "text")
        .mapInArrow(_encoded(tokenizer_path), "doc_id long, ids array<int>")
    )
    stored = ids.select(
        "doc_id",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
    )
    stored.write.options(
        **{
            "compression": "zstd",
            "orc.stripe.size": STRIPE,
            "orc.row.index.stride": STRIDE,
            "orc.create.index": "true",
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": "0.01",
        }
    ).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files as a table: doc_id, part, place (ascending in file order), n_tokens, ids."""
    return spark.read.schema(FILE_COLUMNS).orc(path)


def _checked(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        lists = frame.column("ids")
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        columns = [frame.column(c) for c in ("doc_id", "part", "place", "n_tokens")]
        names = ["doc_id", "part", "place", "n_tokens", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), n_tokens and ids_crc32.

    Sums per file, one row each, are added up first; within a file the sums run on their own.
    """
    table = read_token_files(spark, path)
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    rows = table.mapInArrow(
        _checked, "doc_id long, part int, place long, n_tokens long, ids_crc32 long"
    )
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return rows.join(offsets, "part").select(
        "doc_id", start.alias("start"), "n_tokens", "ids_crc32"
    )
