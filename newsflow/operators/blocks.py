"""Look-up of the words of texts in a table of any size, a block of texts at a time."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.bind import sql_bucket
from newsflow.functions.text import is_blank
from newsflow.operators.scratch import written

# Text of a block, and the maps its words are spread over; a block is one row while it is worked on.
BLOCK_BYTES = 4 * 1024 * 1024
BUCKETS = 8192


def _block_count(texts: DataFrame, block_bytes: int) -> int:
    size = texts.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("size")).first()["size"]
    return max(-(-size // block_bytes), 2 * texts.sparkSession.sparkContext.defaultParallelism)


def _block_index(found: DataFrame, blocks: int) -> DataFrame:
    """``(_block, _index)``: the found ``(_block, token, mark)`` of a block as an array of maps."""
    listed = found.select(
        "_block",
        F.expr(sql_bucket("token", BUCKETS)).alias("bucket"),
        F.struct("token", "mark").alias("entry"),
    )
    # Every bucket is there, also an empty one, so a bucket's number is its place in the array.
    numbers = found.sparkSession.range(blocks * BUCKETS).select(
        (F.col("id") / BUCKETS).cast("int").alias("_block"),
        (F.col("id") % BUCKETS).cast("int").alias("bucket"),
        F.lit(None).alias("entry"),
    )
    dealt = listed.union(numbers).repartition(blocks, "_block")
    grouped = dealt.groupBy("_block", "bucket").agg(F.collect_list("entry").alias("entries"))
    in_order = F.sort_array(F.collect_list(F.struct("bucket", "entries")))
    return grouped.groupBy("_block").agg(in_order.alias("all")).select(
        "_block", F.transform("all", lambda bucket: F.map_from_entries(bucket["entries"])).alias("_index")
    )


def _deal(df: DataFrame, text: str, block_bytes: int):
    """``df`` stored with ``_blank``; its distinct texts that are not blank, dealt into blocks as
    ``(_block, _text_key, _text)``; how many blocks; and what joins ``(_text_key, _result)`` back."""
    void = [name for name, kind in df.dtypes if kind == "void"]
    key = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    keyed = df.drop(*void).withColumns({"_text_key": key, "_blank": is_blank(F.col(text))})
    stored = written(keyed, "texts")
    filled = stored.where(~F.col("_blank")).select("_text_key", F.col(text).alias("_text"))
    blocks = _block_count(filled, block_bytes)
    # Never NULL: a check for it would set one use of the blocks apart from the other.
    block = F.coalesce(F.pmod(F.xxhash64("_text_key"), F.lit(blocks)).cast("int"), F.lit(0))
    distinct = filled.dropDuplicates(["_text_key"]).select(block.alias("_block"), "_text_key", "_text")

    def joined(results: DataFrame) -> DataFrame:
        both = stored.withColumns({name: F.lit(None) for name in void}).join(results, "_text_key", "left")
        return both.select(*df.columns, "_blank", "_result")

    return distinct.repartition(blocks, "_block"), blocks, joined


def look_up_by_blocks(
    df: DataFrame,
    text: str,
    match: Callable[[DataFrame], DataFrame],
    words: Callable[[Column], Column],
    result: Callable[[Column, Column], Column],
    **given: Column,
) -> DataFrame:
    """Add ``_blank`` and ``_result``: ``result(text, index)`` of every text that is not blank.

    ``words`` gives the words of a text, and ``match`` joins rows (_block, token) with a table of any
    size, adding ``mark``; ``index`` has what it returns as an array of ``BUCKETS`` maps (see
    ``sql_lookup``). ``given`` are columns that ``result`` needs. ``df`` is stored first, so what makes it runs once. Every distinct text is
    worked on once. Texts are dealt into blocks of about ``BLOCK_BYTES``, and the distinct words of a
    block are matched, not every word: a word is in the join once per block, however common.
    """
    texts, blocks, joined = _deal(df, text, BLOCK_BYTES)
    whole = F.struct("_text_key", "_text")
    dealt = texts.groupBy("_block").agg(F.collect_list(whole).alias("_texts"))
    spoken = F.flatten(F.transform("_texts", lambda t: words(t["_text"])))
    listed = dealt.select("_block", F.explode(F.array_distinct(spoken)).alias("token"))
    found = match(listed).select("_block", "token", "mark")
    looked = dealt.join(_block_index(found, blocks), "_block").withColumns(given)

    def worked(t: Column) -> Column:
        value = result(t["_text"], F.col("_index"))
        return F.struct(t["_text_key"].alias("_text_key"), value.alias("_result"))

    return joined(looked.select(F.inline(F.transform("_texts", worked))))


def _listing(token: Callable[[str], str]) -> Callable[[pa.Table], pa.Table]:
    """``(_block, said)``: the distinct words that the texts of a block hold."""

    def listed(texts: pa.Table) -> pa.Table:
        words = set()
        for text in texts.column("_text"):
            words.update(text.as_py().split())
        said = pa.array(list(set(map(token, words))), pa.string())
        block = texts.column("_block").combine_chunks()
        return pa.table({"_block": block.take(pa.array(np.zeros(len(said), np.int32))), "said": said})

    return listed


def _marking(token: Callable[[str], str], values: Callable | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Each text of a block with the number and values of its words, or without ``values`` with its
    words and their marks, NULL where none was found."""

    def marked(texts: pa.Table, found: pa.Table) -> pa.Table:
        place = {word: at for at, word in enumerate(found.column("said").to_pylist())}
        said, places = [], array("i")

        class Numbers(dict):
            def __missing__(self, word: str) -> int:
                said.append(token(word))
                places.append(place.get(said[-1], -1))
                self[word] = len(said) - 1
                return self[word]

        number, words, ends = Numbers().__getitem__, array("i"), array("i", [0])
        for text in texts.column("_text"):
            words.extend(map(number, text.as_py().split()))
            ends.append(len(words))
        words, ends = np.frombuffer(words, np.int32), np.frombuffer(ends, np.int32)
        at = np.frombuffer(places, np.int32)[words]
        marks = found.column("mark").combine_chunks()
        columns = {name: texts.column(name) for name in ("_text_key", "_text")}
        if values:
            worth, bounds = values(marks, at, ends)
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(worth, pa.float64()))
            return pa.table(columns | {"_size": pa.array(np.diff(ends)), "_values": listed})
        spoken = pa.array(said, pa.string()).take(pa.array(words))
        marks = marks.take(pa.array(at, mask=at < 0))
        lists = {"_tokens": spoken, "_marks": marks}
        return pa.table(columns | {n: pa.ListArray.from_arrays(pa.array(ends), c) for n, c in lists.items()})

    return marked


def look_up_tokens(
    df: DataFrame,
    text: str,
    match: Callable[[DataFrame], DataFrame],
    token: Callable[[str], str],
    result: Callable[[Column, Column, Column], Column],
    values: Callable | None = None,
    mark_type: str = "",
    **given: Column,
) -> DataFrame:
    """As :func:`look_up_by_blocks`, for words that are runs without white space.

    ``token`` gives what to look up for such a run. ``match`` joins rows (_block, said) with a table
    of any size, adding ``mark``. ``values(marks, at, ends)`` gets the marks found in a block, the
    number of the mark of each word (-1: none) and where the words of each text end, and returns
    numbers and where those of each text end; ``result(text, size, values)`` has the count of a text's
    words and its numbers. Without ``values`` it is ``result(text, tokens, marks)``, with a mark of
    ``mark_type`` or NULL for every token. Both functions go to the Python workers by value. A word
    costs a dictionary look-up, and a task holds one block at a time.
    """
    texts, _, joined = _deal(df, text, 2 * BLOCK_BYTES)
    listed = texts.groupBy("_block").applyInArrow(_listing(token), "_block int, said string")
    found = match(listed).select("_block", "said", "mark")
    last = {"_size": "int", "_values": "array<double>"}
    if values is None:
        last = {"_tokens": "array<string>", "_marks": f"array<{mark_type}>"}
    fields = {"_text_key": "binary", "_text": "string"} | last
    schema = ", ".join(f"{name} {kind}" for name, kind in fields.items())
    both = texts.groupBy("_block").cogroup(found.groupBy("_block"))
    marked = both.applyInArrow(_marking(token, values), schema).withColumns(given)
    return joined(marked.select("_text_key", result(*map(F.col, ["_text", *last])).alias("_result")))
