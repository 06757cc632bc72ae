"""Collocations per language, by vertical partitioning of a suffix tree cut off at three words.

The suffixes of all pieces, cut off after three words, form a tree whose leaf totals give the count
of every phrase. The tree is built in independent subtrees: prefixes of one word, or of two or three
where shorter ones occur more often than the budget of a group, are grouped so that a group's
suffixes fit its memory. A group's sorted suffixes are its subtree; the totals of its leaves, added
up along common prefixes, are the counts. Equal suffixes of a block of documents travel as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm import word_blocks as B
from newsflow.operators.scratch import written

ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BETWEEN, END = B.byte_table(b" \t" + ENDS), B.byte_table(ENDS)
LINES = B.byte_table(b" \n")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
DEPTH = 3
# Suffixes in a group, and the pieces in which a group is sorted.
BUDGET, PIECES = 1 << 20, 16
# The share of all words that a prefix may have is one in so many, or in four times the number of
# groups where that is more, but no smaller than the second: fewer prefixes of one length than that
# are extended by a word.
SHARES, EXTENDED = 512, 1 << 17
# Parts in which the first phrases of a language are chosen, step by step.
SALTS = (64, 4, 1)
UNKNOWN = "und"
SUFFIXES = "part int, lang string, counts array<int>, lines array<int>, bytes array<int>, suffixes binary"
PHRASES = "lang string, w1 string, w2 string, w3 string, a long"


class Block:
    """Words of a block of documents, their languages and how far their pieces go on."""

    def __init__(self, rows: list[dict]) -> None:
        texts = [r["text"].translate(LOWER) for r in rows]
        self.words, starts = B.words_of(texts, BETWEEN)
        self.codes, self.distinct = self.words.coded()
        self.langs = sorted({r["lang"] for r in rows})
        number = {name: k for k, name in enumerate(self.langs)}
        self.lang = np.array([number[r["lang"]] for r in rows], np.int64)[self.words.text]
        # Words of one piece have as many ends before them; texts are joined by one.
        ends = np.cumsum(END[np.frombuffer(b"\n".join(texts), np.uint8)])
        piece = ends[starts] if len(starts) else starts
        n = len(piece)
        self.depth = np.ones(n, dtype=np.int64)
        for k in range(1, min(DEPTH, n)):
            self.depth[: n - k] += piece[k:] == piece[:-k]

    def after(self, k: int) -> np.ndarray:
        """One more than the code of the word ``k`` places on, 0 beyond the piece."""
        out = np.zeros(len(self.codes), dtype=np.int64)
        there = np.flatnonzero(self.depth > k)
        out[there] = self.codes[there + k] + 1
        return out

    def distinct_suffixes(self, depth: int, among=None) -> tuple[np.ndarray, np.ndarray]:
        """A place of every distinct suffix of a language, cut off at ``depth``, and its count.

        Sorted by language and words' codes; ``among`` names the places that are looked at."""
        places = np.arange(len(self.codes)) if among is None else among
        key, base = self.lang[places], len(self.distinct) + 1
        top = len(self.langs)
        for k in range(depth):
            if top * base >= 1 << 62:  # too many combinations to number without looking
                key = np.unique(key, return_inverse=True)[1]
                top = len(places)
            key, top = key * base + self.after(k)[places], top * base
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        return places[first], counts


def _counter(depth: int, extended: pa.Table | None):
    """Rows lang, w1.. and n per distinct prefix and block: all words, or pairs of given words."""
    names = ["lang", *(f"w{k + 1}" for k in range(depth)), "n"]

    def counts(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in B.blocks(frames):
            block = Block(rows)
            among = None
            if extended is not None:
                among = np.flatnonzero((block.depth >= depth) & _flags(block, extended, 1))
            places, n = block.distinct_suffixes(depth, among)
            words = [block.distinct.take(block.codes[places + k]).cast(pa.string()) for k in range(depth)]
            langs = pa.array(block.langs, pa.string()).take(pa.array(block.lang[places]))
            yield pa.RecordBatch.from_arrays([langs, *words, pa.array(n)], names)

    return counts


def _flags(block: Block, extended: pa.Table, length: int) -> np.ndarray:
    """Which places begin with one of the prefixes that are extended."""
    if not len(extended) or not len(block.codes):
        return np.zeros(len(block.codes), dtype=bool)
    names = ["lang", *(f"w{k + 1}" for k in range(length))]
    # Prefixes of the block, then those extended, numbered together.
    number = {w: k + 1 for k, w in enumerate(block.distinct.to_pylist())}
    langs = {name: k for k, name in enumerate(block.langs)}
    base = len(block.distinct) + 1
    wanted = []
    for lang, *words in zip(*(extended[c].to_pylist() for c in names)):
        codes = [number.get(w.encode(), 0) for w in words]
        if lang in langs and all(codes):
            wanted.append((langs[lang], *codes))
    if not wanted:
        return np.zeros(len(block.codes), dtype=bool)
    wanted = np.array(wanted, np.int64)
    key, mine = wanted[:, 0], block.lang
    for k in range(length):
        key, mine = key * base + wanted[:, k + 1], mine * base + block.after(k)
    return np.isin(mine, key)


def _suffixes(parts: int, words: pa.Table, pairs: pa.Table):
    """Distinct suffixes of every block, dealt to groups by their prefix."""

    def deal(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for rows in B.blocks(frames):
            block = Block(rows)
            if not len(block.codes):
                continue
            places, counts = block.distinct_suffixes(DEPTH)
            hashes = np.concatenate(([0], B.hashed(block.distinct))).astype(np.uint64)
            langs = np.array([xxhash.xxh64_intdigest(x.encode()) for x in block.langs], np.uint64)
            key = langs[block.lang] + hashes[block.after(0)]
            two, three = _flags(block, words, 1), _flags(block, pairs, 2)
            for k, longer in ((1, two), (2, three)):
                more = B.mixed(key + np.uint64(k)) + hashes[block.after(k)]
                key = np.where(longer, more, key)
            key = B.mixed(key[places])
            part = ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            piece = key % np.uint64(PIECES)
            lang = block.lang[places]
            order = np.lexsort((piece, lang, part))
            data, at = block.words.spaced()
            out = []
            for some in np.split(order, B.run_starts(part[order], lang[order])[1:]):
                first = places[some]
                lines = B.pieces_of(data, at[first], at[first + block.depth[first]] - 1)
                cuts = np.searchsorted(piece[some], np.arange(PIECES + 1))
                ends = np.concatenate(([0], np.cumsum([len(x) + 1 for x in lines])))[cuts]
                out.append((int(part[some[0]]), block.langs[lang[some[0]]], counts[some], np.diff(cuts),
                            np.diff(ends), squeeze(b"\n".join(lines) + b"\n")))
            kinds = [pa.int32(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.binary()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SUFFIXES.split(", ")])

    return deal


def subtree(texts: list[bytes], counts: np.ndarray, least: int) -> Iterator[tuple[list[pa.Array], np.ndarray]]:
    """Phrases of two, then of three words with ``least`` or more occurrences among suffixes.

    ``texts`` hold one suffix a line and ``counts`` how often each occurs.
    """
    words, starts = B.words_of([b"".join(texts)], LINES)
    codes, distinct = words.coded()
    line = np.cumsum(np.frombuffer(b"".join(texts), np.uint8) == 0x0A)[starts]
    first = np.searchsorted(line, np.arange(len(counts)))
    depth = np.diff(first, append=len(words))
    levels = []
    for k in range(DEPTH):
        codes_at = np.full(len(counts), -1, dtype=np.int64)
        there = np.flatnonzero(depth > k)
        codes_at[there] = codes[first[there] + k]
        levels.append(codes_at)
    order = np.lexsort(levels[::-1])
    levels, counts = [x[order] for x in levels], counts[order]
    for length in range(2, DEPTH + 1):
        nodes = B.run_starts(*levels[:length])
        totals = np.add.reduceat(counts, nodes)
        found = (totals >= least) & (levels[length - 1][nodes] >= 0)
        yield [distinct.take(pa.array(x[nodes][found])) for x in levels[:length]], totals[found]


def _grower(least: int):
    """Subtrees of the groups of one task, group by group."""

    def grown(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        read = zstandard.ZstdDecompressor().decompress
        pieces: dict[tuple[str, int], list] = {}
        for row in rows:
            data, counts, at, begin = read(row["suffixes"]), row["counts"].astype(np.int64), 0, 0
            for k, (n, size) in enumerate(zip(row["lines"].tolist(), row["bytes"].tolist())):
                if n:
                    mine = pieces.setdefault((row["lang"], k), [])
                    mine.append((data[begin : begin + size], counts[at : at + n]))
                at, begin = at + n, begin + size
        for (lang, _), piece in pieces.items():
            texts, counts = zip(*piece)
            for words, totals in subtree(list(texts), np.concatenate(counts), least):
                words = [w.cast(pa.string()) for w in words]
                words += [pa.nulls(len(totals), pa.string())] * (DEPTH - len(words))
                langs = pa.array([lang] * len(totals), pa.string())
                names = ["lang", *(f"w{k + 1}" for k in range(DEPTH)), "a"]
                yield pa.RecordBatch.from_arrays([langs, *words, pa.array(totals)], names)

    def grow(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in B.by_part(frames):
            yield from grown(rows)

    return grow


def _longer(counted: DataFrame, columns: list[str], bound: int) -> pa.Table:
    """Prefixes that occur more often than ``bound``: at most ``EXTENDED`` by the bound's choice."""
    return counted.where(F.col("n") > bound).select(*columns).toArrow()


def phrase_counts(
    docs: DataFrame, least: int = 10, lang_col: str = "lang", text_col: str = "text",
    budget: int = BUDGET,
) -> tuple[DataFrame, DataFrame]:
    """Words (lang, w1, n) and phrases of two and three words (lang, w1, w2, w3, a), the latter with
    ``least`` or more occurrences."""
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    found = rows.mapInArrow(_counter(1, None), "lang string, w1 string, n long")
    words = written(found.groupBy("lang", "w1").agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    setting = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(setting, ceil(total / budget))
    bound = total // min(EXTENDED, max(SHARES, 4 * parts))
    extended = _longer(words, ["lang", "w1"], bound)
    found = rows.mapInArrow(_counter(2, extended), "lang string, w1 string, w2 string, n long")
    counted = found.groupBy("lang", "w1", "w2").agg(F.sum("n").alias("n"))
    frequent = written(counted.where(F.col("n") > bound), "pairs")
    pairs = _longer(frequent, ["lang", "w1", "w2"], bound)
    dealt = rows.mapInArrow(_suffixes(parts, extended, pairs), SUFFIXES)
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
    phrases = dealt.mapInArrow(_grower(least), PHRASES)
    # The suffixes of an extended pair lie in several groups: its count is the one already taken.
    keys = ["lang", "w1", "w2"]
    split = F.broadcast(frequent.select(*keys, F.lit(True).alias("split")))
    rest = phrases.join(split, keys, "left").where("split IS NULL OR w3 IS NOT NULL").drop("split")
    whole = frequent.where(F.col("n") >= least)
    whole = whole.select(*keys, F.lit(None).cast("string").alias("w3"), F.col("n").alias("a"))
    return words, written(rest.unionByName(whole), "phrases")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: up to 38 digits, then a whole division."""

    def number(x: Column | int) -> Column:
        return (F.lit(x) if isinstance(x, int) else x).cast("decimal(19,0)")

    above = (number(a) * number(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", above, number(left) * number(right))


def collocations(
    docs: DataFrame, least: int = 10, top: int = 2000, contained: int = 50,
    lang_col: str = "lang", text_col: str = "text", budget: int = BUDGET,
) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut into pieces at sentence marks and line ends, pieces into
    words at spaces and tabs. A phrase is two or three words with ``least`` or more occurrences
    ``a`` within pieces. ``l`` and ``r`` are the counts of its two parts at the cut with the lowest
    score floor(1000000 a a / (l r)), ties to the first cut; ``n`` counts the words of the language.
    A phrase inside a longer one that makes up ``contained`` percent of its occurrences is left out.
    Ranks are by score, then ``a``, both falling, then the phrase's bytes. A NULL language is
    ``und``; NULL and empty texts have no words; repeated rows count as often as they are; very long
    texts are blocks of their own. An empty table gives an empty table; other columns are not looked
    at.
    """
    words, phrases = phrase_counts(docs, least, lang_col, text_col, budget)
    known = words.where(F.col("n") >= least)
    pairs = phrases.where("w3 IS NULL").select("lang", "w1", "w2", "a")
    for name, word in (("l", "w1"), ("r", "w2")):
        counts = known.select("lang", F.col("w1").alias(word), F.col("n").alias(name))
        pairs = pairs.join(counts, ["lang", word])
    pairs = written(pairs.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"))), "scored")

    triples = phrases.where("w3 IS NOT NULL")
    head = pairs.select("lang", "w1", "w2", F.col("l").alias("l1"), F.col("a").alias("l2"))
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"),
                        F.col("a").alias("r1"), F.col("r").alias("r2"))
    triples = triples.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
    cuts = [
        F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                 F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        for k in (1, 2)
    ]
    triples = written(triples.withColumn("cut", F.least(*cuts)), "scored")

    inside = triples.select(
        "lang",
        F.inline(
            F.array(
                F.struct(F.col("w1"), F.col("w2"), (F.col("a") * 100 >= F.col("l2") * contained).alias("drop")),
                F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"),
                         (F.col("a") * 100 >= F.col("r1") * contained).alias("drop")),
            )
        ),
    ).where("drop")
    pairs = pairs.join(inside.select("lang", "w1", "w2").distinct(), ["lang", "w1", "w2"], "left_anti")
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    listed = pairs.withColumn("phrase", F.concat_ws(" ", "w1", "w2")).select(*columns).unionByName(
        triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "cut.l", "cut.r",
                       "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for salts in SALTS:
        salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
        # Of a language's parts, the first rows of each are all that the next step needs.
        best = Window.partitionBy("lang", "salt").orderBy(*order)
        ranked = listed.withColumn("salt", salt).withColumn("rank", F.row_number().over(best))
        listed = ranked.where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return listed.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
