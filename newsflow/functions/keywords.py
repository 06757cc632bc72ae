"""Keyword extraction inside the row: an article's words never leave its own record.

Counting is done on a sorted word array instead of exploding, so no shuffle, no row key and no join
back to the (wide) article is needed, and the same expression runs in a stream.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.bind import let
from newsflow.functions.text import WORD, or_empty

# The stop words. Those under three letters can never match a keyword.
STOP_WORDS = """
the a an and or but in on at to for of with by from as is was are been be have has had do does did
will would should could may might can this that these those i you he she it we they what which who
when where why how all each every both few more most other some such
""".split()
TOP_N = 10

_SHIFT = 1 << 32


_WHOLE_WORD = f"(?:^|[^{WORD}])([a-z]{{3,}}+)(?![{WORD}])"


def tokenize(text: Column) -> Column:
    """Lower-cased words of three or more ASCII letters that are whole runs of word characters."""
    return F.regexp_extract_all(F.lower(or_empty(text)), F.lit(_WHOLE_WORD), F.lit(1))


def drop_stop_words(words: Column, stop_words: Collection[str] = STOP_WORDS) -> Column:
    if not stop_words:
        return words
    listed = sorted(set(stop_words))
    return F.filter(words, lambda word: ~word.isin(listed))


def _distinct_runs(words: Column, body) -> Column:
    """Sort words with their positions and find where each distinct word starts."""

    def starts(ordered: Column) -> Column:
        changes = F.filter(
            F.transform(ordered, lambda _, i: i),
            lambda i: ~F.get(ordered, i - 1)["word"].eqNullSafe(F.get(ordered, i)["word"]),
        )
        return let(changes, lambda at: body(ordered, at))

    paired = F.transform(words, lambda word, i: F.struct(word.alias("word"), i.alias("pos")))
    return let(F.sort_array(paired), starts)


def term_frequency(words: Column) -> Column:
    """``array<struct<word, n, first_pos>>``, one entry per distinct word."""

    def counted(ordered: Column, at: Column) -> Column:
        return F.transform(
            at,
            lambda start, j: F.struct(
                F.get(ordered, start)["word"].alias("word"),
                (F.coalesce(F.get(at, j + 1), F.size(ordered)) - start).alias("n"),
                F.get(ordered, start)["pos"].alias("first_pos"),
            ),
        )

    return _distinct_runs(words, counted)


def top_terms(words: Column, top_n: int = TOP_N) -> Column:
    """The ``top_n`` most frequent words, best first; of equals, the one seen first."""

    def ranked(words: Column) -> Column:
        # Count and first position are packed into one number, so ranking sorts plain longs.
        def packed(ordered: Column, at: Column) -> Column:
            return F.transform(
                at,
                lambda start, j: (
                    (start - F.coalesce(F.get(at, j + 1), F.size(ordered))).cast("bigint")
                    * F.lit(_SHIFT)
                    + F.get(ordered, start)["pos"]
                ),
            )

        best = F.slice(F.sort_array(_distinct_runs(words, packed)), 1, top_n)
        return F.transform(best, lambda key: F.get(words, F.pmod(key, F.lit(_SHIFT)).cast("int")))

    return let(words, ranked)


def extract_keywords(
    text: Column, top_n: int = TOP_N, stop_words: Collection[str] = STOP_WORDS
) -> Column:
    """Comma-joined top terms of a text, ``''`` when it has none."""
    return F.array_join(top_terms(drop_stop_words(tokenize(text), stop_words), top_n), ",")
