"""Stop words from a caller's table of any size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import keywords as K
from newsflow.functions.bind import lookup_in
from newsflow.operators.blocks import BUCKETS, look_up_by_blocks
from newsflow.operators.scratch import written

MAX_LISTED = 5_000
SALTS = 16


@dataclass(frozen=True)
class StopWords:
    """Stop words ready for use: the stored table ``(word)``, one row per word, and the words
    themselves where they are at most ``MAX_LISTED`` and so can be searched inside each row."""

    table: DataFrame
    listed: tuple[str, ...] | None


def prepare_stop_words(table: DataFrame, column: str = "word") -> StopWords:
    """Derive stop words once: they are stored in the shared folder and counted there.

    Words are lower-cased, as those of a text are before the search. NULL, and whatever no text
    word can equal (under three letters, or anything but ASCII letters), is left out, as are
    repeats. At most ``MAX_LISTED + 1`` words come to the driver.
    """
    word = F.lower(F.col(column)).alias("word")
    usable = table.select(word).where(F.col("word").rlike(r"^[a-z]{3,}\z")).distinct()
    stored = written(usable, "stop-words")
    words = tuple(sorted(r["word"] for r in stored.limit(MAX_LISTED + 1).collect()))
    return StopWords(stored, words if len(words) <= MAX_LISTED else None)


def frequent_words(df: DataFrame, percent: int, text: str = "text") -> DataFrame:
    """``(word, n)``: the words that stand in at least ``percent`` of 100 rows, with their rows.

    A row counts once per word. The result is small for any input: no more than ``100 / percent``
    times the mean number of different words of a text. NULL and empty texts count as rows.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent!r}")
    words = df.select(F.explode(F.array_distinct(K.tokenize(F.col(text)))).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rows = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return counts.where(F.col("n") * 100 >= rows * percent)


def _in_row(stop: StopWords, lookup: str) -> bool:
    if lookup not in ("auto", "row", "join"):
        raise ValueError(f"lookup must be auto, row or join, not {lookup!r}")
    if lookup == "row" and stop.listed is None:
        raise ValueError(f"over {MAX_LISTED} stop words are too many to be searched in each row")
    return stop.listed is not None and lookup != "join"


def _anti_join(tokens: DataFrame, stop: StopWords, spread: str) -> DataFrame:
    """``tokens`` whose ``word`` is no stop word; ``spread`` deals a frequent word out to tasks."""
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    repeated = stop.table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # Sent whole, the stop words would be sent once per salt.
    salted = tokens.withColumn("_salt", salt)
    return salted.join(repeated.hint("merge"), ["word", "_salt"], "left_anti").drop("_salt")


def drop_stop_rows(
    tokens: DataFrame, stop: StopWords, spread: str, lookup: str = "auto"
) -> DataFrame:
    """Rows of ``tokens`` (with a column ``word``) whose word is no stop word.

    Every remaining row stays, repeats and NULL words included. ``spread`` names a column whose
    values part the rows of one word, such as the id of their text.
    """
    if _in_row(stop, lookup):
        if not stop.listed:
            return tokens
        return tokens.where(F.col("word").isNull() | ~F.col("word").isin(*stop.listed))
    return _anti_join(tokens, stop, spread).select(*tokens.columns)


def add_keywords(
    df: DataFrame,
    stop: StopWords,
    text: str = "full_text",
    top_n: int = K.TOP_N,
    lookup: str = "auto",
) -> DataFrame:
    """Add ``keywords`` of ``text``: the same string as ``extract_keywords`` gives.

    Few stop words are searched inside each row, also in a stream, and the articles are not
    shuffled. Beyond ``MAX_LISTED`` (or with ``lookup='join'``) the distinct words of blocks of texts are
    joined with them (see ``look_up_by_blocks``) and those left are searched inside each row; a
    stream then needs ``foreachBatch``.
    """
    if _in_row(stop, lookup):
        return df.withColumn("keywords", K.extract_keywords(F.col(text), top_n, stop.listed))
    table = stop.table.select(F.col("word").alias("token"))

    def kept(listed: DataFrame) -> DataFrame:
        rest = listed.join(table.hint("merge"), "token", "left_anti")
        return rest.withColumn("mark", F.lit(True))

    def best(words: Column, index: Column) -> Column:
        found = F.filter(K.tokenize(words), lambda w: lookup_in(index, w, BUCKETS).isNotNull())
        return F.array_join(K.top_terms(found, top_n), ",")

    looked = look_up_by_blocks(df, text, kept, K.tokenize, best)
    keywords = F.coalesce("_result", F.lit(""))
    return looked.withColumn("keywords", keywords).drop("_blank", "_result")
