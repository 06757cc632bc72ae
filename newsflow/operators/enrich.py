"""From raw articles to processed articles: cleaning, keywords, length and sentiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import keywords as K
from newsflow.functions import sentiment as S
from newsflow.functions import text as X
from newsflow.operators.sentiment import Marks, score_with_marks
from newsflow.operators.stopwords import StopWords, add_keywords
from newsflow.schemas import PROCESSED


def _cleaned(df: DataFrame) -> DataFrame:
    """Add ``title_clean`` and ``full_text`` to raw articles."""
    # The three fields are cleaned in one pass over the rows.
    cleaned = {f"_{c}": X.clean(F.col(c)) for c in ("title", "summary", "content")}
    joined = df.withColumns(cleaned).withColumn(
        "full_text", X.join_text(*(F.col(c) for c in cleaned))
    )
    return joined.withColumn("title_clean", F.col("_title")).drop(*cleaned)


def _described(df: DataFrame, top_n: int, stop_words: StopWords | None) -> DataFrame:
    """Add ``keywords`` and ``text_length`` of ``full_text``."""
    if stop_words is None:
        keywords = K.extract_keywords(F.col("full_text"), top_n)
        return df.withColumns({"keywords": keywords, "text_length": F.length("full_text")})
    measured = df.withColumn("text_length", F.length("full_text"))
    return add_keywords(measured, stop_words, "full_text", top_n)


def enrich_text(
    df: DataFrame, top_n: int = K.TOP_N, stop_words: StopWords | None = None
) -> DataFrame:
    """Add ``title_clean``, ``full_text``, ``keywords`` and ``text_length`` to raw articles.

    ``stop_words`` (see ``prepare_stop_words``) stand in place of the fixed ones.
    """
    return _described(_cleaned(df), top_n, stop_words)


def process_articles(
    df: DataFrame,
    marks: DataFrame | Marks,
    rules: S.Rules = S.Rules(),
    processed_at: Column | None = None,
    lookup: str = "auto",
    stop_words: StopWords | None = None,
) -> DataFrame:
    """Raw articles to the stored schema, scored against marks (see ``prepare_marks``).

    The work is row-local (while the marks are small), so articles are never shuffled
    (while the stop words are few as well).
    """
    # The look-up may store its rows. Described after it, they are not stored with what nobody reads.
    scored = score_with_marks(_cleaned(df), marks, rules, lookup=lookup)
    described = _described(scored, K.TOP_N, stop_words)
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return described.withColumn("processed_at", stamp).select(*PROCESSED.fieldNames())
