"""Sentiment of articles against lexicon tables of any size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions import phrases as P
from newsflow.functions import sentiment as S
from newsflow.functions.text import is_blank
from newsflow.operators.blocks import look_up_tokens
from newsflow.operators.scratch import written
from newsflow.operators.sizing import is_small


def default_boosters(spark: SparkSession) -> DataFrame:
    rows = [(w, S.STEP) for w in S.INTENSIFIERS] + [(w, -S.STEP) for w in S.DAMPENERS]
    return spark.createDataFrame(rows, schemas.BOOSTERS)


def default_negations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in S.NEGATIONS], schemas.NEGATIONS)


def default_phrases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(P.DEFAULT_PHRASES, schemas.PHRASES)


def sample_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(S.SAMPLE_LEXICON.items()), schemas.LEXICON)


def token_marks(
    lexicon: DataFrame, boosters: DataFrame | None = None, negations: DataFrame | None = None
) -> DataFrame:
    """One row per token with all the scorer knows: ``(token, valence, delta, negates)``."""
    none = F.lit(None)
    parts = lexicon.select(
        "token",
        F.col("valence").cast("double").alias("valence"),
        none.cast("double").alias("delta"),
        none.cast("boolean").alias("negates"),
    )
    if boosters is not None:
        parts = parts.unionByName(
            boosters.select(
                "token",
                none.cast("double").alias("valence"),
                F.col("delta").cast("double").alias("delta"),
                none.cast("boolean").alias("negates"),
            )
        )
    if negations is not None:
        parts = parts.unionByName(
            negations.select(
                "token",
                none.cast("double").alias("valence"),
                none.cast("double").alias("delta"),
                F.lit(True).alias("negates"),
            )
        )
    return parts.groupBy("token").agg(
        F.max("valence").alias("valence"),
        F.max("delta").alias("delta"),
        F.max("negates").alias("negates"),
    )


@dataclass(frozen=True)
class Marks:
    """Marks ready to score with: one row ``(token, mark)`` per token, whether they are few enough
    to be searched inside each row, and the automaton of the phrases, if there are any."""

    table: DataFrame
    small: bool
    automaton: P.Automaton | None = None


def one_mark_per_token(marks: DataFrame) -> DataFrame:
    """``(token, mark)`` with tokens as the scorer looks them up.

    Tokens are lower-cased, as words are before the look-up; NULL tokens are left out. Of several
    rows of one token the largest value of each column counts.
    """
    rows = marks.where(F.col("token").isNotNull()).groupBy(F.lower("token").alias("token"))
    columns = [c for c in ("valence", "delta", "negates", "part") if c in marks.columns]
    merged = rows.agg(*[F.max(c).alias(c) for c in columns])
    return merged.select("token", F.struct(*columns).alias("mark"))


def phrase_automaton(phrases: DataFrame | None) -> P.Automaton | None:
    """The automaton of a phrase table, which has ``MAX_PHRASES`` rows at most (checked)."""
    if phrases is None:
        return None
    rows = phrases.select("phrase", "kind", "value").limit(P.MAX_PHRASES + 1).collect()
    if len(rows) > P.MAX_PHRASES:
        raise ValueError(f"a phrase table may have {P.MAX_PHRASES} rows at most")
    return P.build(map(tuple, rows))


def with_phrase_words(marks: DataFrame, automaton: P.Automaton | None) -> DataFrame:
    """``marks`` and the words of the phrases with their number in the column ``part``, so that one
    look-up per word gives both."""
    if automaton is None:
        return marks
    listed = marks.sparkSession.createDataFrame(
        list(automaton.classes.items()), "token string, part int"
    )
    return marks.unionByName(listed, allowMissingColumns=True)


def prepare_marks(marks: DataFrame, phrases: DataFrame | None = None) -> Marks:
    """Derive marks once: they are stored in the shared folder and their size is checked there.

    This runs the job that makes ``marks``. Scoring with the result reads the stored rows.
    """
    automaton = phrase_automaton(phrases)
    table = written(one_mark_per_token(with_phrase_words(marks, automaton)), "marks")
    return Marks(table, is_small(table), automaton)


def phrase_steps(spark: SparkSession, automaton: P.Automaton | None) -> Column | None:
    """The steps of an automaton as one value, an array per state."""
    if automaton is None:
        return None
    rows = spark.createDataFrame(list(enumerate(automaton.steps)), "state int, row array<int>")
    ordered = rows.agg(F.sort_array(F.collect_list(F.struct("state", "row"))).alias("all"))
    return ordered.select(F.transform("all", lambda state: state["row"])).scalar()


def mark_index(marks: DataFrame) -> Column:
    """The marks of a small table as one value, searched inside the row (see ``sql_lookup``)."""
    buckets = F.lit(S.BUCKETS - 1)
    listed = marks.select(
        F.crc32(F.col("token").cast("binary")).bitwiseAND(buckets).cast("int").alias("bucket"),
        F.struct("token", "mark").alias("entry"),
    )
    # Every bucket is there, also an empty one, so a bucket's number is its place in the array.
    numbers = marks.sparkSession.range(0, S.BUCKETS, 1, 1).select(
        F.col("id").cast("int").alias("bucket"), F.lit(None).alias("entry")
    )
    grouped = listed.union(numbers).groupBy("bucket").agg(F.collect_list("entry").alias("entries"))
    in_order = grouped.agg(F.sort_array(F.collect_list(F.struct("bucket", "entries"))).alias("all"))
    return in_order.select(
        F.transform("all", lambda bucket: F.map_from_entries(bucket["entries"]))
    ).scalar()


def _phrases(df: DataFrame, marks: Marks) -> tuple[DataFrame, S.Phrases | None]:
    """``df`` with the steps of the automaton in a column, and what the scorer needs of them."""
    if marks.automaton is None:
        return df, None
    stepped = df.withColumn("_steps", phrase_steps(df.sparkSession, marks.automaton))
    return stepped, S.Phrases(marks.automaton, F.col("_steps"))


def _score_by_index(df: DataFrame, text: str, marks: Marks, rules: S.Rules) -> DataFrame:
    df = df.withColumn("_blank", is_blank(F.col(text)))
    # Used once, the subqueries are folded into the score's projection: their values are computed
    # one time per query and the rows never carry them.
    indexed, phrases = _phrases(df.withColumn("_index", mark_index(marks.table)), marks)
    score = S.score_by_index(F.col(text), F.col("_index"), rules, phrases)
    return indexed.withColumn("_score", score).drop("_index", "_steps")


def marks_said(listed: DataFrame, marks: DataFrame, rules: S.Rules) -> DataFrame:
    """``listed`` (with a column ``said``) with a ``mark`` of all the rules ask of a word, where they
    ask for it; ``marks`` (token, mark) may be of any size and are never sent whole.

    Words are lower-cased by Spark, as the marks' tokens are.
    """
    low = listed.withColumn("token", F.lower("said"))
    if not rules.context:
        worth = marks.where("mark.valence is not null").hint("merge")
        return low.join(worth, "token").withColumn("mark", F.struct("mark.valence"))
    token, said = F.col("token"), F.col("said")
    negates = F.coalesce(F.col("mark.negates"), F.lit(False))
    mark = F.struct(
        "mark.valence",
        "mark.delta",
        (negates | F.contains(token, F.lit("n't"))).alias("flips"),
        ((said != token) & (said == F.upper(said))).alias("shouts"),
        (token == "but").alias("turns"),
    )
    told = "mark.valence is not null or mark.delta is not null or mark.flips or mark.shouts or mark.turns"
    return low.join(marks.hint("merge"), "token", "left").withColumn("mark", mark).where(told)


def _score_by_join(df: DataFrame, text: str, marks: Marks, rules: S.Rules) -> DataFrame:
    """Look tokens up with a join: for lexicons too large to send to every task."""
    if marks.automaton is None or not rules.context:
        looked = look_up_tokens(
            df,
            text,
            lambda listed: marks_said(listed, marks.table, rules),
            S.token_of(),
            lambda t, size, values: S.score_by_values(t, size, values, rules),
            S.value_finder(rules),
        )
        return looked.withColumnRenamed("_result", "_score")
    phrases = S.Phrases(marks.automaton, F.col("_steps"))
    return look_up_tokens(
        df,
        text,
        lambda listed: listed.withColumn("token", F.lower("said")).join(marks.table.hint("merge"), "token"),
        S.token_of(),
        lambda t, tokens, found: S.score_by_marks(t, tokens, found, rules, phrases),
        mark_type=marks.table.schema["mark"].dataType.simpleString(),
        _steps=phrase_steps(df.sparkSession, marks.automaton),
    ).withColumnRenamed("_result", "_score")


def score_with_marks(
    df: DataFrame,
    marks: DataFrame | Marks,
    rules: S.Rules = S.Rules(),
    text: str = "full_text",
    lookup: str = "auto",
    phrases: DataFrame | None = None,
) -> DataFrame:
    """Add the label and the four scores of ``text``; ``marks`` as from :func:`token_marks`.

    Marks within the checked bound are searched inside each row, with no shuffle of the articles;
    beyond it (or with ``lookup='join'``) the distinct words of blocks of texts are joined with them,
    with the same result (see :func:`look_up_tokens`; a stream then needs ``foreachBatch``).
    Marks that are not yet prepared (see :func:`prepare_marks`) are prepared here, unless they are
    joined. ``lookup='index'`` refuses marks beyond the bound. ``phrases`` (phrase, kind, value; see
    ``functions/phrases.py``) takes part in the context rules; prepared marks have theirs with them.
    """
    if lookup not in ("auto", "index", "join"):
        raise ValueError(f"lookup must be auto, index or join, not {lookup!r}")
    if isinstance(marks, Marks):
        ready = marks
    elif lookup == "join":
        automaton = phrase_automaton(phrases)
        table = one_mark_per_token(with_phrase_words(marks, automaton))
        ready = Marks(table, small=False, automaton=automaton)
    else:
        ready = prepare_marks(marks, phrases)
    if lookup == "index" and not ready.small:
        raise ValueError("the marks are too many to be searched inside each row")
    score_by = _score_by_index if ready.small and lookup != "join" else _score_by_join
    scored = score_by(df, text, ready, rules)
    return scored.withColumns(S.sentiment_columns(F.col("_blank"), F.col("_score"))).drop("_score", "_blank")


def score_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    boosters: DataFrame | None = None,
    negations: DataFrame | None = None,
    rules: S.Rules = S.Rules(),
    text: str = "full_text",
    lookup: str = "auto",
    phrases: DataFrame | None = None,
) -> DataFrame:
    """Score against separate lexicon, degree-word, negation and phrase tables."""
    marks = token_marks(lexicon, boosters, negations)
    return score_with_marks(df, marks, rules, text, lookup, phrases)
