"""Lexicon files: tab-separated token, mean rating, deviation and the list of single ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.bind import let

# Means in such files are rounded, so they may be off their ratings by this much.
TOLERANCE = 0.051
RATINGS = "array<int>"
GOOD = "token string, valence double, deviation double, ratings array<int>"


def parse_lexicon(
    lines: DataFrame, line_col: str = "line", tolerance: float = TOLERANCE
) -> tuple[DataFrame, DataFrame]:
    """Entries of lexicon lines, and the lines set aside.

    Entries are token, valence, deviation and ratings. A line needs a token and a finite mean; the
    deviation and the ratings may be absent (NULL), but what is there must be right: a deviation is
    no negative number, ratings are a list of whole numbers, and the mean is theirs within
    ``tolerance``. Other lines come back, all columns, with the first ``reason``: ``blank``,
    ``fields``, ``token``, ``mean``, ``deviation``, ``ratings`` or ``unequal``. A NULL line is blank.
    Tokens keep their case and are trimmed; repeated tokens stay, and scoring takes the largest
    valence of them.
    """
    line = F.col(line_col)
    # The generator keeps the parts as columns: filters on them stay above it, so every line is taken
    # apart once, and not again for each use or (through a distinct) for each copy.
    parts = let(F.split(line, "\t", -1), lambda field: let(_typed(field), lambda p: _judged(line, p, tolerance)))
    judged = lines.select("*", F.inline(F.array(parts)))
    good = judged.where("_reason IS NULL").select(
        F.col("_token").alias("token"),
        F.col("_mean").alias("valence"),
        F.col("_deviation").alias("deviation"),
        F.col("_ratings").alias("ratings"),
    )
    bad = judged.where("_reason IS NOT NULL")
    return good, bad.select(*lines.columns, F.col("_reason").alias("reason"))


def _typed(field: Column) -> Column:
    """The fields of a line as text and in their types."""

    def at(k: int) -> Column:
        return F.nullif(F.trim(F.get(field, F.lit(k))), F.lit(""))

    return F.struct(
        F.size(field).alias("fields"),
        at(0).alias("token"),
        at(1).try_cast("double").alias("mean"),
        at(2).isNotNull().alias("has_deviation"),
        at(2).try_cast("double").alias("deviation"),
        at(3).isNotNull().alias("has_ratings"),
        F.from_json(at(3), RATINGS).alias("ratings"),
    )


def _judged(line: Column, p: Column, tolerance: float) -> Column:
    """The parts of an entry and the first reason against it, or NULL."""
    mean, deviation, ratings = p["mean"], p["deviation"], p["ratings"]
    total = F.aggregate(ratings, F.lit(0.0), lambda a, x: a + x)
    infinite = F.abs(mean) == F.lit(float("inf"))
    wrong_list = ratings.isNull() | (F.size(ratings) == 0) | F.exists(ratings, lambda x: x.isNull())
    reason = (
        F.when(F.coalesce(F.trim(line), F.lit("")) == "", "blank")
        .when(~p["fields"].between(2, 4), "fields")
        .when(p["token"].isNull(), "token")
        .when(mean.isNull() | F.isnan(mean) | infinite, "mean")
        .when(p["has_deviation"] & (deviation.isNull() | F.isnan(deviation) | (deviation < 0)), "deviation")
        .when(p["has_ratings"] & wrong_list, "ratings")
        .when(p["has_ratings"] & (F.abs(total / F.size(ratings) - mean) > tolerance), "unequal")
    )
    return F.struct(
        p["token"].alias("_token"), mean.alias("_mean"), deviation.alias("_deviation"),
        ratings.alias("_ratings"), reason.alias("_reason"),
    )


def read_lexicon(
    spark: SparkSession, path: str, tolerance: float = TOLERANCE
) -> tuple[DataFrame, DataFrame]:
    """Entries of the lexicon files under ``path``, and the lines set aside, with their file."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file")
    )
    return parse_lexicon(lines, tolerance=tolerance)


def lexicon_lines(lexicon: DataFrame) -> DataFrame:
    """One line (column ``value``) per entry, as :func:`read_lexicon` reads them."""
    ratings = F.concat(F.lit("["), F.array_join("ratings", ", "), F.lit("]"))
    fields = ["token", F.col("valence").cast("string"), F.coalesce(F.col("deviation").cast("string"), F.lit(""))]
    return lexicon.select(F.concat_ws("\t", *fields, F.coalesce(ratings, F.lit(""))).alias("value"))


def write_lexicon(lexicon: DataFrame, path: str) -> None:
    lexicon_lines(lexicon).write.mode("error").text(path)


def read_phrases(spark: SparkSession, path: str) -> DataFrame:
    """Phrase tables (phrase, kind, value) from tab-separated files; see ``functions/phrases.py``."""
    schema = "phrase string, kind string, value double"
    return spark.read.csv(path, schema, sep="\t", quote="", mode="FAILFAST").dropna("all")
