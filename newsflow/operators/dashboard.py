"""Filterable aggregates behind a dashboard; only their small results leave Spark."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.text import SPACE
from newsflow.operators import reports as R
from newsflow.schemas import PROCESSED
from newsflow.sources.articles import read_processed

ALL = "All"
FACETS = ("category", "source", "sentiment")
# Fixed value: seconds for which loaded data counts as fresh.
FRESH_SECONDS = 60
# What the dashboard needs; the article texts stay on disk.
DASHBOARD_COLUMNS = [c for c in PROCESSED.fieldNames() if c != "full_text"]

SENTIMENT_COUNTS = R.Report(
    ("sentiment",), R.COUNT, ("-count", "sentiment"), keep_null_keys=False
)
CATEGORY_COUNTS = R.Report(("category",), R.COUNT, ("-count", "category"), keep_null_keys=False)
CATEGORY_SENTIMENT_COUNTS = R.Report(
    ("category", "sentiment"), R.COUNT, ("category", "sentiment"), keep_null_keys=False
)
SOURCE_STATS = R.Report(
    ("source",),
    (
        ("sentiment_compound", "mean_compound"),
        ("text_length", "mean_length"),
        ("count", "articles"),
    ),
    ("source",),
    keep_null_keys=False,
)


def filter_articles(
    df: DataFrame, category: str = ALL, source: str = ALL, sentiment: str = ALL
) -> DataFrame:
    """Rows matching every chosen facet; ``All`` leaves a facet open."""
    chosen = {"category": category, "source": source, "sentiment": sentiment}
    for column, value in chosen.items():
        if value != ALL:
            df = df.where(F.col(column) == F.lit(value))
    return df


def facet_values(df: DataFrame, column: str, with_all: bool = False) -> DataFrame:
    """Distinct values a facet can take, sorted; ``with_all`` puts the open choice in front."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    if not with_all:
        return values.orderBy(column)
    first = df.sparkSession.range(1).select(F.lit(ALL).alias(column), F.lit(0).alias("_rank"))
    ranked = first.unionByName(values.withColumn("_rank", F.lit(1)))
    return ranked.orderBy("_rank", column).select(column)


def with_time_parts(df: DataFrame) -> DataFrame:
    return df.withColumns({"date": F.to_date("processed_at"), "hour": F.hour("processed_at")})


def kpis(df: DataFrame) -> DataFrame:
    """One row of key figures; the shares and means of no rows are NULL."""
    positive = F.count(F.when(F.col("sentiment") == "positive", 1))
    return df.agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.avg("sentiment_compound").alias("avg_sentiment"),
        F.try_divide(positive * 100.0, F.count(F.lit(1))).alias("positive_pct"),
        F.avg("text_length").alias("avg_length"),
    )


def articles_over_time(df: DataFrame) -> DataFrame:
    """Articles per clock hour; hours without articles are absent."""
    hour = F.date_trunc("HOUR", "processed_at").cast(df.schema["processed_at"].dataType)
    hours = df.where(F.col("processed_at").isNotNull()).select(hour.alias("processed_at"))
    counted = hours.groupBy("processed_at").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy("processed_at")


def top_keywords(df: DataFrame, limit: int = R.DEFAULT_TOP_KEYWORDS) -> DataFrame:
    """As the report of that name, but case is kept and the blank keyword is counted."""
    word = F.regexp_replace("listed", f"^[{SPACE}]+|[{SPACE}]+$", "")
    counts = R.count_keywords(R.listed_keywords(df).select(word.alias("keyword")))
    return counts.orderBy(F.desc("count"), "keyword").limit(limit)


def board_tally(df: DataFrame) -> DataFrame:
    """Counts and sums per facet and clock hour: what all grouped figures can be rolled up from."""
    hour = F.date_trunc("HOUR", "processed_at").cast(df.schema["processed_at"].dataType)
    return R.tally(df.withColumn("processed_at", hour), (*FACETS, "processed_at"))


def tallied_kpis(tallies: DataFrame) -> DataFrame:
    """As :func:`kpis`, from a tally."""
    articles = F.coalesce(F.sum("articles"), F.lit(0))
    positive = F.sum(F.when(F.col("sentiment") == "positive", F.col("articles")).otherwise(0))
    return tallies.agg(
        articles.alias("total_articles"),
        R.MEASURES["mean_compound"]().alias("avg_sentiment"),
        F.try_divide(positive * 100.0, articles).alias("positive_pct"),
        R.MEASURES["mean_length"]().alias("avg_length"),
    )


def tallied_over_time(tallies: DataFrame) -> DataFrame:
    """As :func:`articles_over_time`, from a tally."""
    hours = tallies.where(F.col("processed_at").isNotNull()).groupBy("processed_at")
    return hours.agg(F.sum("articles").alias("count")).orderBy("processed_at")


class ArticleBoard:
    """Filtered views of the processed table, answered again and again.

    A tally per facet and hour is kept, on disk where memory is short; every figure but the keywords
    and the latest articles is rolled up from it. Those two read their columns of the table. Data
    older than ``fresh_seconds`` is read again at the next view; ``refresh`` does so at once.
    """

    def __init__(
        self, spark: SparkSession, path: str, fresh_seconds: float = FRESH_SECONDS, keep: bool = True
    ):
        self._spark, self._path, self._keep = spark, path, keep
        self._fresh_seconds = fresh_seconds
        self._loaded: DataFrame | None = None
        self._tally: DataFrame | None = None
        self._loaded_at = 0.0

    def refresh(self) -> DataFrame:
        if self._tally is not None and self._keep:
            self._tally.unpersist()
        self._loaded = read_processed(self._spark, self._path).select(*DASHBOARD_COLUMNS)
        tally = board_tally(self._loaded)
        self._tally = tally.persist() if self._keep else tally
        self._loaded_at = time.monotonic()
        return self._loaded

    def _ensure_fresh(self) -> None:
        stale = time.monotonic() - self._loaded_at > self._fresh_seconds
        if self._loaded is None or stale:
            self.refresh()

    def articles(self) -> DataFrame:
        self._ensure_fresh()
        return self._loaded

    def tallies(self) -> DataFrame:
        self._ensure_fresh()
        return self._tally

    def facets(self, column: str) -> DataFrame:
        """Choices of one facet for a pick list, ``All`` first."""
        return facet_values(self.tallies(), column, with_all=True)

    def view(self, **facets: str) -> dict[str, DataFrame]:
        """Every dashboard figure over the chosen facets, as DataFrames."""
        counted = filter_articles(self.tallies(), **facets)
        chosen = filter_articles(self.articles(), **facets)
        return {
            "kpis": tallied_kpis(counted),
            "sentiment_counts": SENTIMENT_COUNTS.roll_up(counted),
            "category_counts": CATEGORY_COUNTS.roll_up(counted),
            "category_sentiment_counts": CATEGORY_SENTIMENT_COUNTS.roll_up(counted),
            "articles_over_time": tallied_over_time(counted),
            "top_keywords": top_keywords(chosen),
            "source_stats": SOURCE_STATS.roll_up(counted),
            "latest": R.latest_articles(chosen),
        }
