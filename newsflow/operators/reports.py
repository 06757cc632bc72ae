"""The fixed set of reports over processed articles.

A report is data: which keys to group by, which measures to take and how to order the result. The
same measures can be rolled up from a pre-aggregated base, so a full run scans the table once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.scratch import written

# The columns of the latest-articles listing.
LISTING = "title_clean source category sentiment sentiment_compound processed_at".split()
SENTIMENTS = ("positive", "negative", "neutral")
DEFAULT_TOP_KEYWORDS = 20
DEFAULT_LATEST = 10


def _mean(total: str, seen: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(seen))


def _votes(label: str) -> Column:
    return F.sum(F.when(F.col("sentiment") == label, F.col("articles")).otherwise(0))


# Every measure in terms of the tallies of :func:`tally`.
MEASURES: dict[str, Callable[[], Column]] = {
    "articles": lambda: F.sum("articles"),
    "mean_compound": lambda: _mean("compound_sum", "compound_seen"),
    "mean_length": lambda: _mean("length_sum", "length_seen"),
    **{label: (lambda label=label: _votes(label)) for label in SENTIMENTS},
}


@dataclass(frozen=True)
class Report:
    keys: tuple[str, ...]
    measures: tuple[tuple[str, str], ...]
    order: tuple[str, ...]
    keep_null_keys: bool = True

    def roll_up(self, tallies: DataFrame) -> DataFrame:
        if not self.keep_null_keys:
            tallies = tallies.dropna(subset=list(self.keys))
        columns = [MEASURES[measure]().alias(name) for name, measure in self.measures]
        order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.order]
        return tallies.groupBy(*self.keys).agg(*columns).orderBy(*order)

    def over(self, df: DataFrame) -> DataFrame:
        return self.roll_up(tally(df, self.keys, {m for _, m in self.measures}))


def tally(df: DataFrame, keys: tuple[str, ...], measures: set[str] | None = None) -> DataFrame:
    """One pass over the articles: mergeable counts and sums per key.

    Partial aggregation runs before the shuffle, so a key that holds a third of the rows sends one
    row per task like any other. Sentiment counts need ``sentiment`` among the grouping keys.
    """
    wanted = set(MEASURES) if measures is None else measures
    if wanted & set(SENTIMENTS) and "sentiment" not in keys:
        keys = (*keys, "sentiment")
    sums = [F.count(F.lit(1)).alias("articles")]
    for measure, column, name in (
        ("mean_compound", "sentiment_compound", "compound"),
        ("mean_length", "text_length", "length"),
    ):
        if measure in wanted:
            value = F.col(column).cast("double")
            sums += [F.sum(value).alias(f"{name}_sum"), F.count(column).alias(f"{name}_seen")]
    return with_hour(df, keys).groupBy(*keys).agg(*sums)


def with_hour(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Derive the hour of day (in the session time zone) when a report groups by it."""
    return df.withColumn("hour", F.hour("processed_at")) if "hour" in keys else df


COUNT = (("count", "articles"),)

SENTIMENT_DISTRIBUTION = Report(("sentiment",), COUNT, ("-count", "sentiment"))
CATEGORY_SENTIMENT = Report(
    ("category", "sentiment"),
    (("count", "articles"), ("avg_score", "mean_compound")),
    ("category", "-count", "sentiment"),
)
SOURCE_ANALYSIS = Report(
    ("source",),
    (
        ("total_articles", "articles"),
        ("avg_sentiment", "mean_compound"),
        ("avg_length", "mean_length"),
    ),
    ("-total_articles", "source"),
)
HOURLY_ACTIVITY = Report(("hour",), COUNT, ("hour",))
SENTIMENT_PIVOT = Report(("category",), tuple((s, s) for s in SENTIMENTS), ("category",))

TALLIED = {
    "sentiment_distribution": SENTIMENT_DISTRIBUTION,
    "category_sentiment": CATEGORY_SENTIMENT,
    "source_analysis": SOURCE_ANALYSIS,
    "hourly_activity": HOURLY_ACTIVITY,
    "sentiment_by_category_pivot": SENTIMENT_PIVOT,
}


def listed_keywords(df: DataFrame) -> DataFrame:
    return df.select(F.explode(F.split("keywords", ",")).alias("listed"))


def count_keywords(words: DataFrame) -> DataFrame:
    """How many articles list each keyword (an article lists a keyword at most once)."""
    return words.groupBy("keyword").agg(F.count(F.lit(1)).alias("count"))


def top_keywords(df: DataFrame, limit: int = DEFAULT_TOP_KEYWORDS) -> DataFrame:
    words = listed_keywords(df).select(F.trim(F.lower("listed")).alias("keyword"))
    counts = count_keywords(words.where(F.col("keyword") != ""))
    return counts.orderBy(F.desc("count"), "keyword").limit(limit)


def latest_articles(df: DataFrame, limit: int = DEFAULT_LATEST) -> DataFrame:
    """The newest articles; ties on the time stamp are settled by id."""
    newest = df.select(*LISTING, "id").orderBy(F.desc("processed_at"), "id").limit(limit)
    return newest.select(*LISTING)


def run_reports(df: DataFrame, top: int = DEFAULT_TOP_KEYWORDS) -> dict[str, DataFrame]:
    """All reports as DataFrames, or an empty dict when there is no article.

    The grouped reports share one tally per (category, sentiment, source, hour), which is small
    beside the table. It is written to the shared folder, so nothing is left to be released.
    """
    if df.isEmpty():
        return {}
    base = written(tally(df, ("category", "sentiment", "source", "hour")), "tally")
    results = {name: report.roll_up(base) for name, report in TALLIED.items()}
    results["top_keywords"] = top_keywords(df, top)
    results["tally"] = base
    return results
